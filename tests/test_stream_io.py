"""Streaming and I/O behaviour."""

import datetime as dt

from barflow.session import scratch_path
from barflow.sources import io
from barflow.streaming import stream as st
from tests.conftest import SF_SMALL


def test_csv_roundtrip_keeps_types(spark):
    from barflow.sources import bars as src

    b = src.ord_bars(spark, SF_SMALL)
    path = scratch_path(spark, "t-csv")
    io.write_bars_csv(b, path)
    back = io.read_bars_csv_partitioned(spark, path)
    assert back.schema["date"].dataType.simpleString() == "date"
    assert back.schema["volume"].dataType.simpleString() == "bigint"
    assert back.count() == b.count()


def _bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, close double, high double, low double")


def _feed(spark, batches, name):
    """A file for each batch, in that order."""
    import time

    path = scratch_path(spark, name)
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return st.bar_stream(spark, path, batches[0].schema, max_files_per_trigger=1)


def _same(live, batch):
    cols = ["symbol", "date", "close", "prev_close", "ma_10", "ma_50", "rsi", "upper_bb", "stoch_osc"]
    key = lambda r: (r[0] or "", r[1])
    a, b = (sorted((tuple(r[c] for c in cols) for r in f.collect()), key=key) for f in (live, batch))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    for x, y in zip(a, b):
        for u, v in zip(x[2:], y[2:]):
            assert (u is None) == (v is None) and (u is None or abs(u - v) < 1e-6), (x, y)


def test_live_indicators_equal_batch_for_any_batching(spark):
    import random

    from barflow.operators import halo

    rnd = random.Random(4)
    day = dt.date(2020, 1, 1)
    rows = [(s, day + dt.timedelta(days=i), c := 100 + rnd.random() * 20, c + 2, c - 3) for s, n in (("A", 150), ("B", 61), ("C", 1)) for i in range(n)]
    rows[20] = (*rows[20][:2], None, None, None)  # a NULL bar
    batch = st.indicator_rows(halo.index_rows(_bars(spark, rows)))
    for seed in (1, 2):
        mixed = rows + [rows[3], rows[70]]  # repeated bars
        random.Random(seed).shuffle(mixed)  # late bars everywhere
        parts = [_bars(spark, mixed[i::3]) for i in range(3)]
        _same(st.run_live(spark, _feed(spark, parts, "t-live"), "t-live", block=16), batch)


def test_late_and_corrected_bars_mend_their_rows(spark):
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    one = _bars(spark, [("A", day(i), 10.0 + i, 11.0, 9.0) for i in (0, 1, 3)])
    two = _bars(spark, [("A", day(2), 30.0, 31.0, 29.0), ("A", day(0), 20.0, 21.0, 19.0)])  # late, and a correction
    got = {r.date: r for r in st.run_live(spark, _feed(spark, [one, two], "t-late"), "t-late", st.change_rows, depth=1).collect()}
    assert [got[day(i)].close for i in range(4)] == [20.0, 11.0, 30.0, 13.0]
    assert [got[day(i)].prev_close for i in range(4)] == [None, 20.0, 11.0, 30.0]
    alerts = st.price_alerts(st.run_live(spark, _feed(spark, [one, two], "t-al"), "t-al", st.change_rows, depth=1), 50.0)
    assert sorted(r.date for r in alerts.collect()) == [day(2), day(3)]


def test_distinct_keys_over_micro_batches(spark):
    day = dt.date(2020, 1, 1)
    rows = [(s, day + dt.timedelta(days=d % 40), 1.0, 1.0, 1.0) for s in ("A", None) for d in range(0, 400, 7)]
    parts = [_bars(spark, rows[i::3]) for i in range(3)]
    got = st.run_distinct(spark, _feed(spark, parts, "t-dis"), "t-dis").collect()
    assert len(got) == len({(r.symbol, r.date) for r in got}) == len({(r[0], r[1]) for r in rows})


def test_tick_bars_drop_late_ticks(spark):
    feed = scratch_path(spark, "t-ticks")
    schema = "symbol string, ts timestamp_ntz, price double"
    t = dt.datetime
    first = [("A", t(2024, 1, 1, 10, 5), 1.0), ("A", t(2024, 1, 1, 10, 20), 2.0), ("A", t(2024, 1, 1, 12, 30), 3.0)]
    second = [("A", t(2024, 1, 1, 13, 40), 4.0)]
    late = [("A", t(2024, 1, 1, 10, 10), 99.0)]
    # one file per micro-batch, written in time order; Spark drops a row older than the watermark that was
    # in force at the previous batch, so the late tick comes two batches after the 10:00 window closed
    import time as _time

    for rows in (first, second, late):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        _time.sleep(1.1)
    ticks = st.bar_stream(spark, feed, schema, max_files_per_trigger=1)
    bars = st.run_to_table(spark, st.tick_bars(ticks, "symbol", "ts", "price", "1 hour", "10 minutes"), "t-bars")
    got = {r.bar_ts: r for r in bars.collect()}
    ten = got[t(2024, 1, 1, 10, 0)]
    assert ten.high == 2.0 and ten.volume == 2  # the late 10:10 tick was dropped
    assert t(2024, 1, 1, 13, 0) not in got  # still open when the stream ended (append mode)
