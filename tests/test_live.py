"""Row frames of a stream from keyed state."""

import datetime as dt
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from barflow.operators import halo
from barflow.session import scratch_path
from barflow.streaming import live
from barflow.streaming import stream as st
from tests.conftest import SF_SMALL
from tests.test_stream_io import _bars, _feed, _same

DAY = dt.date(2020, 1, 1)


def _day(i):
    return DAY + dt.timedelta(days=i)


def _random_bars(n, seed):
    rnd = np.random.default_rng(seed)
    close = rnd.integers(50, 60, n).astype(float)  # equal closes too: no gain, no loss
    bars = np.stack([np.arange(n) * 86_400_000.0, close, close + 2, close - rnd.integers(0, 3, n)], axis=1)
    bars[rnd.random(n) < 0.05, 1:] = np.nan
    return bars


@pytest.mark.parametrize("seed", range(5))
def test_steps_equal_whole_series(seed):
    """However the bars and the watermark move, the frames are those of the whole series."""
    rnd = random.Random(seed)
    bars = _random_bars(rnd.choice([1, 2, 30, 300]), seed)
    want = live.indicators(bars)
    ring = ahead = np.empty((0, 4))
    left, got = list(range(len(bars))), {c: [] for c in want}
    while left or len(ahead):
        watermark = bars[left[0], 0] if left else np.inf  # all before the first that is missing
        near = left[: rnd.randint(0, 40)]
        take = rnd.sample(near, rnd.randint(0, len(near)))
        left = [i for i in left if i not in take]
        new = bars[take + take[:2]] if take else np.empty((0, 4))  # some come twice
        ring, ahead, passed, found = live.advance(ring, ahead, new, watermark, 49, live.indicators)
        assert len(ring) <= 49 and (passed[:, 0] < watermark).all()
        for c, v in found.items():
            got[c] += v.tolist()
    for c, v in want.items():
        assert np.allclose(got[c], v, rtol=0, atol=1e-9, equal_nan=True), c


def test_one_bar_for_each_time():
    rows = np.array([[2, 5, 1, 1], [1, np.nan, 9, 9], [2, 7, 1, 0], [1, 3, 1, 1], [2, 7, 1, np.nan]], float)
    assert live.one_for_each_time(rows).tolist() == [[1, 3, 1, 1], [2, 7, 1, 0]]
    assert live.one_for_each_time(rows[:0]).shape == (0, 4)


def test_stream_equals_batch_within_the_watermark(spark):
    rnd = random.Random(9)
    rows = [(s, _day(i), c := 100 + rnd.random() * 20, c + 2, c - 3) for s, n in (("A", 160), (None, 90), ("C", 1)) for i in range(n)]
    rows[20] = (*rows[20][:2], None, None, None)
    end = ("Z", _day(400), 1.0, 1.0, 1.0)  # lets the watermark pass all others
    parts = [[] for _ in range(4)]
    for r in [*rows, rows[3], rows[170]]:
        parts[min(3, max(0, ((r[1] - DAY).days + rnd.randint(-5, 5)) // 40))].append(r)
    for p in parts:
        rnd.shuffle(p)
    feed = _feed(spark, [_bars(spark, p) for p in [*parts, [end]]], "t-keyed")
    got = st.run_to_table(spark, st.live_indicators(feed, "20 days"), "t-keyed")
    assert got.where("symbol = 'Z'").count() == 0  # ahead of the watermark
    _same(got, st.indicator_rows(halo.index_rows(_bars(spark, rows))))


def test_late_bars_timers_and_expiry(spark):
    bar = lambda s, i, c: (s, _day(i), c, c, c)
    batches = [
        [bar("A", 0, 10.0), bar("B", 1, 5.0), bar("A", 2, 20.0)],
        [bar("A", 40, 30.0)],  # B has no new bar: its timer gives day 1 out
        [bar("A", 1, 99.0), bar("A", 41, 33.0)],  # far too late
        [bar("B", 300, 7.0), bar("A", 300, 66.0)],  # A and B were idle for more than 100 days
        [bar("C", 400, 1.0)],
    ]
    feed = _feed(spark, [_bars(spark, b) for b in batches], "t-timer")
    got = {(r.symbol, r.date): r.prev_close for r in st.run_to_table(spark, st.live_changes(feed, "3 days", "100 days"), "t-timer").collect()}
    assert got == {("A", _day(0)): None, ("A", _day(2)): 10.0, ("A", _day(40)): 20.0, ("A", _day(41)): 30.0, ("A", _day(300)): None, ("B", _day(1)): None, ("B", _day(300)): None}


def test_closed_feed_gives_every_bar(spark):
    """Bars ahead of the watermark when the feed ends come out too, those of a symbol without a name as well; the closing row does not."""
    rows = [(s, _day(i), c := 100.0 + i % 7, c + 2, c - 3) for s in ("A", None) for i in range(80)] + [("B", _day(79), 5.0, 5.0, 5.0)]
    path = scratch_path(spark, "t-closed")
    for part in (rows[:70] + rows[80:140], rows[70:80] + rows[140:]):
        _bars(spark, part).coalesce(1).write.mode("append").parquet(path)
    schema = _bars(spark, rows).schema
    st.close_feed(spark, path, schema, 20)
    got = st.run_to_table(spark, st.live_indicators(st.bar_stream(spark, path, schema, 1), "20 days"), "t-closed")
    _same(got, st.indicator_rows(halo.index_rows(_bars(spark, rows))))


@pytest.mark.parametrize("name", ["stream_indicators", "stream_alerts"])
def test_registered_streams_leave_no_bar_out(spark, name):
    """Their SQL and rows are those of the same query over a feed in any order."""
    sql, fn = entry.oracle_sql(), entry.queries()
    assert sql[name] == sql[f"{name}_any_order"]
    rows = lambda n: sorted(map(str, fn[n](spark, SF_SMALL).select("symbol", "date").collect()))
    assert rows(name) == rows(f"{name}_any_order")


def test_alerts_from_any_trigger(spark):
    feed = _feed(spark, [_bars(spark, [("A", _day(i), c, c, c) for i, c in enumerate([10.0, 16.0, 15.0, 0.0, 4.0])]), _bars(spark, [("A", _day(90), 1.0, 1.0, 1.0)])], "t-trigger")
    alerts = st.price_alerts(st.live_changes(feed, "2 days"), 50.0)
    query = alerts.writeStream.format("memory").queryName("t_alerts").option("checkpointLocation", scratch_path(spark, "t-trigger-ckpt")).trigger(processingTime="200 milliseconds").start()
    try:
        query.processAllAvailable()
        query.processAllAvailable()  # the batch that follows the last watermark
        found = sorted((r.date, r.change_pct) for r in spark.table("t_alerts").collect())
    finally:
        query.stop()
    assert found == [(_day(1), 60.0), (_day(3), -100.0)]  # after a close of 0 there is no change


def test_store_of_keys_prunes_to_its_buckets(spark, tmp_path):
    rows = _bars(spark, [("A", _day(i), 1.0, 1.0, 1.0) for i in range(0, 4000, 100)])
    st._store_new(rows, 0, str(tmp_path), ["symbol", "date"], "date")
    kept = st.stored_keys(spark, str(tmp_path), st._store_schema(rows, "date"), ["symbol", "date"], 1, 18, 18)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("\n")[0]
    assert "batch" in filters and "_tb" in filters
    every = rows.select("date").distinct().count()
    assert 0 < kept.count() < every / 2
    again = _bars(spark, [("A", _day(0), 1.0, 1.0, 1.0), ("A", _day(1), 1.0, 1.0, 1.0), ("A", None, 1.0, 1.0, 1.0)])
    for number in (1, 2):
        st._store_new(again, number, str(tmp_path), ["symbol", "date"], "date")
    assert spark.read.parquet(str(tmp_path)).count() == every + 2


def test_watermark_dedupe_keeps_one_of_each_key(spark):
    rows = [("A", _day(i), 1.0, 1.0, 1.0) for i in (0, 1, 1, 2)]
    feed = _feed(spark, [_bars(spark, rows), _bars(spark, [rows[1], ("A", _day(3), 1.0, 1.0, 1.0)])], "t-wm")
    got = st.run_to_table(spark, st.dedupe_stream(feed, delay="5 days"), "t-wm").collect()
    assert sorted(r.date for r in got) == [_day(i) for i in range(4)]
