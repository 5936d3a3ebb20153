"""Exact order statistics of large groups by repeated histogram refinement.

A wanted rank lies in an interval of values, at first from the group's least to
its largest. Each pass counts the interval's values in equal-width buckets
(partial aggregates: a task sends a row for each bucket, not its values), takes
the bucket that holds the rank and shrinks the interval to the least and largest
value in it. A rank is found when its interval is one value; once an interval
has few values they are sorted. No task ever holds a group's values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.session import materialize

#: Buckets of a pass, and values of an interval that are sorted at once.
BUCKETS, BOUND = 1024, 4096


def _same(left: Sequence[str], right: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)], F.lit(True))


def select_ranks(values: DataFrame, ranks: DataFrame, group: Sequence[str], col: str, bound: int = BOUND, buckets: int = BUCKETS) -> DataFrame:
    """``group, rank, value``: the value at each wanted 0-based rank of each group.

    ``values`` has the group columns and ``col`` (NULL and NaN left out by the
    caller); it is read once a pass, so it should be a table. ``ranks`` has the
    group columns and ``rank``; a rank outside its group has no row.
    """
    group = list(group)
    named = [f"_g{i}" for i in range(len(group))]
    x = values.select(*group, F.col(col).cast("double").alias("_x"))
    spans = x.groupBy(*group).agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count("_x").alias("n"))
    wanted = ranks.select(*[F.col(c).alias(n) for c, n in zip(group, named, strict=True)], "rank").distinct()
    start = spans.join(wanted, _same(group, named)).where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    now = materialize(start.select(*named, "rank", F.col("rank").alias("k"), "lo", "hi", "n"), "ranks")
    ready = (F.col("lo") == F.col("hi")) | (F.col("n") <= bound)
    done = now.where(ready)
    while (now := now.where(~ready)).limit(1).count():
        spans = now.select(*named, "lo", "hi").distinct()
        inside = x.join(spans, _same(group, named) & F.col("_x").between(F.col("lo"), F.col("hi")))
        share = (F.col("_x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)  # halves: no overflow
        hist = inside.groupBy(*named, "lo", "hi", F.least(F.lit(buckets - 1), F.floor(share * buckets)).alias("bucket"))
        hist = hist.agg(F.count("_x").alias("c"), F.min("_x").alias("least"), F.max("_x").alias("most"))
        upto = F.sum("c").over(Window.partitionBy(*named, "lo", "hi").orderBy("bucket"))
        hist = hist.withColumn("before", upto - F.col("c")).select(*[F.col(c).alias(f"_h{c}") for c in (*named, "lo", "hi")], "c", "least", "most", "before")
        hit = now.join(hist, _same([*named, "lo", "hi"], [f"_h{c}" for c in (*named, "lo", "hi")]) & (F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("c")))
        now = materialize(hit.select(*named, "rank", (F.col("k") - F.col("before")).alias("k"), F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("c").alias("n")), "ranks")
        done = done.unionByName(now.where(ready))
    found = done.where("lo = hi").select(*named, "rank", F.col("lo").alias("value"))
    few = done.where("lo < hi")
    spans = few.select(*named, "lo", "hi").distinct()
    lists = x.join(spans, _same(group, named) & F.col("_x").between(F.col("lo"), F.col("hi"))).groupBy(*named, "lo", "hi").agg(F.sort_array(F.collect_list("_x")).alias("sorted"))  # at most ``bound``
    lists = lists.select(*[F.col(c).alias(f"_h{c}") for c in (*named, "lo", "hi")], "sorted")
    short = few.join(lists, _same([*named, "lo", "hi"], [f"_h{c}" for c in (*named, "lo", "hi")]))
    found = found.unionByName(short.select(*named, "rank", F.element_at("sorted", (F.col("k") + 1).cast("int")).alias("value")))
    return found.withColumnsRenamed(dict(zip(named, group, strict=True)))


def exact_percentiles(values: DataFrame, group: Sequence[str], col: str, shares: Sequence[float], bound: int = BOUND) -> DataFrame:
    """``group, q: array<double>``: percentiles with linear interpolation, as the aggregate ``percentile`` gives them."""
    group = list(group)
    table = materialize(values.where(F.col(col).isNotNull()).select(*group, F.col(col).cast("double").alias(col)), "values")
    n = table.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    at = F.posexplode(F.array(*[F.lit(float(s)) for s in shares])).alias("_i", "_share")
    place = (F.col("_n") - 1) * F.col("_share")
    places = materialize(n.select(*group, "_n", at).withColumns({"_low": F.floor(place), "_part": place - F.floor(place), "_high": F.ceil(place)}), "places")
    ranks = places.select(*group, F.col("_low").alias("rank")).unionByName(places.select(*group, F.col("_high").alias("rank")))
    found = materialize(select_ranks(table, ranks, group, col, bound), "selected")
    side = lambda name: found.select(*[F.col(c).alias(f"{name}_{c}") for c in group], F.col("rank").alias(f"{name}_rank"), F.col("value").alias(name))
    j = places.join(side("below"), _same([*group, "_low"], [f"below_{c}" for c in (*group, "rank")])).join(side("above"), _same([*group, "_high"], [f"above_{c}" for c in (*group, "rank")]))
    value = F.col("below") + F.col("_part") * (F.col("above") - F.col("below"))
    return j.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("_i", value.alias("v")))).alias("_v")).select(*group, F.transform("_v", lambda e: e["v"]).alias("q"))
