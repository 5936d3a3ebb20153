"""Plan inspection: count the physical operators that matter at scale.

``plan_summary(df)`` reads the executed (AQE initial) plan text and reports the
number of shuffles by kind, joins by strategy, windows, scans and whether
filters reached the scan, so a change that adds a shuffle shows up in review.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plan_summary(df: DataFrame) -> dict:
    p = plan_text(df)
    init = p.split("== Initial Plan ==")[-1]
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", init)),
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", init)),
        "single_partition_exchanges": len(re.findall(r"Exchange SinglePartition", init)),
        "broadcast_exchanges": len(re.findall(r"BroadcastExchange", init)),
        "broadcast_hash_joins": len(re.findall(r"BroadcastHashJoin", init)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", init)),
        "windows": len(re.findall(r"\bWindow \[", init)),
        "window_group_limits": len(re.findall(r"WindowGroupLimit", init)),
        "partial_aggregates": len(re.findall(r"partial_", init)) > 0,
        "scans": len(re.findall(r"FileScan", init)),
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)\]", init),
        "python_udfs": len(re.findall(r"(FlatMapGroupsInPandas|MapInPandas|ArrowEvalPython|BatchEvalPython)", init)),
    }
