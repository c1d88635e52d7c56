"""As-of lookup by one timeline: versions and facts in the order of time, the last version carried forward.

Versions and facts are united and sorted by key and time, so a lookup is one shuffle and one sort. A join on the key with
a condition on the time would meet every fact of a key with every version of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardmill.operators.skew import HOT_ROWS, RANGE_ROWS, carried_forward, hot_keys

_ORDER = ["_at", "_is_fact", "_version"]


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    start: str = "valid_from",
    end: str = "valid_to",
    hot_rows: int = HOT_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Every fact once, with the attributes of its key's version that began last at or before the fact.

    A version holds from its start up to, not including, its end or the start of a later version. Where bounds overlap
    the later start counts; with equal starts the later end, then the larger attributes. A version without a start or an
    end, or that ends before it starts, never holds. A fact without a key or a time has no version, and neither has one
    whose last version has ended. Keys with more than ``hot_rows`` rows are cut into ranges of time.
    """
    columns = facts.columns
    lone = F.col(key).isNull() | F.col(ts).isNull()
    held = versions.filter(F.col(key).isNotNull() & (F.col(end) > F.col(start)))
    marks = held.select(
        F.col(key).alias("_key"),
        F.lit(None).cast("long").alias("_lone"),
        F.col(start).alias("_at"),
        F.lit(0).alias("_is_fact"),
        F.struct(F.col(end).alias("_end"), *attributes).alias("_version"),
    )
    rows = facts.select(
        F.when(~lone, F.col(key)).alias("_key"),
        # Facts that cannot match are no group: each gets a number of its own.
        F.when(lone, F.monotonically_increasing_id()).alias("_lone"),
        F.col(ts).alias("_at"),
        F.lit(1).alias("_is_fact"),
        F.struct(*columns).alias("_fact"),
    )
    timeline = marks.unionByName(rows, allowMissingColumns=True)
    hot, count = hot_keys(timeline.filter("_lone IS NULL"), "_key", hot_rows)
    if hot is None:
        carried = _carried(timeline)
    else:
        split = carried_forward(timeline.filter("_lone IS NULL").join(hot, "_key", "left_semi"), "_key", _ORDER, "_version", "_last", count, range_rows)
        carried = _carried(timeline.join(hot, "_key", "left_anti")).unionByName(split)
    holds = F.col("_at") < F.col("_last._end")
    found = [F.when(holds, F.col(f"_last.{c}")).alias(c) for c in attributes]
    return carried.filter("_is_fact = 1").select("_fact.*", *found)


def _carried(timeline: DataFrame) -> DataFrame:
    order = Window.partitionBy("_key", "_lone").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    return timeline.withColumn("_last", F.last("_version", ignorenulls=True).over(order))
