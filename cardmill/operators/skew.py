"""Keys that hold too many rows for one task, and exact running totals for them."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardmill.session import materialize

# A key above this many rows is split. At most rows/HOT_ROWS keys can be hot.
HOT_ROWS = 20_000

# Rows of one range when a hot key is split.
RANGE_ROWS = 8_000_000

# Ranges wanted at most while a range holds fewer than ``RANGE_ROWS`` rows: each costs the driver a sample and a task.
MOST_RANGES = 400


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """Hot keys as a stored one-column table, and the number of rows they hold.

    One pass over the key column; counts are combined before the shuffle.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot_rows)
    stored = materialize(counts, "hot-keys")
    rows = stored.agg(F.sum("rows").alias("rows")).first()["rows"]
    return (None, 0) if rows is None else (stored.select(key), rows)


def range_count(rows: int, range_rows: int) -> int:
    """Ranges of ``range_rows`` rows; larger ones, up to ``RANGE_ROWS``, where there would be more than ``MOST_RANGES``."""
    size = max(range_rows, min(RANGE_ROWS, ceil(rows / MOST_RANGES)))
    return max(1, ceil(rows / size))


def running_totals(
    df: DataFrame, key: str, order: list[str], value: str, rows: int, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add ``running_sum`` and ``running_count`` of ``value`` per key in ``order``.

    The rows are cut into ranges of the full order, so one key spreads over many
    tasks. A range adds the totals of the key's earlier ranges to its own running
    totals. The ranges are stored first: range bounds come from a sample, and a
    recomputed sample could cut differently.
    """
    ranges = range_count(rows, range_rows)
    cut = df.repartitionByRange(ranges, key, *order).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut, "ranges")

    totals = cut.groupBy(key, "_range").agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        key,
        "_range",
        F.sum("_sum").over(earlier).alias("_sum_before"),
        F.sum("_count").over(earlier).alias("_count_before"),
    )
    within = Window.partitionBy(key, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({"_sum": F.sum(value).over(within), "_count": F.count(value).over(within)})
    return (
        local.join(carried, [key, "_range"], "left")
        .withColumn("running_sum", _plus(F.col("_sum"), F.col("_sum_before")))
        .withColumn("running_count", F.col("_count") + F.coalesce("_count_before", F.lit(0)))
        .drop("_range", "_sum", "_count", "_sum_before", "_count_before")
    )


def _plus(a, b):
    """Sum in which a missing side counts as nothing; NULL only when both are missing."""
    return F.coalesce(a + b, a, b)


def carried_forward(
    df: DataFrame, key: str, order: list[str], value: str, name: str, rows: int, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add the last known ``value`` at or before each row of its key in ``order`` as ``name``.

    As in ``running_totals`` one key spreads over ranges of the full order; a range takes over the last value of the
    ranges before it. What is kept of a range and key is one row.
    """
    ranges = range_count(rows, range_rows)
    cut = df.repartitionByRange(ranges, key, *order).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut, "ranges")

    known = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_known")))
    ends = cut.groupBy(key, "_range").agg(F.max(known).alias("_end_of_range"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        key, "_range", F.last("_end_of_range", ignorenulls=True).over(earlier)["_known"].alias("_before")
    )
    within = Window.partitionBy(key, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_here", F.last(value, ignorenulls=True).over(within))
    return (
        local.join(carried, [key, "_range"], "left")
        .withColumn(name, F.coalesce("_here", "_before"))
        .drop("_range", "_here", "_before")
    )
