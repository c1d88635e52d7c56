"""Reading tables, settings for tasks with Python workers, and gapless numbering without a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.session import materialize, tune

# Fixed: the rows whose labels may be learned from.
HELD_OUT_REMAINDER = 1
FOLDS = 3

# Settings of the library that suit tables of many short rows, not documents.
PAYMENT_SETTINGS = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Settings of the library, and Arrow batches small enough for long texts."""
    tune(spark)
    for name in PAYMENT_SETTINGS:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_REMAINDER, F.lit(False))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add the position (0, 1, ...) of each row within its group, however large the group.

    Rows are sorted by group and order into ranges, counted within each range, and the totals of earlier ranges are
    added. What is kept of a range is one row for each group that crosses into it, so it is small and joined freely.
    The ranges are written out first: every later step sees the same rows in the same ranges.
    """
    from pyspark.sql import Window

    part = f"{name}_range"
    ranged = materialize(
        df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn(part, F.spark_partition_id()), name
    )
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group]
    counts = ranged.groupBy(*group, part).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"__{c}") for c in group], F.col(part).alias("__part"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    ).filter("__start > 0")
    within = Window.partitionBy(part, *group).orderBy(*order)
    rows = ranged.withColumn(name, F.row_number().over(within) - F.lit(1))
    condition = F.col(part) == F.col("__part")
    for s in same:
        condition = condition & s
    return (
        rows.join(starts, condition, "left")
        .withColumn(name, (F.col(name) + F.coalesce("__start", F.lit(0))).cast("long"))
        .drop(part, "__part", "__start", *[f"__{c}" for c in group])
    )
