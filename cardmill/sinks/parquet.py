"""Parquet writes that can be repeated and that count rows on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardmill import files
from cardmill.sinks.swap import INCOMING, put_in_place, recover, swap_folder


# Partition columns of tables by day.
DAY = ("year", "month", "day")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows in the writing stage itself instead of in a second job."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], compression: str = "snappy", sort_by: Sequence[str] = ()
) -> int:
    """Replace the partitions that occur in ``df``; return the rows written.

    A partition that should be there no more has to be dropped: see ``overwrite_day``
    for one day and ``replace_table`` for all of them.

    Rows of one partition are brought together, but a partition too large for
    one task is split, so a hot day becomes several files instead of one slow task.
    """
    together, observation = _counted(df.hint("rebalance", *partition_by))
    if sort_by:
        together = together.sortWithinPartitions(*partition_by, *sort_by)
    (
        together.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return observation.get["rows"]


def overwrite_day(df: DataFrame, path: str, day: date, sort_by: Sequence[str] = ()) -> int:
    """Replace one day by ``df``, which holds rows of that day only; without rows the day goes."""
    rows = overwrite_partitions(df, path, DAY, sort_by=sort_by)
    if not rows:
        drop_partition(df.sparkSession, path, {"year": day.year, "month": day.month, "day": day.day})
    return rows


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], wanted: Sequence[tuple], sort_by: Sequence[str] = ()
) -> int:
    """Replace the partitions ``wanted`` (values of ``partition_by``) by ``df``, which holds rows of those only, in one job.

    A partition of them that gets no rows goes. Which ones got rows is seen from their files: a written partition has
    new ones. A run that stops in between is repeated as a whole.
    """
    spark = df.sparkSession
    folders = ["/".join(f"{c}={v}" for c, v in zip(partition_by, values)) for values in wanted]
    before = {folder: set(files.children(spark, f"{path}/{folder}")) for folder in folders}
    rows = overwrite_partitions(df, path, partition_by, sort_by=sort_by)
    for folder, old in before.items():
        if old and old <= set(files.children(spark, f"{path}/{folder}")):
            files.delete(spark, f"{path}/{folder}")
    return rows


def overwrite_days(df: DataFrame, path: str, days: Sequence[date], sort_by: Sequence[str] = ()) -> int:
    """Replace several days by ``df``, which holds rows of those days only; days without rows go."""
    return replace_partitions(df, path, DAY, [(d.year, d.month, d.day) for d in days], sort_by)


def replace_table(
    df: DataFrame, path: str, compression: str = "snappy", partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> int:
    """Replace a whole table, also one that ``df`` reads.

    The new files are complete before the old ones move away. A failed job leaves the old table in place, and what a
    crash leaves behind is put right before the next read or write (``recover``).
    """
    spark = df.sparkSession
    recover(spark, path)
    files.mkdirs(spark, swap_folder(path))
    counted, observation = _counted(df.hint("rebalance", *partition_by) if partition_by else df)
    if sort_by:
        counted = counted.sortWithinPartitions(*partition_by, *sort_by)
    try:
        writer = counted.write.option("compression", compression)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{swap_folder(path)}/{INCOMING}")
        put_in_place(spark, path)
    except BaseException:
        recover(spark, path)
        raise
    return observation.get["rows"]


def overwrite_single_file(df: DataFrame, path: str, compression: str = "snappy") -> int:
    """Small static dimension as one file; the rows are computed in parallel before they meet."""
    return replace_table(df.repartition(1), path, compression)


def drop_partition(spark: SparkSession, path: str, values: Mapping[str, object]) -> bool:
    """Remove one partition directory. Overwriting with no rows would leave the old ones."""
    return files.delete(spark, "/".join([path, *(f"{k}={v}" for k, v in values.items())]))
