"""Compaction, tiering and vacuum of stored tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators.dedup import latest_where_keyed
from cardmill.sinks import drop_partition, overwrite_partitions, recover_partitions, replace_table
from cardmill.sources import read_table_if_present

# File sizes of the hot and the warm tier, and the assumed size of a stored row.
HOT_FILE_BYTES = 128 * 1024 * 1024
WARM_FILE_BYTES = 256 * 1024 * 1024
ROW_BYTES = 500

_DAY = ("year", "month", "day")


@dataclass(frozen=True)
class Compaction:
    """What a compaction wrote; nothing was there to compact if ``rows`` is None."""

    path: str
    rows: int | None = None
    files: int = 0


def target_files(rows: int, file_bytes: int) -> int:
    return max(1, rows * ROW_BYTES // file_bytes)


def _newest(df: DataFrame) -> list[str]:
    return [c for c in ("_loaded_at", "_ingested_at") if c in df.columns]


def _packed(df: DataFrame, dedup_key: str | None, file_bytes: int) -> tuple[DataFrame, int, int]:
    """Rows without copies, cut into files of about the wanted size and clustered by user.

    Files are ranges of (user, key), so a user with very many rows fills several.
    The file count comes from one pass over the key column.
    """
    keyed = [F.count(F.lit(1)).alias("rows")]
    if dedup_key:
        keyed = [(F.count_distinct(dedup_key) + F.count_if(F.col(dedup_key).isNull())).alias("rows")]
    rows = df.agg(*keyed).first()["rows"]
    count = target_files(rows, file_bytes)
    unique = latest_where_keyed(df, dedup_key, _newest(df)) if dedup_key else df
    order = [c for c in ("user_id", dedup_key) if c and c in df.columns]
    if not order:
        return unique.repartition(count), rows, count
    ranges = [*order, *(c for c in _newest(df) if c not in order)]
    return unique.repartitionByRange(count, *ranges).sortWithinPartitions(*order), rows, count


def compact_day(
    spark: SparkSession, path: str, day: date, dedup_key: str | None = None, file_bytes: int = HOT_FILE_BYTES
) -> Compaction:
    """Rewrite one day into few large files. The old files go when the new ones are committed."""
    recover_partitions(spark, path)
    partition = "/".join([path, f"year={day.year}", f"month={day.month}", f"day={day.day}"])
    df = read_table_if_present(spark, partition)
    if df is None:
        return Compaction(partition)
    packed, rows, count = _packed(df, dedup_key, file_bytes)
    replace_table(packed, partition)
    return Compaction(partition, rows, count)


def compact_yesterday(spark: SparkSession, path: str, dedup_key: str | None = None, today: date | None = None) -> Compaction:
    return compact_day(spark, path, (today or date.today()) - timedelta(days=1), dedup_key)


def compact_month(
    spark: SparkSession,
    path: str,
    warm_path: str,
    year: int,
    month: int,
    dedup_key: str | None = None,
    file_bytes: int = WARM_FILE_BYTES,
    compression: str = "zstd",
) -> Compaction:
    """Merge the days of a month into one directory of the warm tier; the days stay where they are."""
    for table in (path, warm_path):
        recover_partitions(spark, table)
    output = f"{warm_path}/year={year}/month={month}"
    df = read_table_if_present(spark, f"{path}/year={year}/month={month}")
    if df is None:
        return Compaction(output)
    packed, rows, count = _packed(df, dedup_key, file_bytes)
    replace_table(packed, output, compression)
    return Compaction(output, rows, count)


def still_quarantined(cutoff: date) -> Column:
    """Open rows, and rows resolved on or after the cutoff."""
    return ~F.col("is_resolved") | (F.col("resolved_at") >= F.lit(cutoff).cast("timestamp"))


def vacuum_quarantine(
    spark: SparkSession, path: str, retention_days: int = 30, today: date | None = None
) -> dict:
    """Remove rows resolved before the cutoff. Only days that lose rows are rewritten."""
    df = read_table_if_present(spark, path)
    if df is None:
        return {"removed": 0, "remaining": 0}
    keep = F.coalesce(still_quarantined((today or date.today()) - timedelta(days=retention_days)), F.lit(False))
    # One row per day directory, so the list grows with the calendar, not with the data.
    days = df.groupBy(*_DAY).agg(F.count(F.lit(1)).alias("before"), F.count_if(keep).alias("after")).collect()
    changed = [r for r in days if r["after"] < r["before"]]
    rewritten = [(r["year"], r["month"], r["day"]) for r in changed if r["after"]]
    if rewritten:
        touched = spark.createDataFrame(rewritten, df.select(*_DAY).schema)
        same_day = [F.col(f"q.{c}").eqNullSafe(F.col(f"d.{c}")) for c in _DAY]
        kept = df.filter(keep).alias("q").join(touched.alias("d"), same_day, "left_semi")
        overwrite_partitions(kept, path, _DAY)
    for row in changed:
        if not row["after"]:
            drop_partition(spark, path, {c: _directory_value(row[c]) for c in _DAY})
    return {
        "removed": sum(r["before"] - r["after"] for r in changed),
        "remaining": sum(r["after"] for r in days),
    }


def _directory_value(value: object) -> object:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else value


def maintain_table(
    spark: SparkSession, path: str, warm_path: str, dedup_key: str | None = None, today: date | None = None
) -> list[Compaction]:
    """Compact yesterday; on the first day of a month also merge the month before into the warm tier."""
    today = today or date.today()
    done = [compact_yesterday(spark, path, dedup_key, today)]
    if today.day == 1:
        before = today - timedelta(days=1)
        done.append(compact_month(spark, path, warm_path, before.year, before.month, dedup_key))
    return done
