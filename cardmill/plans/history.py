"""A type 2 dimension on disk: open versions in one partition, closed ones in a partition for each merge.

A merge reads and replaces the open versions and adds one folder with the versions it closes; older closed versions are
neither read nor written, and their files keep their names.

The replacement of the open partition is the commit. Whatever a merge closes is opened again at the same instant, so a
folder of closed versions belongs to the table if the open versions reach its instant. A merge that stops before its
commit leaves a folder beyond that instant: readers pass it by and the next merge deletes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import files
from cardmill.operators import dims
from cardmill.session import drop_table, materialize
from cardmill.sinks import recover, replace_table

PARTITION = "closed_at"
OPEN = "open"


def _folder(path: str, name: str) -> str:
    return f"{path}/{PARTITION}={name}"


def _stamp(instant: datetime) -> str:
    """Instants as texts in their order."""
    return instant.strftime("%Y%m%dT%H%M%S%f")


def exists(spark: SparkSession, path: str) -> bool:
    recover(spark, _folder(path, OPEN))
    return files.has_data(spark, _folder(path, OPEN))


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """The versions that are valid now; nothing else is read."""
    recover(spark, _folder(path, OPEN))
    return spark.read.parquet(_folder(path, OPEN))


def _reached(open_versions: DataFrame) -> str:
    """Instant of the last merge that was committed, from one column of the open versions."""
    last = open_versions.agg(F.date_format(F.max("valid_from"), "yyyyMMdd'T'HHmmssSSSSSS").alias("at")).first()["at"]
    return last or ""


def _closed(spark: SparkSession, path: str) -> list[str]:
    names = [n.removeprefix(f"{PARTITION}=") for n in files.children(spark, path) if n.startswith(f"{PARTITION}=")]
    return sorted(n for n in names if n != OPEN)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, open and closed. Columns that came later are NULL in older versions."""
    current = read_open(spark, path)
    last = _reached(current)
    folders = [_folder(path, n) for n in _closed(spark, path) if n <= last]
    if not folders:
        return current
    return current.unionByName(spark.read.option("mergeSchema", True).parquet(*folders), allowMissingColumns=True)


def merge(
    spark: SparkSession,
    path: str,
    snapshot: DataFrame,
    key: str = "user_id",
    tracked: Sequence[str] = dims.TRACKED_USER_COLUMNS,
    as_of: datetime | None = None,
) -> dict:
    """Merge a snapshot (one row per key) into the stored dimension; merges follow one another in time."""
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    stamp = _stamp(as_of)
    if not exists(spark, path):
        for name in _closed(spark, path):
            files.delete(spark, _folder(path, name))
        return {"open": replace_table(dims.first_versions(snapshot, key, as_of), _folder(path, OPEN)), "closed": 0}
    current = read_open(spark, path)
    last = _reached(current)
    if stamp < last:
        raise ValueError(f"a merge at {last} is stored, later than {stamp}")
    for name in _closed(spark, path):
        recover(spark, _folder(path, name))
        if name > last:
            files.delete(spark, _folder(path, name))
    merged = materialize(dims.type2_merge(current, snapshot, key, tracked, as_of), "versions")
    try:
        ended = merged.filter("NOT is_current")
        closed = 0 if ended.isEmpty() else _close(spark, ended, _folder(path, stamp))
        return {"open": replace_table(merged.filter("is_current"), _folder(path, OPEN)), "closed": closed}
    finally:
        drop_table(merged)


def _close(spark: SparkSession, ended: DataFrame, folder: str) -> int:
    """Store what a merge closes, beside what an earlier merge of the same instant has closed."""
    if files.has_data(spark, folder):
        ended = spark.read.parquet(folder).unionByName(ended, allowMissingColumns=True)
    return replace_table(ended, folder)
