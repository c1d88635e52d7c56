"""Compaction by real file sizes: small files are gathered into files of about the wanted size, large ones stay.

The listing of a folder gives the sizes. Files below half the wanted size are put into bins of half to one and a half
times that size, and the files of a bin become one file in one task: they are read one after the other and sorted. No row
of a small bin is shuffled; a bin that is too much for the sort of one task is sorted as ranges, stored, and its file is
written from them one after the other. Only where rows of one key are repeated are the files that hold them brought
together by key, and these files alone. New files are complete before old ones go (``sinks.swap.exchange_files``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from cardmill import files
from cardmill.operators.dedup import latest_where_keyed
from cardmill.plans.maintenance import HOT_FILE_BYTES, WARM_FILE_BYTES
from cardmill.session import scratch_path
from cardmill.sinks import recover, recover_partitions
from cardmill.sinks.swap import INCOMING, exchange_files, finish_exchange, pack_folder, put_in_place, swap_folder

# Frames written by one job: bounds its plan, not its data.
FRAMES_AT_ONCE = 128
# Stored bytes that one task sorts; in memory rows take about twenty times that.
SORT_BYTES = 16 * 1024 * 1024
_BIN = "repack_bin"
# Otherwise Spark unites frames of one partition each into one partition.
KEEP_APART = "spark.sql.unionOutputPartitioning"


@dataclass(frozen=True)
class Repacked:
    """What was rewritten: files before and after, files left alone, rows written, and rows that went as copies."""

    path: str
    before: int = 0
    after: int = 0
    kept: int = 0
    rows: int = 0
    copies: int = 0


def bins(sizes: Sequence[tuple[str, int]], wanted: int) -> list[list[str]]:
    """Files below half the wanted size, in bins of half to one and a half times it; one that stays alone is no bin.

    Whatever is left over joins the last bin, or shares with it if both are too much for one file. Only when all small
    files together are less than half the size do they make one smaller file.
    """
    small = sorted(((size, name) for name, size in sizes if size < wanted / 2), reverse=True)
    packed: list[list[tuple[int, str]]] = [[]]
    for item in small:
        if sum(size for size, _ in packed[-1]) >= wanted:
            packed.append([])
        packed[-1].append(item)
    if len(packed) > 1 and sum(size for size, _ in packed[-1]) < wanted / 2:
        last = sorted(packed.pop() + packed.pop(), reverse=True)
        halves: list[list[tuple[int, str]]] = [[], []] if sum(size for size, _ in last) > 1.5 * wanted else [[]]
        for item in last:
            min(halves, key=lambda half: sum(size for size, _ in half)).append(item)
        packed += halves
    return [sorted(name for _, name in each) for each in packed if len(each) > 1]


def _newest(df: DataFrame) -> list[str]:
    return [c for c in ("_loaded_at", "_ingested_at") if c in df.columns]


def _order(df: DataFrame, key: str | None) -> list[str]:
    return [c for c in ("user_id", key) if c and c in df.columns]


def _read(spark: SparkSession, base: str, names: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", base).option("mergeSchema", True).parquet(*(f"{base}/{n}" for n in names))


def _files_with_copies(df: DataFrame, base: str, key: str) -> list[str]:
    """Names of the files that hold a key more than once in all; only keys and file names are moved."""
    keyed = df.select(F.col(key).alias("_key"), F.col("_metadata.file_path").alias("_file")).filter("_key IS NOT NULL")
    repeated = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.collect_set("_file").alias("files")).filter("n > 1")
    found = repeated.select(F.explode("files").alias("file")).distinct().collect()  # at most the listed files
    root = base.rstrip("/").rsplit("/", 1)[-1]
    return sorted(r["file"].rsplit(f"/{root}/", 1)[-1] for r in found)


def _together(df: DataFrame, key: str | None) -> DataFrame:
    """The rows of a bin in one task, without a shuffle."""
    one, order = df.coalesce(1), _order(df, key)
    return one.sortWithinPartitions(*order) if order else one


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _cut(pieces: Sequence[tuple[DataFrame, int]], count: int) -> list[list[DataFrame]]:
    """Consecutive pieces in at most ``count`` lists of about equal size."""
    total, before = sum(size for _, size in pieces) or 1, 0
    lists: list[list[DataFrame]] = [[] for _ in range(count)]
    for df, size in pieces:
        lists[min(count - 1, int((before + size / 2) / total * count))].append(df)
        before += size
    return [frames for frames in lists if frames]


def _sorted_in_ranges(large: Sequence[tuple[DataFrame, int]], key: str | None, path: str) -> list[list[tuple[DataFrame, int]]]:
    """Each frame's rows, stored below ``path``, as frames that follow one another in their order; with their stored sizes.

    A range of about ``SORT_BYTES`` is sorted by a task of its own. Rows that agree in the order may be in several ranges.
    """
    rows = _united([df.withColumn(_BIN, F.lit(i)) for i, (df, _) in enumerate(large)])
    order = _order(rows, key)
    spread = F.xxhash64(*[f.name for f in rows.schema if isinstance(f.dataType, AtomicType)])
    ranges = max(1, ceil(sum(size for _, size in large) / SORT_BYTES))
    cut = rows.repartitionByRange(ranges, _BIN, *order, spread).sortWithinPartitions(_BIN, *order)
    cut.write.partitionBy(_BIN).parquet(path)
    found = []
    for i, (df, _) in enumerate(large):
        reader = rows.sparkSession.read.schema(rows.select(*df.columns).schema)
        folder = f"{path}/{_BIN}={i}"
        found.append([(reader.parquet(f"{folder}/{n}"), size) for n, size in files.data_files(rows.sparkSession, folder)])
    return found


def _bins_sorted(
    unique: tuple[DataFrame, int] | None, gathered: Sequence[tuple[DataFrame, int]], key: str | None, wanted: int, path: str
) -> list[list[DataFrame]]:
    """What ``_write`` makes files of: rows without copies in files of about the wanted size, and one file for each bin."""
    found: list[list[DataFrame]] = []
    large = []
    if unique and unique[1] <= SORT_BYTES:
        order = _order(unique[0], key)
        found.append([unique[0].repartitionByRange(max(1, ceil(unique[1] / wanted)), *order).sortWithinPartitions(*order)])
    elif unique:
        large.append(unique)
    for df, size in gathered:
        if size > SORT_BYTES and _order(df, key):
            large.append((df, size))
        else:
            found.append([_together(df, key)])
    for each, pieces in zip(large, _sorted_in_ranges(large, key, path) if large else ()):
        count = max(1, ceil(sum(size for _, size in pieces) / wanted)) if each is unique else 1
        found += [[df.coalesce(1) for df in frames] for frames in _cut(pieces, count)]
    return found


def _write(bins: Sequence[Sequence[DataFrame]], folder: str, compression: str) -> int:
    """Write each bin: its only frame's partitions as files of their own, or its frames one after the other as one file.

    One job takes as many frames as its plan may hold.
    """
    conf = bins[0][0].sparkSession.conf
    jobs: list[list[Sequence[DataFrame]]] = [[]]
    for frames in bins:
        if jobs[-1] and sum(map(len, jobs[-1])) + len(frames) > FRAMES_AT_ONCE:
            jobs.append([])
        jobs[-1].append(frames)
    rows, before = 0, conf.get(KEEP_APART, None)
    conf.set(KEEP_APART, "false")
    try:
        for job in jobs:
            counted = Observation()
            union = _united([frames[0] if len(frames) == 1 else _united(frames).coalesce(1) for frames in job])
            observed = union.observe(counted, F.count(F.lit(1)).alias("rows"))
            observed.write.mode("append").option("compression", compression).parquet(folder)
            rows += counted.get["rows"]
    finally:
        conf.unset(KEEP_APART) if before is None else conf.set(KEEP_APART, before)
    return rows


def _rewrite(
    spark: SparkSession,
    base: str,
    sizes: Mapping[str, int],
    copies: Sequence[str],
    gathered: Sequence[Sequence[str]],
    key: str | None,
    wanted: int,
    folder: str,
    compression: str,
) -> int:
    """Write the files with ``copies`` without them, and each bin of ``gathered`` as one file; the number of rows written."""
    unique, path = None, scratch_path(spark, "sorted")
    if copies:
        df = _read(spark, base, copies)
        unique = latest_where_keyed(df, key, _newest(df)), sum(sizes[n] for n in copies)
    each = [(_read(spark, base, names), sum(sizes[n] for n in names)) for names in gathered]
    try:
        return _write(_bins_sorted(unique, each, key, wanted, path), folder, compression)
    finally:
        files.delete(spark, path)


def repack_folder(
    spark: SparkSession, folder: str, key: str | None = None, wanted: int = HOT_FILE_BYTES, compression: str = "snappy"
) -> Repacked:
    """Gather the small files of one folder; with a ``key`` only its newest row stays.

    A folder that is missing, empty, or has nothing to gather is left as it is.
    """
    recover(spark, folder)
    finish_exchange(spark, folder)
    listed = files.data_files(spark, folder)
    if not listed:
        return Repacked(folder)
    sizes, old = dict(listed), []
    if key:
        old = _files_with_copies(_read(spark, folder, list(sizes)), folder, key)
    copied = _read(spark, folder, old).count() if old else 0
    copies, gathered = old, bins([(n, s) for n, s in listed if n not in set(old)], wanted)
    old = [*old, *(n for names in gathered for n in names)]
    if not old:
        return Repacked(folder, kept=len(listed))
    moved = copied + (_read(spark, folder, [n for names in gathered for n in names]).count() if gathered else 0)  # from footers
    rows = _rewrite(spark, folder, sizes, copies, gathered, key, wanted, f"{pack_folder(folder)}/{INCOMING}", compression)
    exchange_files(spark, folder, old)
    kept = len(listed) - len(old)
    return Repacked(folder, len(old), len(files.data_files(spark, folder)) - kept, kept, rows, moved - rows)


def repack_day(
    spark: SparkSession, path: str, day: date, key: str | None = None, wanted: int = HOT_FILE_BYTES
) -> Repacked:
    """``repack_folder`` for one day of a table."""
    recover_partitions(spark, path)
    return repack_folder(spark, f"{path}/year={day.year}/month={day.month}/day={day.day}", key, wanted)


def repack_month(
    spark: SparkSession,
    path: str,
    warm_path: str,
    year: int,
    month: int,
    key: str | None = None,
    wanted: int = WARM_FILE_BYTES,
    compression: str = "zstd",
) -> Repacked:
    """Merge the days of a month into one folder of the warm tier; the days stay where they are.

    Every file is written anew, as the codec changes: small ones in bins, a larger one by itself. Keys that occur in
    several files are brought together, with these files alone.
    """
    for table in (path, warm_path):
        recover_partitions(spark, table)
    base, output = f"{path}/year={year}/month={month}", f"{warm_path}/year={year}/month={month}"
    days = [n for n in files.children(spark, base) if n.startswith("day=")]
    listed = [(f"{d}/{n}", size) for d in sorted(days) for n, size in files.data_files(spark, f"{base}/{d}")]
    if not listed:
        return Repacked(output)
    sizes = dict(listed)
    old = _files_with_copies(_read(spark, base, list(sizes)), base, key) if key else []
    rest = [(n, s) for n, s in listed if n not in set(old)]
    gathered = bins(rest, wanted)
    alone = [[n] for n, _ in rest if n not in {n for names in gathered for n in names}]
    before = _read(spark, base, list(sizes)).count()
    recover(spark, output)
    rows = _rewrite(spark, base, sizes, old, [*gathered, *alone], key, wanted, f"{swap_folder(output)}/{INCOMING}", compression)
    put_in_place(spark, output)
    return Repacked(output, len(listed), len(files.data_files(spark, output)), 0, rows, before - rows)
