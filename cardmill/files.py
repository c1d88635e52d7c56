"""File-system calls through the session's Hadoop configuration (HDFS, object store or local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    source_path, fs = _path(spark, source)
    target_path, _ = _path(spark, target)
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot rename {source} to {target}")


def size(spark: SparkSession, path: str) -> int:
    target, fs = _path(spark, path)
    return fs.getContentSummary(target).getLength()


def has_data(spark: SparkSession, path: str) -> bool:
    """The path exists and holds at least one entry that is not a marker file."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return False
    return any(not status.getPath().getName().startswith(("_", ".")) for status in fs.listStatus(target))


def children(spark: SparkSession, path: str) -> list[str]:
    target, fs = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def mkdirs(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.mkdirs(target)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and sizes of the data files of one folder, by name; marker files are left out."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(target) if s.isFile()]
    return sorted((name, size) for name, size in found if not name.startswith(("_", ".")))
