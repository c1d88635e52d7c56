"""Replacing a folder in steps of which each can be the last before a crash.

The new folder is written, complete, to a swap folder beside the old one. Its name starts with a dot, so no reader takes
it for data, also inside a partitioned table. Then the old folder moves into the swap folder, the new one takes its
place, and the swap folder goes. One writer at a time; a reader that finds a swap left behind ends it first.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cardmill import files

INCOMING, OUTGOING, READY = "incoming", "outgoing", "ready"


def swap_folder(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.swap-{name.replace('=', '-')}"


def recover(spark: SparkSession, path: str) -> bool:
    """End or undo a replacement that was interrupted; True if there was one."""
    swap = swap_folder(path)
    if not files.exists(spark, swap):
        return False
    incoming, outgoing = f"{swap}/{INCOMING}", f"{swap}/{OUTGOING}"
    if not files.exists(spark, path) and files.exists(spark, outgoing):
        # The old folder only moves away when the new one is complete.
        files.rename(spark, incoming if files.exists(spark, incoming) else outgoing, path)
    files.delete(spark, swap)
    return True


def put_in_place(spark: SparkSession, path: str) -> None:
    """Exchange ``path`` for the complete folder in its swap folder."""
    swap = swap_folder(path)
    if files.exists(spark, path):
        files.rename(spark, path, f"{swap}/{OUTGOING}")
    try:
        files.rename(spark, f"{swap}/{INCOMING}", path)
    except Exception:  # Hadoop's errors come as Java errors
        if not files.exists(spark, path) and files.exists(spark, f"{swap}/{OUTGOING}"):
            files.rename(spark, f"{swap}/{OUTGOING}", path)
        raise
    files.delete(spark, swap)


def pack_folder(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.pack-{name.replace('=', '-')}"


def exchange_files(spark: SparkSession, path: str, old: list[str]) -> None:
    """Replace some files of a folder by the complete files in the ``incoming`` folder of its pack folder.

    The names of the old files are noted as empty folders; the ``ready`` folder is the commit. What a stop leaves undone
    after it is done by ``finish_exchange``: every step can be repeated.
    """
    pack = pack_folder(path)
    for name in old:
        files.mkdirs(spark, f"{pack}/{OUTGOING}/{name}")
    files.mkdirs(spark, f"{pack}/{READY}")
    finish_exchange(spark, path)


def finish_exchange(spark: SparkSession, path: str) -> bool:
    """End an exchange of files that was committed, undo one that was not; True if there was one."""
    pack = pack_folder(path)
    if not files.exists(spark, pack):
        return False
    if files.exists(spark, f"{pack}/{READY}"):
        for name in files.children(spark, f"{pack}/{OUTGOING}"):
            files.delete(spark, f"{path}/{name}")
        for name, _ in files.data_files(spark, f"{pack}/{INCOMING}"):
            files.rename(spark, f"{pack}/{INCOMING}/{name}", f"{path}/{name}")
    files.delete(spark, pack)
    return True


def recover_partitions(spark: SparkSession, path: str) -> int:
    """``recover`` and ``finish_exchange`` for the partition folders below a table; lists folders, not files."""
    done = 0
    for name in files.children(spark, path):
        if name.startswith(".swap-"):
            done += recover(spark, f"{path}/{_folder(name)}")
        elif name.startswith(".pack-"):
            done += finish_exchange(spark, f"{path}/{_folder(name)}")
        elif "=" in name:
            done += recover_partitions(spark, f"{path}/{name}")
    return done


def _folder(hidden: str) -> str:
    return hidden.removeprefix(".swap-").removeprefix(".pack-").replace("-", "=", 1)
