"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import files

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Rows derived from that much of files packed as the test tables take about 28 MB in a shuffle (5.3 times the bytes).
INPUT_BYTES_PER_PARTITION = 5 << 20

# A side of a join whose files are no larger is sent to all tasks (the 360 000 suppliers of 6 GB are 8 MB).
SMALL_TABLE_BYTES = 32 << 20

# Intermediate tables are written and read a few times: small files count more than the time to pack them.
SCRATCH_CODEC = "zstd"

# Settings that can be changed on a running session. Sizes and executor shape
# belong to the deployment, so none of them is set here.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot key is worth one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows are kept packed in a shuffle and take about ten times that in a sort or hash table: tasks get 24 MB, not 64.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24m",
    # As many partitions as a large table needs for that, or more (``size_shuffles``); of a small one they are put together.
    INITIAL_PARTITIONS: "1000",
    # The same for tasks that sort or hash what they read from files.
    "spark.sql.files.maxPartitionBytes": "32m",
    # A side whose partitions are all small is hashed, so that the other, larger one needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "24m",
    # The JVM compiles no method above 8000 bytes: a stage that has one is faster as separate, smaller projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_SCRATCH_ROOTS: dict[str, str] = {}
_SCRATCH_TABLES: list[str] = []
_RUN_TABLES: ContextVar[list[str] | None] = ContextVar("run_tables", default=None)


def build_session(app_name: str = "cardmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on to an existing session. A larger number of partitions it has stays."""
    for name, value in SQL_SETTINGS.items():
        if name != INITIAL_PARTITIONS:
            spark.conf.set(name, value)
    size_shuffles(spark)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int = 0) -> None:
    """At least as many partitions, before they are put together, as the session asks for and as input of that size needs.

    The number is never lowered, so frames that are planned but not yet run keep theirs.
    """
    known = (SQL_SETTINGS[INITIAL_PARTITIONS], spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(INITIAL_PARTITIONS, "1"))
    wanted = max(math.ceil(input_bytes / INPUT_BYTES_PER_PARTITION), *map(int, known))
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. A local folder is used
    only by a local session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _SCRATCH_ROOTS:
        _SCRATCH_ROOTS[app] = tempfile.mkdtemp(prefix="cardmill-")
    return _SCRATCH_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    run = _RUN_TABLES.get()
    (_SCRATCH_TABLES if run is None else run).append(path)
    return path


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside, however it ends. Tables of other runs stay."""
    paths: list[str] = []
    token = _RUN_TABLES.set(paths)
    try:
        yield
    finally:
        _RUN_TABLES.reset(token)
        for path in paths:
            files.delete(spark, path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables made outside of any run. DataFrames that read them end with it."""
    removed = 0
    while _SCRATCH_TABLES:
        removed += files.delete(spark, _SCRATCH_TABLES.pop())
    return removed


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: fixed rows, no lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, file_bytes: int) -> DataFrame:
    """Sent to all tasks by a join where its files are known to be small, whatever Spark guesses of it."""
    return F.broadcast(df) if file_bytes <= SMALL_TABLE_BYTES else df


def stored_small_side(df: DataFrame) -> DataFrame:
    """``small_side`` for a table that ``materialize`` returned."""
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    return small_side(df, sum(files.size(df.sparkSession, folder) for folder in folders))


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` returned, before its run ends."""
    for file in df.inputFiles()[:1]:
        files.delete(df.sparkSession, file.rsplit("/", 1)[0])
