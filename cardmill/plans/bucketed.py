"""Transactions and features as catalog tables in buckets of the transaction id.

Both tables are dealt by the same key into the same number of buckets and sorted within them, so the widest join of the
mart, fact by feature, reads bucket beside bucket: its shuffle and sort were paid once, when the tables were written, and
no mart built from them pays again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from cardmill.operators import features, marts
from cardmill.plans import history
from cardmill.plans.layout import Lake
from cardmill.session import SCRATCH_CODEC
from cardmill.sources import read_table

KEY = "transaction_id"
BUCKETS = 256


# Input that becomes one bucket: about a million rows, which one task sorts.
BYTES_PER_BUCKET = 40 << 20


def bucket_count(input_bytes: int, least: int) -> int:
    return max(least, math.ceil(input_bytes / BYTES_PER_BUCKET))


def store(df: DataFrame, name: str, path: str, key: str = KEY, buckets: int = BUCKETS, dealt: bool = True) -> DataFrame:
    """Write ``df`` as the external table ``name`` and read it by name.

    One file for each bucket; without ``dealt`` each task adds a file to each bucket it has rows of, and no row is moved:
    for tables that are read once.
    """
    rows = df.repartition(buckets, key) if dealt else df
    writer = rows.write.mode("overwrite").option("path", path).option("compression", SCRATCH_CODEC)
    writer.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def store_pair(valid: DataFrame, database: str, folder: str, buckets: int = BUCKETS, dealt: bool = True) -> tuple[DataFrame, DataFrame]:
    """Valid transactions and their features as two tables in the same buckets."""
    valid.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    txns = store(valid, f"{database}.transactions", f"{folder}/transactions", buckets=buckets, dealt=dealt)
    built = store(features.fraud_features(txns), f"{database}.features", f"{folder}/features", buckets=buckets, dealt=dealt)
    return txns, built


def build_pair(spark: SparkSession, lake: Lake, database: str = "bucketed", buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """``store_pair`` for the staged transactions of a lake."""
    valid = read_table(spark, lake.staging("transactions")).filter("is_valid")
    return store_pair(valid, database, lake.path("bucketed", database), buckets)


def mart(spark: SparkSession, lake: Lake, database: str = "bucketed") -> DataFrame:
    """The fraud mart over the bucketed tables."""
    return marts.fraud_mart(
        marts.fact_transactions(spark.table(f"{database}.transactions")),
        history.read_open(spark, lake.warehouse("dim_users")),
        spark.table(f"{database}.features"),
        read_table(spark, lake.warehouse("dim_merchants")),
    )
