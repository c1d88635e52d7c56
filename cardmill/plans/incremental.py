"""Tables that grow by batches: the newest row of each key, loaded batch by batch, each as often as it is sent.

The watermark is the newest batch that is stored. Batches from the watermark on are taken, so the last one may be sent
again, whole or corrected, and a batch older than it is left out. Rows replace rows of the same key; columns are matched
by name, and a column that comes later is NULL in older rows, one that is not sent any more is NULL in newer ones.

The table is cut into buckets of the key. A load reads and replaces the buckets its keys fall in; it is committed bucket
by bucket, and as it can be repeated, a load that stops is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import files
from cardmill.operators import dims, marts
from cardmill.operators.dedup import latest_per_key
from cardmill.plans.layout import Lake
from cardmill.session import drop_table, materialize
from cardmill.sinks import replace_partitions
from cardmill.sources import read_table

BUCKET = "key_bucket"
BUCKETS = 64


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows, with the columns of all batches; None before the first load."""
    stored = _stored(spark, path)
    return None if stored is None else stored.drop(BUCKET)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    if not files.has_data(spark, path):
        return None
    return spark.read.option("mergeSchema", True).parquet(path)


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def load_batches(spark: SparkSession, path: str, source: DataFrame, key: str, batch: str = "_batch_id") -> dict:
    """Bring a table up to the newest batch of ``source``. Rows without a key or a batch are left out.

    Of several rows of a key the one of the newest batch counts; equal ones are ranked by a hash over the whole row.
    """
    stored = _stored(spark, path)
    fresh = source.filter(F.col(key).isNotNull() & F.col(batch).isNotNull())
    if stored is not None:
        fresh = fresh.filter(F.col(batch) >= stored.select(F.max(batch)).scalar())
    updates = materialize(latest_per_key(fresh, [key], [batch]).withColumn(BUCKET, _bucket(key)), "batch")
    try:
        touched = sorted(r[0] for r in updates.select(BUCKET).distinct().collect())  # at most BUCKETS
        if not touched:
            return {"loaded": 0, "rows": 0 if stored is None else stored.count()}
        rows = updates
        if stored is not None:
            rows = dims.upsert(stored.filter(F.col(BUCKET).isin(touched)), updates, key)
        replace_partitions(rows, path, [BUCKET], [(b,) for b in touched])
        return {"loaded": updates.count(), "rows": _stored(spark, path).count()}
    finally:
        drop_table(updates)


def load_users(spark: SparkSession, lake: Lake) -> dict:
    """Newest state of every user, from the staged users by batch."""
    users = marts.staging_users(read_table(spark, lake.staging("users")))
    return load_batches(spark, lake.warehouse("users_by_batch"), users, "user_id")


def load_cards(spark: SparkSession, lake: Lake) -> dict:
    cards = marts.staging_cards(read_table(spark, lake.staging("cards")))
    return load_batches(spark, lake.warehouse("cards_by_batch"), cards, "card_id")
