"""Dimensions: latest snapshot (type 1), versioned history (type 2), lookups in time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators.asof import as_of
from cardmill.operators.dedup import latest_per_key

# End of a version that is still open.
OPEN_END = datetime(9999, 12, 31)

# User columns whose change opens a new version.
TRACKED_USER_COLUMNS = (
    "address",
    "latitude",
    "longitude",
    "yearly_income",
    "total_debt",
    "credit_score",
    "per_capita_income",
    "current_age",
    "num_credit_cards",
)

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current", "closed_at")


def type1(snapshot: DataFrame, key: str, newest: Sequence[str], tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """The newest row of each key replaces what was there."""
    return latest_per_key(snapshot.filter(F.col(key).isNotNull()), [key], newest, tiebreak)


def _instant(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def first_versions(snapshot: DataFrame, key: str, as_of: datetime) -> DataFrame:
    """Every key of a snapshot (one row per key) as an open version."""
    return snapshot.filter(F.col(key).isNotNull()).withColumns(
        {"valid_from": _instant(as_of), "valid_to": _instant(OPEN_END), "is_current": F.lit(True)}
    )


def type2_merge(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str = "user_id",
    tracked: Sequence[str] = TRACKED_USER_COLUMNS,
    as_of: datetime | None = None,
) -> DataFrame:
    """Versioned merge of a snapshot (one row per key) into a dimension.

    A changed key has its open version closed and a new one opened; a new key is
    opened; a key missing from the snapshot stays open; closed versions are never
    touched and never shuffled. One full outer join on the key yields both rows
    of a change.
    """
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    columns = [*snapshot.columns, *(c for c in dim.columns if c not in snapshot.columns)]
    complete = dim.select(*(_or_null(dim, snapshot, c) for c in columns))
    fresh = first_versions(snapshot, key, as_of)
    fresh = fresh.select(*(_or_null(fresh, dim, c) for c in columns))

    closed = complete.filter(~F.col("is_current"))
    pairs = (
        complete.filter("is_current")
        .select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
        .join(fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("new")), "_key", "full_outer")
    )
    differs = reduce(or_, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked))
    is_new, is_gone = F.col("old").isNull(), F.col("new").isNull()
    ended = F.col("old").withField("valid_to", _instant(as_of)).withField("is_current", F.lit(False))
    rows = (
        F.when(is_new, F.array("new"))
        .when(is_gone | ~differs, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    merged = pairs.select(F.explode(rows).alias("row")).select("row.*")
    return closed.unionByName(merged)


def _or_null(df: DataFrame, other: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(other.schema[name].dataType).alias(name)


def version_at(facts: DataFrame, dim: DataFrame, key: str, ts: str, attributes: Sequence[str]) -> DataFrame:
    """Attributes of the version that was valid when the fact happened."""
    return as_of(facts, dim, key, ts, attributes)


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Keyed append: rows of ``updates`` replace rows of the same key; columns are synchronised by name."""
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def latest_batch(df: DataFrame, batch: str = "_batch_id") -> DataFrame:
    """Rows of the newest batch."""
    return df.filter(F.col(batch) == df.select(F.max(batch)).scalar())


def merchant_dimension(txns: DataFrame) -> DataFrame:
    """One row per merchant with volume, fraud rate and risk tier.

    Rows are counted by merchant and texts first: an aggregate that holds the largest text sorts its input, so it gets the
    few rows that are left.
    """
    texts = ("merchant_city", "merchant_state", "mcc_description")
    counted = txns.filter("merchant_id IS NOT NULL").groupBy("merchant_id", *texts).agg(
        F.max("mcc").alias("mcc"),
        F.count(F.lit(1)).alias("total_txn_count"),
        fn.count_where(F.col("is_fraud")).alias("fraud_txn_count"),
        F.sum("amount").alias("_sum"),
        F.count("amount").alias("_n"),
    )
    rolled = counted.groupBy("merchant_id").agg(
        *(F.max(c).alias(c) for c in ("merchant_city", "merchant_state", "mcc", "mcc_description")),
        *(F.sum(c).alias(c) for c in ("total_txn_count", "fraud_txn_count", "_sum", "_n")),
    )
    return (
        rolled.withColumn("fraud_rate", fn.share(F.col("fraud_txn_count"), F.col("total_txn_count")))
        .withColumn("avg_amount", F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double")))
        .withColumn("risk_tier", fn.risk_tier(F.col("fraud_rate")))
        .drop("_sum", "_n")
    )
