"""Merchant totals in parts that add up: by day, by month, over all time.

A part holds counts, sums and maxima only, so parts merge into larger parts without the rows they come from. A maximum
cannot be taken back, so a day that changes is computed anew from its own rows, and whatever holds the day is merged
anew from its parts: the month from its days, the lifetime from the months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill import functions as fn

DAY_KEYS = ("merchant_id", "mcc_description", "year", "month", "day")
MONTH_KEYS = ("merchant_id", "mcc_description", "year", "month")

# Columns of a stored month, and of a stored day.
MONTH_SCHEMA = (
    "merchant_id string, mcc_description string, merchant_city string, merchant_state string, mcc int, total_txn_count bigint, "
    "fraud_txn_count bigint, amount_sum decimal(38,2), amount_count bigint, year int, month int"
)
DAY_SCHEMA = f"{MONTH_SCHEMA}, day int"

_LARGEST = ("merchant_city", "merchant_state", "mcc")
_ADDED = ("total_txn_count", "fraud_txn_count", "amount_sum", "amount_count")


def merchant_days(txns: DataFrame) -> DataFrame:
    """One part for each merchant, code and day of the valid transactions."""
    return txns.filter("is_valid").groupBy(*DAY_KEYS).agg(
        *(F.max(c).alias(c) for c in _LARGEST),
        F.count(F.lit(1)).alias("total_txn_count"),
        fn.count_where(F.col("is_fraud")).alias("fraud_txn_count"),
        F.sum("amount").cast("decimal(38,2)").alias("amount_sum"),
        F.count("amount").alias("amount_count"),
    )


def merged(parts: DataFrame, keys: Sequence[str], *largest: str) -> DataFrame:
    """Larger parts; ``largest`` are further columns of which the maximum is kept."""
    return parts.groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in (*_LARGEST, *largest)),
        *(F.sum(c).cast("decimal(38,2)" if c == "amount_sum" else "bigint").alias(c) for c in _ADDED),
    )


def merchant_months(days: DataFrame) -> DataFrame:
    return merged(days, MONTH_KEYS)


def _rated(parts: DataFrame) -> DataFrame:
    average = F.try_divide(F.col("amount_sum").cast("double"), F.col("amount_count").cast("double"))
    rated = parts.withColumns({"fraud_rate": fn.share(F.col("fraud_txn_count"), F.col("total_txn_count")), "avg_amount": average})
    return rated.withColumn("risk_tier", fn.risk_tier(F.col("fraud_rate"))).drop("amount_sum", "amount_count")


def merchant_dimension(parts: DataFrame) -> DataFrame:
    """One row for each merchant, from days or months."""
    return _rated(merged(parts.filter("merchant_id IS NOT NULL"), ["merchant_id"], "mcc_description"))


def merchant_risk_score(months: DataFrame) -> DataFrame:
    """Volume, fraud rate and risk tier per merchant, month and code, from whole months."""
    return _rated(months.drop(*_LARGEST))
