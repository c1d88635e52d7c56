"""Staging views, fact projection and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators import features as feature_ops
from cardmill.operators.packed import pack, unpack

# Columns of the fact projection, in order.
FACT_COLUMNS = (
    "transaction_id", "transaction_date", "user_id", "card_id", "merchant_id", "merchant_city", "merchant_state",
    "amount", "amount_currency", "is_refund", "is_online_transaction", "mcc", "mcc_description", "card_brand",
    "card_type", "use_chip", "error_bad_pin", "error_bad_cvv", "error_bad_card_number", "error_bad_expiration",
    "error_bad_zipcode", "error_insufficient_balance", "error_technical_glitch", "has_error", "is_fraud", "is_valid",
    "_batch_id", "year", "month", "day",
)

# Columns of the fraud mart, in order.
MART_COLUMNS = (
    "transaction_id", "transaction_date", "user_id", "amount", "amount_currency", "mcc_description", "card_brand",
    "card_type", "merchant_city", "merchant_state", "is_fraud", "current_age", "gender", "credit_score",
    "yearly_income", "txn_count_last_1h", "txn_count_last_24h", "txn_count_last_7d", "amount_sum_last_24h",
    "amount_vs_user_avg_ratio", "is_night_txn", "is_weekend", "is_foreign_merchant", "card_on_dark_web", "risk_score",
    "merchant_fraud_rate", "merchant_risk_tier", "year", "month", "day",
)

# Columns of valid transactions from which the mart, its features and its merchants are made.
MART_SOURCE_COLUMNS = (
    "transaction_id", "transaction_date", "user_id", "merchant_id", "amount", "amount_currency", "mcc", "mcc_description",
    "card_brand", "card_type", "merchant_city", "merchant_state", "is_fraud", "card_on_dark_web", "year", "month", "day",
)

# Columns of the staging views that are not passed to consumers.
_TRANSACTION_VIEW_DROPS = ("card_on_dark_web", "_source_file")
_USER_VIEW_DROPS = ("is_valid", "_source_file")
_CARD_VIEW_DROPS = ("is_valid", "_source_file")


def staging_transactions(txns: DataFrame) -> DataFrame:
    """Valid transactions with the amount as double."""
    return txns.filter("is_valid").withColumn("amount", F.col("amount").cast("double")).drop(*_TRANSACTION_VIEW_DROPS)


def staging_users(users: DataFrame) -> DataFrame:
    return users.filter("user_id IS NOT NULL").drop(*_USER_VIEW_DROPS)


def staging_cards(cards: DataFrame) -> DataFrame:
    return cards.filter("card_id IS NOT NULL").drop(*_CARD_VIEW_DROPS)


def fact_transactions(txns: DataFrame) -> DataFrame:
    return txns.filter("is_valid").withColumn("amount", F.col("amount").cast("double")).select(*FACT_COLUMNS)


def _volume(amount: str = "amount"):
    """Counts and sums shared by the marts. Amounts are summed as decimals, so the order of rows does not matter."""
    return [
        F.count(F.lit(1)).alias("total_txn_count"),
        fn.count_where(F.col("is_fraud")).alias("fraud_txn_count"),
        F.sum(amount).alias("_sum"),
        F.count(amount).alias("_n"),
    ]


def _average():
    return F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double"))


def user_daily_stats(txns: DataFrame) -> DataFrame:
    """Volume, amounts, frauds and distinct merchants per user and day.

    Rows are dealt once, by user and day: a distinct count by itself moves nearly all rows twice, once by merchant too.
    The parts of the day follow from it and aren't moved.
    """
    day = F.to_date("transaction_date").alias("txn_date")
    rows = txns.filter("is_valid").select("user_id", day, "merchant_id", "amount", "is_fraud")
    daily = (
        rows.repartition("user_id", "txn_date")
        .groupBy("user_id", "txn_date")
        .agg(
            *_volume(),
            F.max("amount").cast("double").alias("max_amount"),
            F.count_distinct("merchant_id").alias("distinct_merchants"),
        )
    )
    return daily.select(
        "user_id",
        F.year("txn_date").alias("year"),
        F.month("txn_date").alias("month"),
        F.dayofmonth("txn_date").alias("day"),
        "txn_date",
        "total_txn_count",
        "fraud_txn_count",
        "max_amount",
        "distinct_merchants",
        F.col("_sum").cast("double").alias("total_amount"),
        _average().alias("avg_amount"),
    )


def merchant_risk_score(txns: DataFrame) -> DataFrame:
    """Volume, fraud rate and risk tier per merchant, month and merchant code."""
    monthly = txns.filter("is_valid").groupBy("merchant_id", "year", "month", "mcc_description").agg(*_volume())
    rated = monthly.withColumns(
        {"fraud_rate": fn.share(F.col("fraud_txn_count"), F.col("total_txn_count")), "avg_amount": _average()}
    )
    return rated.withColumn("risk_tier", fn.risk_tier(F.col("fraud_rate"))).drop("_sum", "_n")


# Feature columns of the mart, with the type they get there.
_MEASURES = {
    "txn_count_last_1h": "int", "txn_count_last_24h": "int", "txn_count_last_7d": "int", "amount_sum_last_24h": "double",
    "amount_vs_user_avg_ratio": "double", "risk_score": "double",
}


# Texts of the mart's rows that are moved as one: no join or window looks at them.
_CARRIED = ("amount_currency", "mcc_description", "card_brand", "card_type", "merchant_city", "merchant_state")


def fraud_mart(facts: DataFrame, users: DataFrame, features: DataFrame, merchants: DataFrame) -> DataFrame:
    """Facts with the current user version, the features and the merchant's risk.

    The widest join, on the transaction id, comes first; the others add few
    narrow columns. ``users`` may hold closed versions.
    """
    measured = features.select(
        "transaction_id",
        *(F.col(c).cast(kind).alias(c) for c, kind in _MEASURES.items()),
        "is_night_txn",
        "is_weekend",
        "is_foreign_merchant",
        "card_on_dark_web",
    )
    own = [c for c in MART_SOURCE_COLUMNS if c not in ("mcc", "card_on_dark_web")]
    slim = pack(facts.select(*own), _CARRIED)
    joined = _with_user_and_merchant(slim.join(measured, "transaction_id", "left"), users, merchants)
    return unpack(joined, _CARRIED).withColumn("amount", F.col("amount").cast("double")).select(*MART_COLUMNS)


def fraud_mart_of(valid: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """The mart of valid transactions whose features are not stored.

    Features are added to the mart's own rows, which are dealt by user for that: neither they nor the user's columns need
    another shuffle.
    """
    own = [c for c in MART_SOURCE_COLUMNS if c != "mcc"]
    rows = feature_ops.velocity(pack(valid.select(*own), _CARRIED))
    typed = rows.withColumns(
        {c: F.col(c).cast(kind) if c in rows.columns else F.lit(None).cast(kind) for c, kind in _MEASURES.items()}
    )
    joined = unpack(_with_user_and_merchant(typed, users, merchants), _CARRIED)
    return feature_ops.add_time_and_place_flags(joined).withColumn("amount", F.col("amount").cast("double")).select(*MART_COLUMNS)


def _with_user_and_merchant(rows: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    current = users.filter("is_current").select(
        "user_id", "current_age", "gender", "credit_score", F.col("yearly_income").cast("double").alias("yearly_income")
    )
    risk = merchants.select(
        "merchant_id",
        F.col("fraud_rate").cast("double").alias("merchant_fraud_rate"),
        F.col("risk_tier").alias("merchant_risk_tier"),
    )
    return rows.join(current, "user_id", "left").join(risk, "merchant_id", "left")
