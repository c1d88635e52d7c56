"""Velocity, averages, time and place flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators import features as ops
from cardmill.queries import oracle, tables
from cardmill.queries.registry import query

TARGET = date(2024, 1, 15)

# Users above this many rows take the split way in the query that shows it.
SPLIT_ROWS = 64

_VELOCITY = f"""
SELECT transaction_id, user_id, txn_count_last_1h, txn_count_last_24h, txn_count_last_7d, amount_sum_last_1h,
  amount_sum_last_24h FROM ({oracle.features_sql('q_ev')})"""

_VELOCITY_COLUMNS = ("transaction_id", "user_id", *ops.COUNT_FRAMES, *ops.SUM_FRAMES)


@query(_VELOCITY)
def velocity_features(spark: SparkSession, folder: str) -> DataFrame:
    return ops.velocity(tables.event_transactions(spark, folder)).select(*_VELOCITY_COLUMNS)


@query(_VELOCITY)
def velocity_features_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same features with every busy user split over tasks."""
    return ops.velocity(tables.event_transactions(spark, folder), hot_rows=SPLIT_ROWS).select(*_VELOCITY_COLUMNS)


_RATIO = """
SELECT transaction_id, av AS user_avg_amount, CASE WHEN av > 0 THEN CAST(amount AS DOUBLE) / av END AS amount_vs_user_avg_ratio
FROM (SELECT *, CAST(sum(amount) OVER w AS DOUBLE) / count(amount) OVER w AS av FROM q_evs
      WINDOW w AS (PARTITION BY user_id ORDER BY sec, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(_RATIO)
def running_avg_ratio(spark: SparkSession, folder: str) -> DataFrame:
    featured = ops.velocity(tables.event_transactions(spark, folder))
    return featured.select("transaction_id", "user_avg_amount", "amount_vs_user_avg_ratio")


@query(_RATIO)
def running_avg_ratio_split(spark: SparkSession, folder: str) -> DataFrame:
    featured = ops.velocity(tables.event_transactions(spark, folder), hot_rows=SPLIT_ROWS)
    return featured.select("transaction_id", "user_avg_amount", "amount_vs_user_avg_ratio")


@query(oracle.features_sql("q_ev"))
def fraud_features(spark: SparkSession, folder: str) -> DataFrame:
    return ops.fraud_features(tables.event_transactions(spark, folder))


_EIGHT_DAYS = "(SELECT * FROM q_ev WHERE transaction_date >= TIMESTAMP '2024-01-08 00:00:00' AND transaction_date < TIMESTAMP '2024-01-16 00:00:00')"


@query(f"SELECT * FROM ({oracle.features_sql(_EIGHT_DAYS)}) WHERE day = 15")
def daily_features_lookback(spark: SparkSession, folder: str) -> DataFrame:
    return ops.daily_features(tables.event_transactions(spark, folder), TARGET)


@query(
    "SELECT l.* EXCLUDE (amount_vs_user_avg_ratio), a.amount_vs_user_avg_ratio FROM ("
    + f"SELECT * FROM ({oracle.features_sql(_EIGHT_DAYS)}) WHERE day = 15) l JOIN ({_RATIO}) a ON l.transaction_id = a.transaction_id"
)
def daily_features_lifetime(spark: SparkSession, folder: str) -> DataFrame:
    """One day, with the average over the user's whole history carried in as totals."""
    txns = tables.event_transactions(spark, folder)
    return ops.daily_features(txns, TARGET, ops.amounts_before(ops.daily_amounts(txns), TARGET))


# Three runs of days: before the second and the third there are days that no lookback holds.
SEVERAL = (date(2024, 1, 5), date(2024, 1, 15), date(2024, 1, 16), date(2024, 1, 28))


@query(f"SELECT * FROM ({oracle.features_sql('q_ev')}) WHERE day IN (5, 15, 16, 28)")
def features_on_days(spark: SparkSession, folder: str) -> DataFrame:
    """Several target days in one pass, averages over the whole history."""
    txns = tables.event_transactions(spark, folder)
    return ops.features_on_days(txns, SEVERAL, ops.daily_amounts(txns))


@query(f"SELECT * FROM ({oracle.features_sql('q_ev')}) WHERE day IN (5, 15, 16, 28)")
def features_on_days_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every busy user split over tasks."""
    txns = tables.event_transactions(spark, folder)
    return ops.features_on_days(txns, SEVERAL, ops.daily_amounts(txns), hot_rows=SPLIT_ROWS)


@query(
    "SELECT transaction_id, hour(transaction_date) BETWEEN 0 AND 5 AS is_night_txn, "
    "dayofweek(transaction_date) IN (0, 6) AS is_weekend FROM q_ev"
)
def time_flags(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("transaction_date")
    return tables.event_transactions(spark, folder).select(
        "transaction_id", fn.is_night(ts).alias("is_night_txn"), fn.is_weekend(ts).alias("is_weekend")
    )


@query(
    f"SELECT id, merchant_state, merchant_state NOT IN ({oracle.US_STATES}) AS is_foreign_merchant FROM q_raw_txn"
)
def foreign_flag(spark: SparkSession, folder: str) -> DataFrame:
    return tables.raw_transactions(spark, folder).select(
        "id", "merchant_state", fn.foreign_state(F.col("merchant_state")).alias("is_foreign_merchant")
    )
