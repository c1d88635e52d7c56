"""Checks, gates and row counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators import quality as ops
from cardmill.operators.cleaning import quarantine_rows
from cardmill.plans import checks
from cardmill.queries import inputs, tables
from cardmill.queries.registry import query
from cardmill.session import scratch_path
from cardmill.sinks import overwrite_day, overwrite_partitions


def _check_sql(source: str, name: str, failing: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {failing}) AS failures, count(*) AS total, "
        f"count(*) FILTER (WHERE {failing}) = 0 AS passed FROM {source}"
    )


def _rows_sql(source: str, name: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failures, "
        f"count(*) AS total, count(*) > 0 AS passed FROM {source}"
    )


def _unique_sql(source: str, name: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE n > 1) AS failures, CAST(sum(n) AS BIGINT) AS total, "
        f"count(*) FILTER (WHERE n > 1) = 0 AS passed FROM (SELECT {key}, count(*) AS n FROM {source} "
        f"WHERE {key} IS NOT NULL GROUP BY {key}) g"
    )


_FORMATS = "amount_format NOT IN ('US', 'EU', 'CLEAN', 'VN', 'AMBIGUOUS', 'INVALID')"
_STAGING = " UNION ALL ".join(
    [
        _rows_sql("q_cleaned", "transactions.has_rows"),
        *(
            _check_sql("q_cleaned", f"transactions.not_null.{c}", f"{c} IS NULL")
            for c in ("transaction_id", "user_id", "amount_format", "is_valid")
        ),
        _check_sql("q_cleaned", "transactions.accepted_values.amount_format", _FORMATS),
        _unique_sql("q_cleaned", "transactions.unique.transaction_id", "transaction_id"),
        _rows_sql("q_users", "users.has_rows"),
        _check_sql("q_users", "users.not_null.user_id", "user_id IS NULL"),
        _unique_sql("q_users", "users.unique.user_id", "user_id"),
        _rows_sql("q_cards", "cards.has_rows"),
        _check_sql("q_cards", "cards.not_null.card_id", "card_id IS NULL"),
        _unique_sql("q_cards", "cards.unique.card_id", "card_id"),
    ]
)


@query(_STAGING)
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return ops.staging_checks(
        tables.cleaned_transactions(spark, folder), tables.users(spark, folder), tables.cards(spark, folder)
    )


# Day 16 gets the ids of day 15 besides its own, day 17 goes.
_CHANGED_DAYS = (
    "(SELECT * FROM q_evm WHERE day <> 17 UNION ALL SELECT * REPLACE (CAST(16 AS INT) AS day) FROM q_evm WHERE day = 15)"
)


@query(
    " UNION ALL ".join(
        [
            _rows_sql(_CHANGED_DAYS, "events.has_rows"),
            *(_check_sql(_CHANGED_DAYS, f"events.not_null.{c}", f"{c} IS NULL") for c in ("user_id", "merchant_id")),
            _check_sql(_CHANGED_DAYS, "events.accepted_values.merchant_state", "merchant_state NOT IN ('CA', 'NY', 'DC')"),
            _unique_sql(_CHANGED_DAYS, "events.unique.transaction_id", "transaction_id"),
        ]
    )
)
def dq_report_by_days(spark: SparkSession, folder: str) -> DataFrame:
    """The report from stored counts of days, after a day got repeated ids and another went."""
    root = scratch_path(spark, "checked")
    stored = checks.DayChecks(f"{root}/table", f"{root}/state", "transaction_id", ("user_id", "merchant_id"), {"merchant_state": ("CA", "NY", "DC")}, "events.")
    events = inputs.derive(spark, folder, inputs.EVENT_PAYMENTS)
    overwrite_partitions(events, stored.table, checks.DAY)
    stored.build(spark)
    more = events.filter("day = 15").withColumn("day", F.lit(16)).unionByName(events.filter("day = 16"))
    overwrite_day(more, stored.table, date(2024, 1, 16))
    stored.refresh(spark, [date(2024, 1, 16)])
    overwrite_day(events.filter("false"), stored.table, date(2024, 1, 17))
    stored.refresh(spark, [date(2024, 1, 17)])
    return stored.report(spark)


_RAW_GATE = " UNION ALL ".join(
    [
        _rows_sql("q_raw_txn", "transactions.has_rows"),
        _check_sql("q_raw_txn", "transactions.not_null.id", "id IS NULL"),
        _rows_sql("q_raw_mcc", "mcc_codes.has_rows"),
    ]
)


@query(f"""SELECT 'failed checks: ' || string_agg("check", ', ' ORDER BY "check") AS message FROM ({_RAW_GATE}) WHERE NOT passed""")
def gate(spark: SparkSession, folder: str) -> DataFrame:
    """What the gate says of a table with rows that lack an id."""
    report = ops.raw_checks(tables.raw_transactions(spark, folder), tables.raw_mcc_codes(spark, folder))
    try:
        ops.gate(report)
    except ops.QualityError as error:
        return spark.createDataFrame([(str(error),)], "message string")
    return spark.createDataFrame([], "message string")


@query(_RAW_GATE)
def raw_gate(spark: SparkSession, folder: str) -> DataFrame:
    return ops.raw_checks(tables.raw_transactions(spark, folder), tables.raw_mcc_codes(spark, folder))


@query(_unique_sql("q_raw_txn", "unique.id", "id"))
def unique_keys(spark: SparkSession, folder: str) -> DataFrame:
    return ops.unique_check(tables.raw_transactions(spark, folder), "id")


@query("SELECT transaction_id FROM q_cleaned WHERE transaction_id IS NULL")
def null_key_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ops.null_rows(tables.cleaned_transactions(spark, folder), "transaction_id")


@query(
    "SELECT count(*) AS total, count(is_fraud) AS labeled, "
    "coalesce(CAST(count(is_fraud) AS DOUBLE) / nullif(count(*), 0), 0) >= 0.8 AS passed FROM q_valid_txn WHERE year = 1998"
)
def label_coverage(spark: SparkSession, folder: str) -> DataFrame:
    enriched = tables.enriched_transactions(spark, folder, with_mcc=False, with_cards=False)
    return ops.label_coverage(enriched.filter("is_valid"), 1998)


@query(
    "SELECT year, month, day, quarantine_reason, count(*) AS rows, count(*) FILTER (WHERE NOT is_resolved) AS open_rows "
    "FROM q_quarantine GROUP BY ALL"
)
def quarantine_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ops.quarantine_summary(quarantine_rows(tables.cleaned_transactions(spark, folder)))


@query(
    "SELECT 'orders' AS table_name, count(*) AS row_count FROM {orders} UNION ALL SELECT 'lineitem', count(*) FROM {lineitem} "
    "UNION ALL SELECT 'customer', count(*) FROM {customer} UNION ALL SELECT 'events', count(*) FROM {events}"
)
def union_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.row_counts({t: inputs.table(spark, folder, t) for t in ("orders", "lineitem", "customer", "events")})


@query("SELECT min(o_orderkey) AS low, max(o_orderkey) AS high, count(*) AS rows FROM {orders}")
def table_bounds(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return inputs.table(spark, folder, "orders").agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows")
    )
