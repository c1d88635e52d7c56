"""Stored merchant totals: days from transactions, months from days, the dimension from months.

A run reads the transactions of the days that changed and nothing else of them. Every step replaces whole partitions and
can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import files
from cardmill.operators import rollup
from cardmill.operators.features import on_days
from cardmill.plans.layout import Lake
from cardmill.sinks import overwrite_days, replace_partitions, replace_table
from cardmill.sources import read_table

DAY, MONTH = ("year", "month", "day"), ("year", "month")


def build_all(spark: SparkSession, lake: Lake) -> dict:
    """Days, months and what is published from them, from all transactions."""
    days = rollup.merchant_days(read_table(spark, lake.staging("transactions")))
    replace_table(days, lake.warehouse("merchant_days"), partition_by=DAY)
    months = rollup.merchant_months(_days(spark, lake))
    replace_table(months, lake.warehouse("merchant_months"), partition_by=MONTH)
    return _publish(spark, lake, None)


def refresh(spark: SparkSession, lake: Lake, days: Sequence[date]) -> dict:
    """The same tables after the transactions of some days have changed; days without valid rows go."""
    if not (files.exists(spark, lake.warehouse("merchant_days")) and files.exists(spark, lake.warehouse("merchant_months"))):
        return build_all(spark, lake)
    changed = on_days(read_table(spark, lake.staging("transactions")), days)
    overwrite_days(rollup.merchant_days(changed), lake.warehouse("merchant_days"), days)
    touched = sorted({(d.year, d.month) for d in days})
    parts = _of_months(_days(spark, lake), touched)
    replace_partitions(rollup.merchant_months(parts), lake.warehouse("merchant_months"), MONTH, touched)
    return _publish(spark, lake, touched)


def _days(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.warehouse("merchant_days"), rollup.DAY_SCHEMA)


def _months(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.warehouse("merchant_months"), rollup.MONTH_SCHEMA)


def _of_months(df: DataFrame, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of some months, by conditions on the partition columns alone."""
    condition = F.lit(False)
    for year, month in months:
        condition |= (F.col("year") == year) & (F.col("month") == month)
    return df.filter(condition)


def _publish(spark: SparkSession, lake: Lake, months: Sequence[tuple[int, int]] | None) -> dict:
    path, stored = lake.warehouse("merchant_risk_score"), _months(spark, lake)
    merchants = replace_table(rollup.merchant_dimension(stored), lake.warehouse("dim_merchants"))
    if months is None:
        scored = replace_table(rollup.merchant_risk_score(stored), path, partition_by=MONTH)
    else:
        scored = replace_partitions(rollup.merchant_risk_score(_of_months(stored, months)), path, MONTH, months)
    return {"dim_merchants": merchants, "merchant_risk_score": scored}
