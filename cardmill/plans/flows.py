"""The jobs in the order their inputs require. Each step can be repeated."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cardmill.operators import quality
from cardmill.plans import checks, staging, warehouse
from cardmill.plans.layout import Lake
from cardmill.session import scratch_run
from cardmill.sources import read_day, read_table, read_table_if_present


def _dimensions(spark: SparkSession, lake: Lake, as_of: datetime) -> dict:
    return {
        "mcc_codes": staging.clean_mcc_codes(spark, lake),
        "users": staging.clean_users(spark, lake),
        "cards": staging.clean_cards(spark, lake, as_of.date()),
    }


def run_backfill(spark: SparkSession, lake: Lake, as_of: datetime) -> dict:
    """Everything after ingest, for all days at once. Nothing is published that fails the staging checks."""
    with scratch_run(spark):
        result = _dimensions(spark, lake, as_of)
        result["transactions"] = staging.clean_transactions_all(spark, lake)
        _gate_staging(spark, lake)
        result["amounts"] = warehouse.build_amounts(spark, lake)
        result["features"] = warehouse.build_features_all(spark, lake)
        result["dim_users"] = warehouse.build_dim_users(spark, lake, as_of)
        result["dim_cards"] = warehouse.build_dim_cards(spark, lake)
        result["marts"] = warehouse.build_marts(spark, lake)
        return result


def run_day(spark: SparkSession, lake: Lake, day: date, as_of: datetime) -> dict:
    """One day after ingest; see ``run_days``."""
    return run_days(spark, lake, [day], as_of)


def run_days(spark: SparkSession, lake: Lake, days: Sequence[date], as_of: datetime) -> dict:
    """Some days after ingest; the raw days are checked before anything is overwritten.

    Days after the first of them whose lookback holds it, and days that lost an id to them, get new features and marts
    too. Running averages of later days count every earlier day, so with a day in the past all later days are rebuilt:
    by one feature job and one mart job, however many they are. Merchant totals are read from stored parts.
    """
    codes = read_table(spark, lake.raw("mcc_codes"))
    for day in days:
        quality.gate(quality.raw_checks(read_day(spark, lake.raw("transactions"), day), codes))
    with scratch_run(spark):
        result = _dimensions(spark, lake, as_of)
        cleaned = [staging.clean_transactions_day(spark, lake, day) for day in days]
        result["transactions"] = cleaned[0] if len(cleaned) == 1 else cleaned
        changed = sorted({*days, *(date.fromisoformat(d) for c in cleaned for d in c["other_days"])})
        _gate_staging(spark, lake, changed)
        result["amounts"] = warehouse.build_amounts(spark, lake, changed)
        result["dim_users"] = warehouse.build_dim_users(spark, lake, as_of)
        result["dim_cards"] = warehouse.build_dim_cards(spark, lake)
        targets = sorted({*changed, *warehouse.stored_days(spark, lake, changed[0])})
        result["features"] = warehouse.build_features_days(spark, lake, targets)
        result["marts"] = warehouse.build_marts_days(spark, lake, targets, changed)
        return result


def needs_review(spark: SparkSession, lake: Lake) -> bool:
    """Whether rows wait in quarantine: the branch after a run."""
    quarantined = read_table_if_present(spark, lake.quarantine("transactions"))
    return quarantined is not None and quality.has_quarantine(quarantined.filter("NOT is_resolved"))


def check_labels(spark: SparkSession, lake: Lake, year: int) -> None:
    """Gate on the share of labelled transactions of a year."""
    report = quality.label_coverage(read_table(spark, lake.staging("transactions")).filter("is_valid"), year)
    quality.gate(report.withColumn("check", F.lit(f"label_coverage.{year}")))


def _gate_staging(spark: SparkSession, lake: Lake, days: Sequence[date] | None = None) -> None:
    """The checks of all staged rows: transactions from the counts of their days, of which the changed ones are counted anew."""
    stored = checks.transactions(lake)
    if days is None:
        stored.build(spark)
    else:
        stored.refresh(spark, days)
    users, cards = (read_table(spark, lake.staging(table)) for table in ("users", "cards"))
    quality.gate(quality.union_reports(stored.report(spark), quality.dimension_checks(users, cards)))
