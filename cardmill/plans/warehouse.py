"""Staging layer to warehouse tables and marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from cardmill import files
from cardmill.operators import dims, features, marts
from cardmill.operators.dedup import latest_per_key
from cardmill.plans import history, rollup
from cardmill.plans.layout import Lake
from cardmill.schemas import PARTITIONING, STAGING
from cardmill.sinks import overwrite_days, replace_table
from cardmill.sources import read_table

_DAY = PARTITIONING["features"]


def _valid(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.staging("transactions")).filter("is_valid")


def build_amounts(spark: SparkSession, lake: Lake, days: Sequence[date] | None = None) -> int:
    """Amount totals per user and day, for some days or for all."""
    path = lake.warehouse("user_daily_amounts")
    if days is None:
        return replace_table(features.daily_amounts(_valid(spark, lake)), path, partition_by=_DAY)
    return overwrite_days(features.daily_amounts(features.on_days(_valid(spark, lake), days)), path, days)


def build_features_day(spark: SparkSession, lake: Lake, day: date, lifetime: bool = True) -> int:
    """Features of one day."""
    return build_features_days(spark, lake, [day], lifetime)


def build_features_days(spark: SparkSession, lake: Lake, days: Sequence[date], lifetime: bool = True) -> int:
    """Features of any number of days in one job.

    ``lifetime`` averages over the user's whole history, read from the stored
    daily totals, instead of over the lookback.
    """
    totals = read_table(spark, lake.warehouse("user_daily_amounts")) if lifetime else None
    built = features.features_on_days(_valid(spark, lake), days, totals)
    return overwrite_days(built, lake.warehouse("feat_fraud_features"), days)


def stored_days(spark: SparkSession, lake: Lake, after: date) -> list[date]:
    """Days of the staging table after ``after``, from its folders."""
    path = lake.staging("transactions")
    found = [date(y, m, d) for y in _values(spark, path, "year") for m in _values(spark, f"{path}/year={y}", "month") for d in _values(spark, f"{path}/year={y}/month={m}", "day")]
    return sorted(day for day in found if day > after)


def _values(spark: SparkSession, path: str, column: str) -> list[int]:
    values = [n.removeprefix(f"{column}=") for n in files.children(spark, path) if n.startswith(f"{column}=")]
    return [int(v) for v in values if v.isdigit()]


def build_features_all(spark: SparkSession, lake: Lake) -> int:
    built = features.fraud_features(_valid(spark, lake))
    return replace_table(built, lake.warehouse("feat_fraud_features"), partition_by=_DAY)


def _user_snapshot(spark: SparkSession, lake: Lake) -> DataFrame:
    tracked = [c for c in STAGING["dim_users"].names if c not in dims.VERSION_COLUMNS]
    users = marts.staging_users(read_table(spark, lake.staging("users")))
    return latest_per_key(users, ["user_id"], ["_ingested_at"]).select(*tracked)


def build_dim_users(spark: SparkSession, lake: Lake, as_of: datetime) -> int:
    """Merge the users into the stored history; returns the versions that are open."""
    return history.merge(spark, lake.warehouse("dim_users"), _user_snapshot(spark, lake), as_of=as_of)["open"]


def build_dim_cards(spark: SparkSession, lake: Lake) -> int:
    cards = dims.type1(read_table(spark, lake.staging("cards")), "card_id", ["_ingested_at"])
    return replace_table(cards.select(*STAGING["dim_cards"].names), lake.warehouse("dim_cards"))


def build_marts(spark: SparkSession, lake: Lake, day: date | None = None) -> dict:
    """All marts, or what one day changes."""
    return build_marts_days(spark, lake, None if day is None else [day])


def build_marts_days(spark: SparkSession, lake: Lake, days: Sequence[date] | None, changed: Sequence[date] | None = None) -> dict:
    """All marts, or what some days change: their days of the daily ones, their months of the monthly one, in one job each.

    ``changed`` names the days whose transactions have changed, where the others only got new features. The merchant
    tables come first, from stored parts: as a stored table the dimension's size is known when the mart joins it.
    """
    counts = rollup.build_all(spark, lake) if days is None else rollup.refresh(spark, lake, days if changed is None else changed)
    txns, feature_rows = _valid(spark, lake), read_table(spark, lake.warehouse("feat_fraud_features"))
    if days is not None:
        txns, feature_rows = features.on_days(txns, days), features.on_days(feature_rows, days)
    mart = marts.fraud_mart(
        marts.fact_transactions(txns),
        history.read_open(spark, lake.warehouse("dim_users")),
        feature_rows,
        read_table(spark, lake.warehouse("dim_merchants")),
    )
    for name, df in {"fraud_features": mart, "user_daily_stats": marts.user_daily_stats(txns)}.items():
        path = lake.warehouse(name)
        counts[name] = replace_table(df, path, partition_by=_DAY) if days is None else overwrite_days(df, path, days)
    return counts


def publish_views(spark: SparkSession, lake: Lake) -> None:
    """Staging and fact views, for SQL users."""
    txns = read_table(spark, lake.staging("transactions"))
    marts.staging_transactions(txns).createOrReplaceTempView("stg_transactions")
    marts.staging_users(read_table(spark, lake.staging("users"))).createOrReplaceTempView("stg_users")
    marts.staging_cards(read_table(spark, lake.staging("cards"))).createOrReplaceTempView("stg_cards")
    marts.fact_transactions(txns).createOrReplaceTempView("fact_transactions")
