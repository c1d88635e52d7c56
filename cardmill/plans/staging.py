"""Raw layer to staging layer."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators import cleaning, enrich
from cardmill.operators.dedup import latest_per_key
from cardmill.plans.layout import Lake
from cardmill.schemas import PARTITIONING, STAGING, conform
from cardmill.session import drop_table, materialize
from cardmill.sinks import drop_partition, overwrite_day, overwrite_partitions, overwrite_single_file, recover_partitions, replace_table
from cardmill.sources import read_day, read_table, read_table_if_present

_DAY = PARTITIONING["transactions"]
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _enriched(spark: SparkSession, lake: Lake, txns: DataFrame) -> DataFrame:
    labels = read_table_if_present(spark, lake.raw("fraud_labels"))
    cards = read_table(spark, lake.staging("cards")).filter("card_id IS NOT NULL")
    enriched = enrich.enrich_transactions(
        txns,
        read_table(spark, lake.staging("mcc_codes")),
        latest_per_key(cards, ["card_id"], ["_ingested_at"]),
        None if labels is None else cleaning.clean_labels(labels),
    )
    return conform(enriched, STAGING["transactions"])


def _split(spark: SparkSession, lake: Lake, cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows with codes, cards and labels, and rejected rows."""
    valid = _enriched(spark, lake, cleaning.valid_rows(cleaned))
    return valid, conform(cleaning.quarantine_rows(cleaned), STAGING["quarantine"])


def _is_day(day: date):
    return (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)


def clean_transactions_day(spark: SparkSession, lake: Lake, day: date) -> dict:
    """One day, as the backfill leaves it.

    An id that also occurs on other days belongs to its newest row only. The ids of the day are looked up in the other
    days (two columns of raw); a day that loses an id to this one is cleaned again. Rows without a readable date have no
    day of their own, so each run quarantines them anew.
    """
    for table in (lake.staging("transactions"), lake.quarantine("transactions")):
        recover_partitions(spark, table)
    raw = read_table(spark, lake.raw("transactions"))
    others = _days_sharing_ids(raw, day)
    counts = _clean_one_day(spark, lake, raw, day, others)
    for each in others:
        _clean_one_day(spark, lake, raw, each, _days_sharing_ids(raw, each))
    return {"date": day.isoformat(), **counts, "other_days": [d.isoformat() for d in others]}


def _days_sharing_ids(raw: DataFrame, day: date) -> list[date]:
    """Other days on which ids of ``day`` occur. Reads the ids of all days, returns one row for each day found."""
    ids = raw.filter(_is_day(day)).select("id").filter("id IS NOT NULL").distinct()
    other = raw.filter(~_is_day(day)).select("id", *_DAY).join(ids, "id", "left_semi")
    found = other.select(*_DAY).distinct().collect()
    return sorted(date(r["year"], r["month"], r["day"]) for r in found)


def _clean_one_day(spark: SparkSession, lake: Lake, raw: DataFrame, day: date, others: list[date]) -> dict:
    undated = F.col("year").isNull()
    own = raw.filter(_is_day(day) | undated)
    if others:
        ids = own.select("id").filter("id IS NOT NULL").distinct()
        rivals = raw.filter(reduce(or_, map(_is_day, others))).join(ids, "id", "left_semi").select(*raw.columns)
        own = own.unionByName(rivals)
    cleaned = materialize(cleaning.clean_transactions(own).filter(_is_day(day) | undated), "cleaned-day")
    try:
        valid, rejected = _split(spark, lake, cleaned)
        path = lake.quarantine("transactions")
        counts = {
            "valid": overwrite_day(valid.filter(_is_day(day)), lake.staging("transactions"), day, sort_by=["user_id"]),
            "quarantine": overwrite_day(rejected.filter(_is_day(day)), path, day),
        }
        if not overwrite_partitions(rejected.filter(undated), path, _DAY):
            drop_partition(spark, path, dict.fromkeys(_DAY, NO_DAY))
        return counts
    finally:
        drop_table(cleaned)


def clean_transactions_all(spark: SparkSession, lake: Lake) -> dict:
    """Backfill: all days in one job; days that are gone from raw go here too."""
    cleaned = materialize(cleaning.clean_transactions(read_table(spark, lake.raw("transactions"))), "cleaned")
    try:
        valid, rejected = _split(spark, lake, cleaned)
        return {
            "valid": replace_table(valid, lake.staging("transactions"), partition_by=_DAY, sort_by=["user_id"]),
            "quarantine": replace_table(rejected, lake.quarantine("transactions"), partition_by=_DAY),
        }
    finally:
        drop_table(cleaned)


def clean_users(spark: SparkSession, lake: Lake) -> int:
    users = cleaning.clean_users(read_table(spark, lake.raw("users")))
    return replace_table(users, lake.staging("users"), partition_by=PARTITIONING["users"])


def clean_cards(spark: SparkSession, lake: Lake, as_of: date) -> int:
    cards = cleaning.clean_cards(read_table(spark, lake.raw("cards")), as_of)
    return replace_table(cards, lake.staging("cards"), partition_by=PARTITIONING["cards"])


def clean_mcc_codes(spark: SparkSession, lake: Lake) -> int:
    codes = cleaning.clean_mcc_codes(read_table(spark, lake.raw("mcc_codes")))
    return overwrite_single_file(codes, lake.staging("mcc_codes"))


def enrich_transactions_day(spark: SparkSession, lake: Lake, day: date) -> int:
    """Rewrite one staging day with current codes, cards and labels, when labels have arrived since."""
    path = lake.staging("transactions")
    stored = materialize(_enriched(spark, lake, read_day(spark, path, day)), "enriched-day")
    try:
        return overwrite_day(stored, path, day, sort_by=["user_id"])
    finally:
        drop_table(stored)


def enrich_transactions_all(spark: SparkSession, lake: Lake) -> int:
    path = lake.staging("transactions")
    return replace_table(_enriched(spark, lake, read_table(spark, path)), path, partition_by=_DAY, sort_by=["user_id"])
