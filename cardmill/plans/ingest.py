"""Source tables to the raw layer."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators.cleaning import add_event_day
from cardmill.plans.layout import Lake
from cardmill.schemas import PARTITIONING
from cardmill.sinks import overwrite_partitions, overwrite_single_file, replace_table
from cardmill.sources import JdbcSource


@dataclass(frozen=True)
class TableSpec:
    """How one source table enters the lake."""

    table: str
    source_table: str
    range_key: str | None = None
    partitions: int = 1
    add_partitions: Callable[[DataFrame], DataFrame] = lambda df: df
    secrets: tuple[str, ...] = ()
    single_file: bool = False


def event_day_partitions(df: DataFrame) -> DataFrame:
    """Day of the event, not of the load: late rows still reach the day they belong to."""
    return add_event_day(df.withColumn("_at", fn.event_time(F.col("date"))), "_at").drop("_at")


def cohort_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"created_year": fn.to_int(F.col("birth_year")), "created_month": fn.to_int(F.col("birth_month"))}
    )


def card_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "card_brand_part": F.lower("card_brand"),
            "expires_year_part": fn.month_year_part(F.col("expires"), 1),
        }
    )


# Source tables, range keys and how many connections read them unless a run says otherwise; small tables first.
TABLE_SPECS = (
    TableSpec("mcc_codes", "raw_mcc_codes", single_file=True),
    TableSpec("fraud_labels", "raw_fraud_labels", "transaction_id", 4),
    TableSpec("users", "raw_users", "id", 4, cohort_partitions),
    TableSpec("cards", "raw_cards", "id", 4, card_partitions, secrets=("cvv",)),
    TableSpec("transactions", "raw_transactions", "id", 8, event_day_partitions),
)


def new_batch_id(now: datetime) -> str:
    return f"batch_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def add_audit(df: DataFrame, source: str, batch_id: str, ingested_at: datetime) -> DataFrame:
    stamp = F.lit(ingested_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    return df.withColumns({"_ingested_at": stamp, "_source_file": F.lit(source), "_batch_id": F.lit(batch_id)})


def to_raw(df: DataFrame, spec: TableSpec, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Source rows without secrets, with audit and partition columns."""
    audited = add_audit(df.drop(*spec.secrets), spec.source_table, batch_id, ingested_at)
    return audited.transform(spec.add_partitions)


def write_raw(df: DataFrame, spec: TableSpec, lake: Lake) -> int:
    target, keys = lake.raw(spec.table), PARTITIONING[spec.table]
    if keys:
        return overwrite_partitions(df, target, keys)
    return (overwrite_single_file if spec.single_file else replace_table)(df, target)


@dataclass(frozen=True)
class Load:
    """One source table that reached the raw layer."""

    batch_id: str
    table: str
    path: str
    rows: int
    at: datetime


def ingest(
    lake: Lake, spec: TableSpec, rows: DataFrame, batch_id: str | None = None, now: datetime | None = None
) -> Load:
    """Write one source table to the raw layer. Repeating it replaces the same partitions."""
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    batch_id = batch_id or new_batch_id(now)
    count = write_raw(to_raw(rows, spec, batch_id, now), spec, lake)
    return Load(batch_id, spec.source_table, lake.raw(spec.table), count, now)


def ingest_all(spark: SparkSession, lake: Lake, source: JdbcSource, connections: int | None = None) -> list[Load]:
    """All source tables. ``connections`` sets how many read a table that has a range key; else each has its own number."""
    return [
        ingest(
            lake,
            spec,
            source.read(spark, spec.source_table, spec.range_key, (spec.range_key and connections) or spec.partitions),
        )
        for spec in TABLE_SPECS
    ]
