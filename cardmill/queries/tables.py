"""The derived tables as DataFrames, raw and cleaned by the operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators import cleaning, enrich
from cardmill.operators.marts import MART_SOURCE_COLUMNS
from cardmill.queries import inputs

AS_OF = date(2024, 1, 31)


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.derive(spark, folder, inputs.RAW_TRANSACTIONS)


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.derive(spark, folder, inputs.RAW_USERS)


def raw_cards(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.derive(spark, folder, inputs.RAW_CARDS)


def raw_mcc_codes(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.derive(spark, folder, inputs.RAW_MCC_CODES)


def raw_labels(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.derive(spark, folder, inputs.RAW_LABELS)


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.derive(spark, folder, inputs.EVENT_TRANSACTIONS)


def user_snapshot(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return inputs.derive(spark, folder, inputs.user_snapshot_sql(version))


def cleaned_transactions(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col("_source_file").asc_nulls_last()]
    return cleaning.clean_transactions(raw_transactions(spark, folder), order)


def typed_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """For queries that take nothing from amounts: their parser is not moved out of a plan that doesn't need it."""
    order = [F.col("_source_file").asc_nulls_last()]
    return cleaning.typed_transactions(raw_transactions(spark, folder), order)


def users(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_users(raw_users(spark, folder), [F.col("_batch_id").asc()])


def cards(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_cards(raw_cards(spark, folder), AS_OF, [F.col("_batch_id").asc()])


def mcc_codes(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_mcc_codes(raw_mcc_codes(spark, folder))


def labels(spark: SparkSession, folder: str, frauds_only: bool = False) -> DataFrame:
    return cleaning.clean_labels(raw_labels(spark, folder), frauds_only)


# Raw texts that nothing looks at before rows are cleaned: queries that want them all move them as one.
_PACKED = ("client_id", "amount", "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors", "_batch_id")
_NOT_IN_THE_MART = ("use_chip", "zip", "errors", "_batch_id", "_ingested_at")


def enriched_transactions(
    spark: SparkSession, folder: str, with_mcc: bool = True, with_cards: bool = True, whole: bool = False, keyed: bool = False
) -> DataFrame:
    """Cleaned rows with labels; codes and cards for queries that take something from them.

    ``whole``: for queries that take all texts. ``keyed``: for queries of valid rows, which all have an id.
    """
    order = [F.col("_source_file").asc_nulls_last()]
    mcc = mcc_codes(spark, folder) if with_mcc else None
    cards_ = cards(spark, folder) if with_cards else None
    raw = raw_transactions(spark, folder).filter("id IS NOT NULL") if keyed else raw_transactions(spark, folder)
    return enrich.clean_and_enrich(raw, mcc, cards_, labels(spark, folder), order, _PACKED if whole else ())


def mart_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Valid transactions with the columns the mart is made from: no others are moved or stored."""
    order = [F.col("_source_file").asc_nulls_last()]
    raw = raw_transactions(spark, folder).drop(*_NOT_IN_THE_MART)
    packed = ["card_id", *(c for c in _PACKED if c not in _NOT_IN_THE_MART)]
    added = mcc_codes(spark, folder), cards(spark, folder), labels(spark, folder)
    return enrich.valid_and_enriched(raw, *added, MART_SOURCE_COLUMNS, order, packed)


def counted_transactions(spark: SparkSession, folder: str, with_mcc: bool = True) -> DataFrame:
    """Valid rows for queries that only count frauds: ``is_fraud`` is true or NULL, and rows without an id, never valid, aren't moved."""
    order = [F.col("_source_file").asc_nulls_last()]
    keyed = raw_transactions(spark, folder).filter("id IS NOT NULL")
    mcc = mcc_codes(spark, folder) if with_mcc else None
    return enrich.clean_and_enrich(keyed, mcc, None, labels(spark, folder, frauds_only=True), order).filter("is_valid")
