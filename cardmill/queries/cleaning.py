"""Column cleaning, de-duplication, validity and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators import cleaning as ops
from cardmill.operators import enrich
from cardmill.operators.dedup import latest_where_keyed
from cardmill.queries import oracle, tables
from cardmill.queries.registry import query
from cardmill.schemas import STAGING, conform

_ALL_PARSED = oracle.PARSE_MONEY.replace("{source}", "q_raw_txn")
_AMOUNT_COLUMNS = "amount_raw, CAST(amount AS DOUBLE) AS amount, amount_currency, amount_format, amount_parse_note"


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return fn.parse_money(tables.raw_transactions(spark, folder))


@query(f"SELECT id, {_AMOUNT_COLUMNS} FROM ({_ALL_PARSED})")
def amount_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).select(
        "id",
        "amount_raw",
        F.col("amount").cast("double").alias("amount"),
        "amount_currency",
        "amount_format",
        "amount_parse_note",
    )


@query(
    "SELECT amount_format, amount_currency, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS total "
    f"FROM ({_ALL_PARSED}) GROUP BY amount_format, amount_currency"
)
def amount_format_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).groupBy("amount_format", "amount_currency").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("double").alias("total")
    )


@query(f"SELECT id, amount_raw, coalesce(amount < 0, false) AS is_refund FROM ({_ALL_PARSED})")
def refund_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).transform(ops.mark_refund).select("id", "amount_raw", "is_refund")


@query(
    "SELECT id AS transaction_id, client_id AS user_id, TRY_CAST(date AS TIMESTAMP) AS transaction_date, "
    "use_chip AS use_chip_raw, TRY_CAST(mcc AS INT) AS mcc FROM q_raw_txn"
)
def type_cast(spark: SparkSession, folder: str) -> DataFrame:
    typed = ops.type_transactions(tables.raw_transactions(spark, folder))
    return typed.select("transaction_id", "user_id", "transaction_date", "use_chip_raw", "mcc")


@query(f"SELECT id, {oracle.MASK} AS card_number_masked FROM q_raw_cards")
def pan_mask(spark: SparkSession, folder: str) -> DataFrame:
    return tables.raw_cards(spark, folder).select("id", fn.mask_pan(F.col("card_number")).alias("card_number_masked"))


@query(f"SELECT id, zip AS raw_zip, {oracle.ZIP} AS zip FROM q_raw_txn")
def zip_clean(spark: SparkSession, folder: str) -> DataFrame:
    return tables.raw_transactions(spark, folder).select("id", F.col("zip").alias("raw_zip"), fn.zip5(F.col("zip")).alias("zip"))


@query(f"SELECT id, use_chip AS use_chip_raw, {oracle.CHIP} AS use_chip FROM q_raw_txn")
def chip_encode(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.col("use_chip")
    return tables.raw_transactions(spark, folder).select("id", raw.alias("use_chip_raw"), fn.chip_code(raw).alias("use_chip"))


@query(f"SELECT id, {oracle.ERROR_FLAGS} FROM q_raw_txn")
def error_flags(spark: SparkSession, folder: str) -> DataFrame:
    return ops.mark_errors(tables.raw_transactions(spark, folder).select("id", "errors"))


_ONLINE = "merchant_state IS NULL AND upper(merchant_city) = 'ONLINE'"


@query(
    f"SELECT id, {_ONLINE} AS is_online_transaction, CASE WHEN {_ONLINE} THEN 'ONLINE' ELSE merchant_state END AS merchant_state, "
    f"CASE WHEN {_ONLINE} THEN 'ONLINE' ELSE {oracle.ZIP} END AS zip FROM q_raw_txn"
)
def online_flag(spark: SparkSession, folder: str) -> DataFrame:
    marked = ops.mark_place(tables.raw_transactions(spark, folder))
    return marked.select("id", "is_online_transaction", "merchant_state", "zip")


_CLEANED_COLUMNS = (
    "transaction_id transaction_date user_id card_id amount_raw amount_currency amount_format amount_parse_note is_refund "
    "use_chip use_chip_raw is_online_transaction merchant_id merchant_city merchant_state zip mcc error_bad_pin error_bad_cvv "
    "error_bad_card_number error_bad_expiration error_bad_zipcode error_insufficient_balance error_technical_glitch has_error "
    "is_valid _source_file _batch_id year month day"
).split()


@query(f"SELECT {', '.join(_CLEANED_COLUMNS)}, CAST(amount AS DOUBLE) AS amount FROM q_cleaned")
def clean_transactions(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = tables.cleaned_transactions(spark, folder)
    return cleaned.select(*_CLEANED_COLUMNS, F.col("amount").cast("double").alias("amount"))


@query("SELECT * EXCLUDE (_loaded_at, _ingested_at) FROM q_one_txn")
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col("_source_file").asc_nulls_last()]
    latest = latest_where_keyed(tables.raw_transactions(spark, folder), "id", ["_loaded_at"], order)
    return latest.drop("_loaded_at", "_ingested_at")


@query(
    "SELECT is_valid, count(*) AS rows, count(transaction_id) AS keyed, CAST(sum(amount) AS DOUBLE) AS total "
    "FROM q_cleaned GROUP BY is_valid"
)
def validity_split(spark: SparkSession, folder: str) -> DataFrame:
    return tables.cleaned_transactions(spark, folder).groupBy("is_valid").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("transaction_id").alias("keyed"),
        F.sum("amount").cast("double").alias("total"),
    )


@query("SELECT * FROM q_quarantine")
def quarantine_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ops.quarantine_rows(tables.cleaned_transactions(spark, folder)).drop("quarantine_ts")


@query(
    f"SELECT id, {oracle.money('per_capita_income')} AS per_capita_income, {oracle.money('yearly_income')} AS yearly_income, "
    f"{oracle.money('total_debt')} AS total_debt FROM q_raw_users"
)
def money_strip(spark: SparkSession, folder: str) -> DataFrame:
    fields = ("per_capita_income", "yearly_income", "total_debt")
    return tables.raw_users(spark, folder).select("id", *(fn.plain_money(F.col(c)).alias(c) for c in fields))


_SCORE = "TRY_CAST(credit_score AS INT)"


@query(
    f"SELECT id, {oracle.BAND.format(s=_SCORE)} AS credit_score_band, "
    f"coalesce({_SCORE} < 300 OR {_SCORE} > 850, false) AS is_invalid_credit_score FROM q_raw_users"
)
def credit_band(spark: SparkSession, folder: str) -> DataFrame:
    score = fn.to_int(F.col("credit_score"))
    return tables.raw_users(spark, folder).select(
        "id",
        fn.credit_band(score).alias("credit_score_band"),
        fn.credit_out_of_range(score).alias("is_invalid_credit_score"),
    )


@query(f"SELECT id, {oracle.GROUP.format(a='TRY_CAST(current_age AS INT)')} AS age_group FROM q_raw_users")
def age_group(spark: SparkSession, folder: str) -> DataFrame:
    return tables.raw_users(spark, folder).select("id", fn.age_group(fn.to_int(F.col("current_age"))).alias("age_group"))


@query(
    "SELECT id, TRY_CAST(split_part(expires, '/', 1) AS INT) AS expires_month, "
    "TRY_CAST(nullif(split_part(expires, '/', 2), '') AS INT) AS expires_year FROM q_raw_cards"
)
def expiry_parse(spark: SparkSession, folder: str) -> DataFrame:
    expires = F.col("expires")
    return tables.raw_cards(spark, folder).select(
        "id",
        fn.month_year_part(expires, 0).alias("expires_month"),
        fn.month_year_part(expires, 1).alias("expires_year"),
    )


@query("SELECT id, upper(has_chip) = 'YES' AS has_chip, upper(card_on_dark_web) = 'YES' AS card_on_dark_web FROM q_raw_cards")
def yesno_bool(spark: SparkSession, folder: str) -> DataFrame:
    fields = ("has_chip", "card_on_dark_web")
    return tables.raw_cards(spark, folder).select("id", *(fn.to_flag(F.col(c)).alias(c) for c in fields))


@query(f"SELECT id, acct_open_date, {oracle.ACCOUNT_AGE} AS account_age_months FROM q_raw_cards")
def account_age(spark: SparkSession, folder: str) -> DataFrame:
    months = fn.months_open(F.col("acct_open_date"), tables.AS_OF.year, tables.AS_OF.month)
    return tables.raw_cards(spark, folder).select("id", "acct_open_date", months.alias("account_age_months"))


@query("SELECT * FROM q_users")
def clean_users(spark: SparkSession, folder: str) -> DataFrame:
    return tables.users(spark, folder)


@query("SELECT * FROM q_cards")
def clean_cards(spark: SparkSession, folder: str) -> DataFrame:
    return tables.cards(spark, folder)


@query("SELECT mcc, mcc_code, mcc_description FROM q_mcc")
def mcc_clean(spark: SparkSession, folder: str) -> DataFrame:
    return tables.mcc_codes(spark, folder).select("mcc", "mcc_code", "mcc_description")


@query("SELECT transaction_id, mcc, mcc_description FROM q_enriched")
def mcc_enrich_unknown(spark: SparkSession, folder: str) -> DataFrame:
    enriched = enrich.add_mcc_description(tables.typed_transactions(spark, folder), tables.mcc_codes(spark, folder))
    return enriched.select("transaction_id", "mcc", "mcc_description")


@query("SELECT transaction_id, card_id, card_brand, card_type, card_number_masked, card_on_dark_web FROM q_enriched")
def card_enrich(spark: SparkSession, folder: str) -> DataFrame:
    enriched = enrich.add_card_attributes(tables.typed_transactions(spark, folder), tables.cards(spark, folder))
    return enriched.select("transaction_id", "card_id", *enrich.CARD_ATTRIBUTES)


@query("SELECT transaction_id, is_fraud FROM q_enriched")
def label_enrich(spark: SparkSession, folder: str) -> DataFrame:
    enriched = enrich.add_labels(tables.typed_transactions(spark, folder), tables.labels(spark, folder))
    return enriched.select("transaction_id", "is_fraud")


_ENRICHED_COLUMNS = [*_CLEANED_COLUMNS, "mcc_description", *enrich.CARD_ATTRIBUTES, "is_fraud"]


@query(f"SELECT {', '.join(_ENRICHED_COLUMNS)}, CAST(amount AS DOUBLE) AS amount FROM q_enriched")
def enrich_transactions(spark: SparkSession, folder: str) -> DataFrame:
    enriched = tables.enriched_transactions(spark, folder, whole=True)
    return enriched.select(*_ENRICHED_COLUMNS, F.col("amount").cast("double").alias("amount"))


@query(
    "SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, is_valid, CAST(NULL AS STRING) AS card_brand, "
    "CAST(NULL AS BOOLEAN) AS is_fraud, year, month, day FROM q_cleaned"
)
def conform_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows brought to the staging contract: columns not yet known are typed NULLs."""
    conformed = conform(tables.cleaned_transactions(spark, folder), STAGING["transactions"])
    return conformed.select(
        "transaction_id",
        F.col("amount").cast("double").alias("amount"),
        "is_valid",
        "card_brand",
        "is_fraud",
        "year",
        "month",
        "day",
    )
