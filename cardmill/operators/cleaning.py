"""Raw text tables to typed staging tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators.dedup import latest_per_key, latest_where_keyed
from cardmill.schemas import STAGING, conform

# Rejected amount formats.
REJECTED_FORMATS = ("AMBIGUOUS", "INVALID")


def _present(df: DataFrame, name: str, type_name: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(type_name)


def type_transactions(df: DataFrame) -> DataFrame:
    """Rename, parse the event time, cast the merchant code; card secrets do not pass. A time that is typed stays."""
    typed = df.withColumnsRenamed({"id": "transaction_id", "client_id": "user_id", "use_chip": "use_chip_raw"})
    typed = typed.withColumn("mcc", fn.to_int(F.col("mcc")))
    if "date" in df.columns:
        typed = typed.withColumn("transaction_date", fn.event_time(F.col("date")))
    if "card_number" in df.columns:
        typed = typed.withColumn("card_number_masked", fn.mask_pan(F.col("card_number")))
    return typed.drop("date", "card_number", "cvv")


def mark_place(df: DataFrame) -> DataFrame:
    """Flag online purchases, name them in state and zip, then normalise the zip."""
    online = F.col("is_online_transaction")
    flagged = df.withColumn(
        "is_online_transaction", fn.is_online(F.col("merchant_state"), F.col("merchant_city"))
    )
    return flagged.withColumns(
        {
            "merchant_state": F.when(online, F.lit("ONLINE")).otherwise(F.col("merchant_state")),
            "zip": F.when(online, F.lit("ONLINE")).otherwise(fn.zip5(F.col("zip"))),
        }
    )


def mark_errors(df: DataFrame) -> DataFrame:
    """Error text to one flag per error, and ``has_error``."""
    flagged = df.withColumns(fn.error_flags(F.col("errors"))).drop("errors")
    return flagged.withColumn("has_error", fn.has_error())


def mark_refund(df: DataFrame) -> DataFrame:
    return df.withColumn("is_refund", F.coalesce(F.col("amount") < 0, F.lit(False)))


def failed_rule(df: DataFrame) -> Column:
    """Name of the first rule a transaction breaks; NULL when it breaks none."""
    return (
        F.when(F.col("transaction_id").isNull(), "MISSING_TRANSACTION_ID")
        .when(F.col("transaction_date").isNull(), "MISSING_TRANSACTION_DATE")
        .when(F.col("user_id").isNull(), "MISSING_USER_ID")
        .when(F.col("amount_format").isin(*REJECTED_FORMATS), F.col("amount_format"))
        .when(F.col("amount").isNull(), "MISSING_AMOUNT")
    )


def mark_valid(df: DataFrame) -> DataFrame:
    return df.withColumn("is_valid", failed_rule(df).isNull())


def add_event_day(df: DataFrame, ts: str = "transaction_date") -> DataFrame:
    moment = F.col(ts)
    return df.withColumns(
        {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
    )


def clean_transactions(df: DataFrame, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Typed, flagged and de-duplicated transactions, valid or not.

    Copies are removed before the money text is parsed: the choice needs only
    the key and the load time, so no copy is parsed in vain.
    """
    return clean_latest(latest_where_keyed(df, "id", ["_loaded_at"], tiebreak))


def typed_transactions(df: DataFrame, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """The rows of ``clean_transactions`` as typed, without what is read from amounts, errors and places."""
    return type_transactions(latest_where_keyed(df, "id", ["_loaded_at"], tiebreak))


def clean_latest(latest: DataFrame) -> DataFrame:
    """The typed and flagged columns of raw transactions, row by row."""
    parsed = fn.parse_money(type_transactions(latest).transform(mark_errors))
    cleaned = (
        parsed.transform(mark_refund)
        .transform(mark_place)
        .withColumn("use_chip", fn.chip_code(F.col("use_chip_raw")))
        .transform(mark_valid)
    )
    return add_event_day(cleaned)


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter("is_valid")


def quarantine_rows(df: DataFrame) -> DataFrame:
    """Rejected rows in the quarantine contract: open, with the rule they break; who resolves them is not known yet."""
    opened = {"quarantine_reason": failed_rule(df), "quarantine_ts": F.current_timestamp(), "is_resolved": F.lit(False)}
    return conform(df.withColumns(opened).filter("quarantine_reason IS NOT NULL"), STAGING["quarantine"])


def clean_users(df: DataFrame, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    latest = latest_where_keyed(df.withColumnRenamed("id", "user_id"), "user_id", ["_loaded_at"], tiebreak)
    whole = ("current_age", "retirement_age", "birth_year", "birth_month", "credit_score", "num_credit_cards")
    income = ("per_capita_income", "yearly_income", "total_debt")
    typed = latest.withColumns(
        {
            **{c: fn.to_int(F.col(c)) for c in whole},
            **{c: fn.plain_money(F.col(c)) for c in income},
            **{c: F.col(c).try_cast("double") for c in ("latitude", "longitude")},
        }
    )
    score = F.col("credit_score")
    banded = typed.withColumns(
        {
            "credit_score_band": fn.credit_band(score),
            "is_invalid_credit_score": fn.credit_out_of_range(score),
            "age_group": fn.age_group(F.col("current_age")),
            "is_valid": F.col("user_id").isNotNull(),
            "created_year": F.col("birth_year"),
            "created_month": F.col("birth_month"),
        }
    )
    return conform(banded, STAGING["users"])


def clean_cards(df: DataFrame, as_of: date, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """``as_of`` is the day up to which the age of the account is counted."""
    named = df.withColumnsRenamed({"id": "card_id", "client_id": "user_id"}).drop("cvv")
    latest = latest_where_keyed(named, "card_id", ["_loaded_at"], tiebreak)
    typed = latest.withColumns(
        {
            "card_number_masked": fn.mask_pan(_present(latest, "card_number")),
            "expires_month": fn.month_year_part(F.col("expires"), 0),
            "expires_year": fn.month_year_part(F.col("expires"), 1),
            "credit_limit": fn.plain_money(F.col("credit_limit")),
            "has_chip": fn.to_flag(F.col("has_chip")),
            "card_on_dark_web": fn.to_flag(F.col("card_on_dark_web")),
            "account_age_months": fn.months_open(F.col("acct_open_date"), as_of.year, as_of.month),
            "num_cards_issued": fn.to_int(F.col("num_cards_issued")),
            "year_pin_last_changed": fn.to_int(F.col("year_pin_last_changed")),
            "is_valid": F.col("card_id").isNotNull(),
            "card_brand_part": F.lower(F.col("card_brand")),
            "expires_year_part": fn.month_year_part(F.col("expires"), 1),
        }
    )
    return conform(typed, STAGING["cards"])


def clean_mcc_codes(df: DataFrame) -> DataFrame:
    """One description per numeric code; unreadable codes are left out."""
    typed = df.select(
        fn.to_int(F.col("mcc_code")).alias("mcc"),
        "mcc_code",
        F.col("description").alias("mcc_description"),
        *[_present(df, c, t).alias(c) for c, t in (("_ingested_at", "timestamp"), ("_source_file", "string"), ("_batch_id", "string"))],
    )
    order = [F.col("mcc_description").asc_nulls_last(), F.col("mcc_code").asc()]
    return latest_per_key(typed.filter("mcc IS NOT NULL"), ["mcc"], ["_ingested_at"], order)


def clean_labels(df: DataFrame, frauds_only: bool = False) -> DataFrame:
    """One boolean label per transaction. Labels that contradict each other count as fraud.

    Counts of frauds need no other label: with ``frauds_only`` the rest is left out before it is moved.
    """
    flagged = df.select("transaction_id", fn.to_flag(F.col("is_fraud")).alias("is_fraud"))
    if frauds_only:
        flagged = flagged.filter("is_fraud")
    return flagged.groupBy("transaction_id").agg(F.max("is_fraud").alias("is_fraud"))
