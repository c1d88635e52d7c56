"""Column contracts of the layers, and the operator that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "decimal(18,2)": DecimalType(18, 2),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}

# Source columns, all text.
_RAW_COLUMNS = {
    "transactions": "id date client_id card_id amount use_chip merchant_id merchant_city merchant_state zip mcc errors",
    "users": (
        "id current_age retirement_age birth_year birth_month gender address latitude longitude "
        "per_capita_income yearly_income total_debt credit_score num_credit_cards"
    ),
    "cards": (
        "id client_id card_brand card_type card_number expires cvv has_chip num_cards_issued credit_limit "
        "acct_open_date year_pin_last_changed card_on_dark_web"
    ),
    "mcc_codes": "mcc_code description",
    "fraud_labels": "transaction_id is_fraud",
}

# Typed columns of the staging layer, in contract order.
_STAGING_COLUMNS = {
    "transactions": """
        transaction_id string, transaction_date timestamp, user_id string, card_id string,
        amount_raw string, amount decimal(18,2), amount_currency string, amount_format string,
        amount_parse_note string, is_refund boolean, use_chip int, use_chip_raw string,
        is_online_transaction boolean, merchant_id string, merchant_city string, merchant_state string,
        zip string, mcc int, mcc_description string, card_brand string, card_type string,
        card_number_masked string, card_on_dark_web boolean, error_bad_pin boolean, error_bad_cvv boolean,
        error_bad_card_number boolean, error_bad_expiration boolean, error_bad_zipcode boolean,
        error_insufficient_balance boolean, error_technical_glitch boolean, has_error boolean,
        is_fraud boolean, is_valid boolean, _ingested_at timestamp, _source_file string, _batch_id string,
        year int, month int, day int""",
    "users": """
        user_id string, current_age int, age_group string, retirement_age int, birth_year int,
        birth_month int, gender string, address string, latitude double, longitude double,
        per_capita_income double, yearly_income double, total_debt double, credit_score int,
        credit_score_band string, is_invalid_credit_score boolean, num_credit_cards int, is_valid boolean,
        _ingested_at timestamp, _source_file string, _batch_id string, created_year int, created_month int""",
    "cards": """
        card_id string, user_id string, card_brand string, card_type string, card_number_masked string,
        expires_month int, expires_year int, has_chip boolean, num_cards_issued int, credit_limit double,
        acct_open_date string, account_age_months int, year_pin_last_changed int, card_on_dark_web boolean,
        is_valid boolean, _ingested_at timestamp, _source_file string, _batch_id string,
        card_brand_part string, expires_year_part int""",
    "mcc_codes": """
        mcc int, mcc_code string, mcc_description string, _ingested_at timestamp, _source_file string,
        _batch_id string""",
    "quarantine": """
        transaction_id string, amount_raw string, amount_format string, amount_parse_note string,
        quarantine_reason string, quarantine_ts timestamp, resolved_by string, resolved_at timestamp,
        is_resolved boolean, _batch_id string, year int, month int, day int""",
    "dim_users": """
        user_id string, current_age int, retirement_age int, gender string, address string,
        latitude double, longitude double, per_capita_income double, yearly_income double,
        total_debt double, credit_score int, num_credit_cards int, _batch_id string,
        valid_from timestamp, valid_to timestamp, is_current boolean, closed_at string""",
    "dim_cards": """
        card_id string, user_id string, card_brand string, card_type string, card_number_masked string,
        expires_month int, expires_year int, has_chip boolean, num_cards_issued int, credit_limit double,
        acct_open_date string, year_pin_last_changed int, card_on_dark_web boolean, _batch_id string""",
    "features": """
        transaction_id string, user_id string, txn_count_last_1h bigint, txn_count_last_24h bigint,
        txn_count_last_7d bigint, amount_sum_last_1h double, amount_sum_last_24h double,
        amount_vs_user_avg_ratio double, is_night_txn boolean, is_weekend boolean,
        is_foreign_merchant boolean, card_on_dark_web boolean, is_fraud boolean, risk_score double,
        _batch_id string, year int, month int, day int""",
}

# How each table is split into directories.
PARTITIONING = {
    "transactions": ("year", "month", "day"),
    "quarantine": ("year", "month", "day"),
    "features": ("year", "month", "day"),
    "users": ("created_year", "created_month"),
    "cards": ("card_brand_part", "expires_year_part"),
    "mcc_codes": (),
    "fraud_labels": (),
    "dim_users": ("closed_at",),
    "dim_cards": (),
}


def _contract(text: str) -> StructType:
    """Contract from ``name type`` pairs; works before a session exists."""
    pairs = (pair.split() for pair in text.replace("(18,2)", "(18;2)").split(","))
    return StructType([StructField(name, _TYPES[kind.replace(";", ",")]) for name, kind in pairs])


RAW = {
    table: StructType([StructField(c, StringType()) for c in columns.split()])
    for table, columns in _RAW_COLUMNS.items()
}
STAGING = {table: _contract(text) for table, text in _STAGING_COLUMNS.items()}


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Exactly the contract's columns, in its order and types.

    A missing column becomes a typed NULL, a value that cannot be converted
    becomes NULL, and a column outside the contract is left out.
    """
    present = set(df.columns)
    columns = []
    for field in contract.fields:
        if field.name not in present:
            column = F.lit(None).cast(field.dataType)
        elif df.schema[field.name].dataType == field.dataType:
            column = F.col(field.name)
        elif isinstance(field.dataType, StringType):
            column = F.col(field.name).cast("string")
        else:
            column = F.col(field.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)
