"""Closed code lists and bands."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the card was used.
CHIP_CODES = {"Swipe Transaction": 0, "Chip Transaction": 1, "Online Transaction": 2}

# Flag column and the text that raises it.
ERROR_TEXTS = {
    "error_bad_pin": "Bad PIN",
    "error_bad_cvv": "Bad CVV",
    "error_bad_card_number": "Bad Card Number",
    "error_bad_expiration": "Bad Expiration",
    "error_bad_zipcode": "Bad Zipcode",
    "error_insufficient_balance": "Insufficient Balance",
    "error_technical_glitch": "Technical Glitch",
}

# Lowest score of each band; scores outside the range are invalid.
CREDIT_RANGE = (300, 850)
CREDIT_BANDS = ((800, "EXCEPTIONAL"), (740, "VERY_GOOD"), (670, "GOOD"), (580, "FAIR"), (300, "POOR"))

# Lowest age of each group.
AGE_GROUPS = ((61, "SENIOR"), (41, "MIDDLE_AGED"), (26, "ADULT"), (18, "YOUNG_ADULT"))

# Lowest fraud rate of each tier.
RISK_TIERS = ((0.10, "CRITICAL"), (0.05, "HIGH"), (0.02, "MEDIUM"))


def _floor_band(c: Column, bands: tuple, below: str | None) -> Column:
    """Name of the first band whose lower limit is reached."""
    arms = [F.when(c >= limit, F.lit(name)) for limit, name in bands]
    return F.coalesce(*arms, F.lit(below))


def chip_code(c: Column) -> Column:
    return F.coalesce(*[F.when(c == text, F.lit(code)) for text, code in CHIP_CODES.items()])


def error_flags(c: Column) -> dict[str, Column]:
    """One boolean per known error: a case-sensitive substring."""
    return {name: F.coalesce(c.contains(text), F.lit(False)) for name, text in ERROR_TEXTS.items()}


def has_error() -> Column:
    """Any of the error flag columns."""
    return reduce(or_, [F.col(name) for name in ERROR_TEXTS])


def credit_out_of_range(score: Column) -> Column:
    return F.coalesce(~score.between(*CREDIT_RANGE), F.lit(False))


def credit_band(score: Column) -> Column:
    band = F.when(credit_out_of_range(score), F.lit("INVALID")).otherwise(_floor_band(score, CREDIT_BANDS, None))
    return F.when(score.isNotNull(), band)


def age_group(age: Column) -> Column:
    return F.when(age.isNotNull(), _floor_band(age, AGE_GROUPS, "TEEN"))


def risk_tier(rate: Column) -> Column:
    """Tier of a rounded fraud rate; an unknown rate is LOW."""
    return _floor_band(rate, RISK_TIERS, "LOW")
