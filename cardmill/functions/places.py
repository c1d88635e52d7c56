"""Merchant place: online purchases, zip codes, foreign states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ONLINE = "ONLINE"

# Two-letter codes of the 50 US states. The federal district is
# not one of them, so DC counts as foreign.
US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY",
    "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND",
    "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)


def is_online(state: Column, city: Column) -> Column:
    """No state and city ONLINE. NULL when both are missing."""
    return state.isNull() & (F.upper(city) == ONLINE)


def zip5(c: Column) -> Column:
    """``58523.0`` to ``58523``, padded to five characters (sign included).

    Anything that is not a number passes through unchanged.
    """
    text = F.btrim(c)
    number = F.when(
        text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text
    ).try_cast("double").try_cast("bigint")
    digits = F.abs(number).cast("string")
    unsigned = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    signed = F.concat(F.lit("-"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))
    return F.coalesce(F.when(number < 0, signed).otherwise(unsigned), c)


def foreign_state(state: Column) -> Column:
    return ~state.isin(*US_STATES)
