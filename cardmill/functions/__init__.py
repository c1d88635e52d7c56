"""Column functions: no DataFrame, no I/O, no Python in the executors."""

from cardmill.functions.cards import mask_pan, months_open, month_year_part
from cardmill.functions.categories import (
    age_group,
    chip_code,
    credit_band,
    credit_out_of_range,
    error_flags,
    has_error,
    risk_tier,
)
from cardmill.functions.money import parse_money, plain_money
from cardmill.functions.places import foreign_state, is_online, zip5
from cardmill.functions.scalars import count_where, share, to_flag, to_int
from cardmill.functions.times import event_second, event_time, is_night, is_weekend

__all__ = [
    "age_group",
    "chip_code",
    "count_where",
    "credit_band",
    "credit_out_of_range",
    "error_flags",
    "event_second",
    "event_time",
    "foreign_state",
    "has_error",
    "is_night",
    "is_online",
    "is_weekend",
    "mask_pan",
    "month_year_part",
    "months_open",
    "parse_money",
    "plain_money",
    "risk_tier",
    "share",
    "to_flag",
    "to_int",
    "zip5",
]
