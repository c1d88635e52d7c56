"""Card numbers and card dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardmill.functions.scalars import to_int

MASK_PREFIX = "XXXX-XXXX-XXXX-"


def mask_pan(c: Column) -> Column:
    """Keep the last four digits of a card number; missing or empty gives NULL."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(c != "", F.concat(F.lit(MASK_PREFIX), F.lpad(F.right(digits, F.lit(4)), 4, "0")))


def month_year_part(c: Column, position: int) -> Column:
    """Part 0 (month) or 1 (year) of ``MM/YYYY`` as int."""
    return to_int(F.get(F.split(c, "/"), F.lit(position)))


def months_open(opened: Column, year: int, month: int) -> Column:
    """Whole months from ``MM/YYYY`` to the given month; unreadable text gives NULL."""
    parts = F.split(opened, "/")
    opened_month = F.get(parts, F.lit(0)).try_cast("int")
    opened_year = F.get(parts, F.lit(1)).try_cast("int")
    return (F.lit(year) - opened_year) * 12 + (F.lit(month) - opened_month)
