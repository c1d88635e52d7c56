"""Small building blocks. Bad input gives NULL; nothing here throws under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: Column) -> Column:
    """Text to int. A fraction such as ``5812.0`` is cut off, as in a lenient cast."""
    text = F.btrim(c)
    cut = F.when(text.rlike(r"^[+-]?\d+\.\d*$"), F.substring_index(text, ".", 1)).otherwise(text)
    return cut.try_cast("int")


def to_flag(c: Column) -> Column:
    """Yes/No text in any case to boolean; NULL stays NULL."""
    return F.upper(c) == F.lit("YES")


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; NULL counts as not true."""
    return F.count(F.when(condition, F.lit(1)))


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` rounded to four digits; NULL when there is no whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 4)
