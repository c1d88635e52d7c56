"""Locale-aware money text as column expressions.

The text is reduced in steps (trim, currency, sign, inner spaces), then its
separators name a *layout*. The layout alone decides which separators are
dropped, which one is the decimal point, and which format and note are given.
Every step is a projection inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(18,2)"

# Text that stands for "no amount".
PLACEHOLDERS = ("", "-", "N/A", "n/a", "NULL", "null", "none")

# Leading currency signs.
CURRENCY_SIGNS = {"$": "USD", "€": "EUR", "£": "GBP", "₫": "VND", "¥": "JPY"}

# Currency words, matched anywhere and in any case.
CURRENCY_WORDS = ("USD", "EUR", "GBP", "VND", "JPY", "SGD", "THB")

# Characters that count as blank at either end of the text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Format and note per layout, and the note when the digits are unreadable.
LAYOUTS = {
    "bare": ("CLEAN", "clean numeric", "cannot parse: "),
    "dot_decimal": ("US", "US format", "US parse failed: "),
    "comma_decimal": ("EU", "EU format", "EU parse failed: "),
    "dots": ("VN", "multiple dots = thousand sep", "multi-dot parse failed: "),
    "dot": ("CLEAN", "decimal number", "cannot parse: "),
    "dot_three": ("VN", "VND → dot is thousand sep", None),
    "commas": ("US", "multiple commas = thousand sep", "multi-comma parse failed: "),
    "comma": ("EU", "EU decimal comma", "cannot parse: "),
    "comma_three": ("VN", "VND → comma is thousand sep", None),
}

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_WORD = r"(?i)\b(" + "|".join(CURRENCY_WORDS) + r")\b"


def plain_money(c: Column) -> Column:
    """``$29,278`` to double."""
    return _without(_without(c, "$"), ",").try_cast("double")


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def _has_blank_end(c: Column) -> Column:
    """Cheap test that saves the trim on most texts."""
    return F.left(c, F.lit(1)).isin(*BLANKS) | F.right(c, F.lit(1)).isin(*BLANKS)


def _has_letters(c: Column) -> Column:
    """Cheap test that saves the word search on purely numeric text."""
    return F.upper(c) != F.lower(c)


def _without(c: Column, char: str) -> Column:
    return F.replace(c, F.lit(char), F.lit(""))


def _swapped(c: Column, char: str, other: str) -> Column:
    return F.replace(c, F.lit(char), F.lit(other))


def _occurrences(c: Column, char: str) -> Column:
    return F.length(c) - F.length(_without(c, char))


def _after_last(c: Column, char: str) -> Column:
    """Characters after the last occurrence."""
    return F.length(F.substring_index(c, char, -1))


def _pick(layout: Column, values: dict[str, Column | str]) -> Column:
    arms = [
        F.when(layout == name, value if isinstance(value, Column) else F.lit(value))
        for name, value in values.items()
        if value is not None
    ]
    return F.coalesce(*arms)


def _layout(text: Column, dots: Column, commas: Column) -> Column:
    three = F.lit(3)
    mixed = F.when(_after_last(text, ".") < _after_last(text, ","), "dot_decimal").otherwise("comma_decimal")
    only_dots = (
        F.when(dots > 1, "dots").when(_after_last(text, ".") == three, "dot_three").otherwise("dot")
    )
    only_commas = (
        F.when(commas > 1, "commas").when(_after_last(text, ",") == three, "comma_three").otherwise("comma")
    )
    return (
        F.when((dots == 0) & (commas == 0), "bare")
        .when(commas == 0, only_dots)
        .when(dots == 0, only_commas)
        .otherwise(mixed)
    )


def _settle(df: DataFrame, *names: str) -> DataFrame:
    """Compute these steps here, once, and in a method of their own.

    Filters stay above a generator. Without one, a later filter on the parsed
    amount is pushed down by repeating all steps in it, once per reference; and
    all steps share one generated method, which the JVM stops compiling when it
    grows beyond 8 kB of byte code.
    """
    steps = [f"_money_{n}" for n in names]
    others = [c for c in df.columns if c not in steps]
    return df.select(*others, F.inline(F.array(F.struct(*steps))))


def parse_money(df: DataFrame, source: str = "amount") -> DataFrame:
    """Replace ``source`` by ``amount_raw`` and add the four parsed columns.

    Adds ``amount`` decimal(18,2), ``amount_currency``, ``amount_format`` and
    ``amount_parse_note``. An amount that could be read in two ways stays NULL
    and is marked AMBIGUOUS; no row is dropped.
    """
    kept = [c for c in df.columns if c != source]
    raw, text, currency, body, digits, layout, number, negative, value = (
        F.col(f"_money_{n}")
        for n in ("raw", "text", "currency", "body", "digits", "layout", "number", "negative", "value")
    )

    word = F.upper(F.regexp_extract(text, _WORD, 1))
    sign_code = _pick(F.left(text, F.lit(1)), CURRENCY_SIGNS)
    has_sign = F.left(text, F.lit(1)).isin(*CURRENCY_SIGNS)
    usable = text.isNotNull() & ~text.isin(*PLACEHOLDERS)

    uncoined = (
        F.when(has_sign, _trim(F.substr(text, F.lit(2))))
        .when(currency.isNotNull(), _trim(F.regexp_replace(text, _WORD, "")))
        .otherwise(text)
    )
    bracketed = body.startswith("(") & body.endswith(")")
    unsigned = (
        F.when(bracketed, _trim(F.substr(body, F.lit(2), F.length(body) - 2)))
        .when(body.startswith("-"), _trim(F.substr(body, F.lit(2))))
        .otherwise(body)
    )
    no_dots, no_commas = _without(digits, "."), _without(digits, ",")
    readable = _pick(
        layout,
        {
            "bare": digits,
            "dot_decimal": no_commas,
            "comma_decimal": _swapped(no_dots, ",", "."),
            "dots": no_dots,
            "dot": digits,
            "dot_three": F.when(currency == "VND", no_dots),
            "commas": no_commas,
            "comma": _swapped(digits, ",", "."),
            "comma_three": F.when(currency == "VND", no_commas),
        },
    )
    undecided = layout.isin("dot_three", "comma_three") & number.isNull()
    two_ways = F.concat(
        F.lit("ambiguous: '"),
        digits,
        F.lit("' could be "),
        _without(no_dots, ","),
        F.lit(" or "),
        _swapped(digits, ",", "."),
    )
    unreadable = F.concat(_pick(layout, {k: v[2] for k, v in LAYOUTS.items()}), digits)

    coined = (
        df.withColumnRenamed(source, "_money_raw")
        .withColumn("_money_text", F.when(_has_blank_end(raw), _trim(raw)).otherwise(raw))
        .withColumn(
            "_money_currency",
            F.when(
                usable,
                F.when(has_sign, sign_code).when(_has_letters(text), F.nullif(word, F.lit(""))),
            ),
        )
        .withColumn("_money_body", F.when(usable, uncoined))
    )
    measured = (
        _settle(coined, "text", "currency", "body")
        .withColumn("_money_negative", bracketed | body.startswith("-"))
        .withColumn("_money_digits", _without(_without(unsigned, " "), "\xa0"))
        .withColumns({"_money_dots": _occurrences(digits, "."), "_money_commas": _occurrences(digits, ",")})
        .withColumn(
            "_money_layout",
            F.when(digits.isNotNull(), _layout(digits, F.col("_money_dots"), F.col("_money_commas"))),
        )
        .withColumn("_money_number", readable)
        .withColumn("_money_number", F.when(number.rlike(_NUMBER), number))
        .withColumn("_money_value", number.try_cast(AMOUNT_TYPE))
        .withColumn("_money_amount", F.when(negative, -value).otherwise(value).cast(AMOUNT_TYPE))
        .withColumn(
            "_money_format",
            F.when(undecided, F.lit("AMBIGUOUS"))
            .when(number.isNull(), F.lit("INVALID"))
            .otherwise(_pick(layout, {k: v[0] for k, v in LAYOUTS.items()})),
        )
    )
    helpers = [f"_money_{n}" for n in ("body", "negative", "dots", "commas", "value")]
    settled = _settle(measured.drop(*helpers), "amount", "format", "digits", "layout", "number")
    return settled.select(
        *kept,
        raw.alias("amount_raw"),
        F.col("_money_amount").alias("amount"),
        currency.alias("amount_currency"),
        F.col("_money_format").alias("amount_format"),
        F.when(raw.isNull(), F.lit("null input"))
        .when(~usable, F.lit("empty or placeholder"))
        .when(undecided, two_ways)
        .when(number.isNull(), unreadable)
        .otherwise(_pick(layout, {k: v[1] for k, v in LAYOUTS.items()}))
        .alias("amount_parse_note"),
    )
