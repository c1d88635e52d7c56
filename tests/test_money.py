from decimal import Decimal

import pytest

from cardmill import functions as fn

# text, amount, format, currency
CASES = [
    ("$1,234.56", "1234.56", "US", "USD"),
    ("$-77.00", "-77.00", "CLEAN", "USD"),
    ("1.234,56", "1234.56", "EU", None),
    ("1234.56", "1234.56", "CLEAN", None),
    ("₫200,000", "200000", "VN", "VND"),
    ("(500.00)", "-500", "CLEAN", None),
    ("1,234", None, "AMBIGUOUS", None),
    ("1.234", None, "AMBIGUOUS", None),
    ("₫1,234", "1234", "VN", "VND"),
    (None, None, "INVALID", None),
    ("N/A", None, "INVALID", None),
    ("1.234.567", "1234567", "VN", None),
    ("1,234,567", "1234567", "US", None),
    ("1234,56", "1234.56", "EU", None),
    ("$14.57", "14.57", "CLEAN", "USD"),
    ("$1,234", None, "AMBIGUOUS", "USD"),
    ("-$77", None, "INVALID", None),
    ("1 234,56", "1234.56", "EU", None),
    ("1 234,56", "1234.56", "EU", None),
    ("200,000 VND", "200000", "VN", "VND"),
    ("1,234.567", "1234.57", "US", None),
    ("1.2,3.4", None, "INVALID", None),
    ("$", None, "INVALID", "USD"),
    ("()", None, "INVALID", None),
    ("1e3", "1000", "CLEAN", None),
    ("None", None, "INVALID", None),
    ("usd 5.00", "5", "CLEAN", "USD"),
    ("nan", None, "INVALID", None),
    ("1_000", None, "INVALID", None),
    ("₫1.abc", None, "AMBIGUOUS", "VND"),
    ("₫1,234,567", "1234567", "US", "VND"),
    ("1e20", None, "CLEAN", None),
    ("(-5)", "5", "CLEAN", None),
    ("", None, "INVALID", None),
    ("\t 　", None, "INVALID", None),
    (" $5\n", "5", "CLEAN", "USD"),
    ("9999999999999999.99", "9999999999999999.99", "CLEAN", None),
    ("10 thb", "10", "CLEAN", "THB"),
]

NOTES = [
    (None, "null input"),
    ("null", "empty or placeholder"),
    ("5", "clean numeric"),
    ("x", "cannot parse: x"),
    ("1,234.5", "US format"),
    ("1.2,3.4", "US parse failed: 1.2,3.4"),
    ("1.234,5", "EU format"),
    ("1,2.3,4", "EU parse failed: 1,2.3,4"),
    ("1.2.3", "multiple dots = thousand sep"),
    ("1.2.x", "multi-dot parse failed: 1.2.x"),
    ("₫1.234", "VND → dot is thousand sep"),
    ("1.234", "ambiguous: '1.234' could be 1234 or 1.234"),
    ("1.5", "decimal number"),
    ("1,2,3", "multiple commas = thousand sep"),
    ("1,2,x", "multi-comma parse failed: 1,2,x"),
    ("₫1,234", "VND → comma is thousand sep"),
    ("1,234", "ambiguous: '1,234' could be 1234 or 1.234"),
    ("1,5", "EU decimal comma"),
    ("a,5", "cannot parse: a,5"),
]


def test_amounts(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, amount string")
    rows = {r["i"]: r for r in fn.parse_money(df).collect()}
    for i, (text, amount, form, currency) in enumerate(CASES):
        got = rows[i]
        expected = None if amount is None else Decimal(amount)
        assert (got["amount_raw"], got["amount"], got["amount_format"], got["amount_currency"]) == (
            text,
            expected,
            form,
            currency,
        ), text


def test_notes(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(NOTES)], "i int, amount string")
    rows = {r["i"]: r["amount_parse_note"] for r in fn.parse_money(df).collect()}
    assert [rows[i] for i in range(len(NOTES))] == [note for _, note in NOTES]


def test_only_the_source_column_changes(spark):
    df = spark.createDataFrame([("a", "$1.00", 7)], "id string, price string, n int")
    parsed = fn.parse_money(df, "price")
    assert parsed.columns == ["id", "n", "amount_raw", "amount", "amount_currency", "amount_format", "amount_parse_note"]
    assert dict(parsed.dtypes)["amount"] == "decimal(18,2)"


@pytest.mark.parametrize("text,value", [("$29,278", 29278.0), ("x", None), (None, None), ("-$5", -5.0)])
def test_plain_money(spark, text, value):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "m string")
    assert df.select(fn.plain_money(F.col("m"))).first()[0] == value


def test_a_filter_on_the_result_does_not_repeat_the_steps(spark):
    """Planning must stay small however the parsed columns are filtered."""
    df = fn.parse_money(spark.createDataFrame([("1",)], "amount string"))
    plan = df.filter("amount > 0 and amount_format = 'US'")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 30_000
