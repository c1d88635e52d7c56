from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators import cleaning
from cardmill.schemas import STAGING, conform


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def test_mask(spark):
    values = ["4344676511950444", "12", "", "abc", None]
    masked = ["XXXX-XXXX-XXXX-0444", "XXXX-XXXX-XXXX-0012", None, "XXXX-XXXX-XXXX-0000", None]
    assert apply(spark, values, fn.mask_pan) == masked


def test_zip(spark):
    values = ["58523.0", "1234.0", "123456.0", "-5", "-12345", "abc", "ONLINE", None, "1e3", "5d", " 7.9 "]
    assert apply(spark, values, fn.zip5) == [
        "58523", "01234", "123456", "-0005", "-12345", "abc", "ONLINE", None, "01000", "5d", "00007",
    ]


def test_bands(spark):
    scores = [299, 300, 579, 580, 669, 670, 739, 740, 799, 800, 850, 851, None]
    assert apply(spark, scores, fn.credit_band, "int") == [
        "INVALID", "POOR", "POOR", "FAIR", "FAIR", "GOOD", "GOOD", "VERY_GOOD", "VERY_GOOD", "EXCEPTIONAL",
        "EXCEPTIONAL", "INVALID", None,
    ]
    assert apply(spark, [299, 300, 851, None], fn.credit_out_of_range, "int") == [True, False, True, False]
    ages = [17, 18, 25, 26, 40, 41, 60, 61, None]
    assert apply(spark, ages, fn.age_group, "int") == [
        "TEEN", "YOUNG_ADULT", "YOUNG_ADULT", "ADULT", "ADULT", "MIDDLE_AGED", "MIDDLE_AGED", "SENIOR", None,
    ]
    rates = [0.1, 0.05, 0.02, 0.0199, None]
    assert apply(spark, rates, fn.risk_tier, "double") == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "LOW"]


def test_codes_and_flags(spark):
    chips = ["Swipe Transaction", "Chip Transaction", "Online Transaction", "Foo", None]
    assert apply(spark, chips, fn.chip_code) == [0, 1, 2, None, None]
    assert apply(spark, ["YES", "Yes", "No", None], fn.to_flag) == [True, True, False, None]
    assert apply(spark, ["CA", "DC", "ONLINE", None], fn.foreign_state) == [False, True, True, None]
    assert apply(spark, ["5812", "5812.0", " 7 ", "x", None], fn.to_int) == [5812, 5812, 7, None, None]


def test_dates(spark):
    assert apply(spark, ["09/2002", "bad", None, "13"], lambda c: fn.months_open(c, 2024, 1)) == [256, None, None, None]
    assert apply(spark, ["12/2022", "soon", None], lambda c: fn.month_year_part(c, 1)) == [2022, None, None]
    times = apply(spark, ["2023-06-01 10:00:00", "06/01/2023", None], fn.event_time)
    assert [t is not None for t in times] == [True, False, False]


def test_errors(spark):
    df = spark.createDataFrame(
        [("Bad PIN,Insufficient Balance",), (None,), ("bad pin",)], "errors string"
    )
    rows = cleaning.mark_errors(df).collect()
    raised = [{k for k, v in r.asDict().items() if v} for r in rows]
    assert raised[0] == {"error_bad_pin", "error_insufficient_balance", "has_error"}
    assert raised[1] == raised[2] == set()
    assert all(v is not None for r in rows for v in r)


def test_online(spark):
    df = spark.createDataFrame(
        [(None, "Online", "1.0"), (None, None, "2.0"), ("CA", "ONLINE", "3.0")],
        "merchant_state string, merchant_city string, zip string",
    )
    rows = [tuple(r) for r in cleaning.mark_place(df).select("is_online_transaction", "merchant_state", "zip").collect()]
    assert rows == [(True, "ONLINE", "ONLINE"), (None, None, "00002"), (False, "CA", "00003")]


def test_time_flags(spark):
    df = spark.createDataFrame([("2024-01-06 05:59:59",), ("2024-01-08 06:00:00",)], "t string").select(
        F.col("t").cast("timestamp").alias("t")
    )
    rows = [tuple(r) for r in df.select(fn.is_night(F.col("t")), fn.is_weekend(F.col("t"))).collect()]
    assert rows == [(True, True), (False, False)]


def test_conform(spark):
    df = spark.createDataFrame([("5", "x", "n")], "mcc string, mcc_description string, extra string")
    conformed = conform(df, STAGING["mcc_codes"])
    assert conformed.schema.names == STAGING["mcc_codes"].names
    assert [f.dataType for f in conformed.schema] == [f.dataType for f in STAGING["mcc_codes"]]
    assert tuple(conformed.first())[:3] == (5, None, "x")


def test_schemas_need_no_session():
    assert STAGING["transactions"]["amount"].dataType.simpleString() == "decimal(18,2)"
