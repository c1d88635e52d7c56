from datetime import datetime

from pyspark.sql import functions as F

from cardmill.operators import cleaning, dims
from cardmill.operators.dedup import latest_per_key, latest_where_keyed

T1, T2, T3 = datetime(2020, 1, 1), datetime(2021, 1, 1), datetime(2022, 1, 1)


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "user_id string, city string, name string")


def merge(dim, rows, at):
    return dims.type2_merge(dim, rows, tracked=["city"], as_of=at)


def versions(df):
    return sorted(
        (r["user_id"], r["city"] or "", r["valid_from"].year, r["valid_to"].year, r["is_current"]) for r in df.collect()
    )


def test_type2_history(spark):
    dim = dims.first_versions(snapshot(spark, [("a", "X", "n"), ("b", "X", "n"), ("c", None, "n"), ("gone", "X", "n")]), "user_id", T1)
    dim = merge(dim, snapshot(spark, [("a", "Y", "n"), ("b", "X", "other"), ("c", "X", "n"), ("new", "Z", "n")]), T2)
    dim = merge(dim, snapshot(spark, [("a", "Z", "n"), ("b", "X", "n"), ("c", None, "n"), ("new", "Z", "n")]), T3)
    assert versions(dim) == [
        ("a", "X", 2020, 2021, False),
        ("a", "Y", 2021, 2022, False),
        ("a", "Z", 2022, 9999, True),
        ("b", "X", 2020, 9999, True),
        ("c", "", 2020, 2021, False),
        ("c", "", 2022, 9999, True),
        ("c", "X", 2021, 2022, False),
        ("gone", "X", 2020, 9999, True),
        ("new", "Z", 2021, 9999, True),
    ]
    again = merge(dim, snapshot(spark, [("a", "Z", "n"), ("b", "X", "n"), ("c", None, "n"), ("new", "Z", "n")]), datetime(2023, 1, 1))
    assert versions(again) == versions(dim)


def test_type2_adds_new_columns(spark):
    dim = dims.first_versions(snapshot(spark, [("a", "X", "n")]), "user_id", T1)
    wider = snapshot(spark, [("a", "Y", "n")]).withColumn("phone", F.lit("1"))
    rows = {r["city"]: r["phone"] for r in merge(dim, wider, T2).collect()}
    assert rows == {"X": None, "Y": "1"}


def test_version_at(spark):
    dim = dims.first_versions(snapshot(spark, [("a", "X", "n")]), "user_id", T1)
    dim = merge(dim, snapshot(spark, [("a", "Y", "n")]), T2)
    facts = spark.createDataFrame(
        [(1, "a", datetime(2019, 1, 1)), (2, "a", T1), (3, "a", T2), (4, "z", T2)], "n int, user_id string, at timestamp"
    )
    rows = {r["n"]: r["city"] for r in dims.version_at(facts, dim, "user_id", "at", ["city"]).collect()}
    assert rows == {1: None, 2: "X", 3: "Y", 4: None}


def test_upsert_and_latest_batch(spark):
    target = spark.createDataFrame([("a", 1, "b1"), ("b", 1, "b2")], "k string, v int, _batch_id string")
    updates = spark.createDataFrame([("b", 2, "b3", True)], "k string, v int, _batch_id string, extra boolean")
    merged = dims.upsert(target, updates, "k")
    assert sorted(tuple(r) for r in merged.select("k", "v").collect()) == [("a", 1), ("b", 2)]
    assert sorted(tuple(r) for r in dims.upsert(merged, updates, "k").select("k", "v").collect()) == [("a", 1), ("b", 2)]
    assert [r["k"] for r in dims.latest_batch(merged).collect()] == ["b"]


def test_latest_keeps_newest_and_all_unkeyed(spark):
    rows = [("a", "2024-01-01", "x"), ("a", "2024-01-02", "z"), ("a", "2024-01-02", "y"), ("a", None, "n"), (None, None, "p"), (None, None, "p")]
    df = spark.createDataFrame(rows, "k string, at string, v string")
    kept = latest_where_keyed(df, "k", ["at"], [F.col("v").asc()]).collect()
    assert sorted((r["k"] or "", r["v"]) for r in kept) == [("", "p"), ("", "p"), ("a", "y")]
    once, twice = (latest_per_key(df, ["k"], ["at"]).collect() for _ in range(2))
    assert once == twice


def test_copies_are_limited_before_the_shuffle(spark):
    """A key with very many copies must not be sent to one task in full."""
    df = spark.range(1000).selectExpr("id % 3 as k", "id as at")
    plan = latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_labels_and_codes(spark):
    labels = spark.createDataFrame([("1", "Yes"), ("1", "no"), ("2", "NO"), ("3", None)], "transaction_id string, is_fraud string")
    rows = {r[0]: r[1] for r in cleaning.clean_labels(labels).collect()}
    assert rows == {"1": True, "2": False, "3": None}
    codes = spark.createDataFrame([("5812", "b"), ("5812", "a"), ("x", "c")], "mcc_code string, description string")
    assert [(r["mcc"], r["mcc_description"]) for r in cleaning.clean_mcc_codes(codes).collect()] == [(5812, "a")]


def test_merchants(spark):
    rows = [("m", "c", "S", 1, "d", i == 0, 1.0) for i in range(10)] + [(None, "c", "S", 1, "d", True, 1.0)]
    schema = "merchant_id string, merchant_city string, merchant_state string, mcc int, mcc_description string, is_fraud boolean, amount double"
    row = dims.merchant_dimension(spark.createDataFrame(rows, schema)).collect()
    assert [(r["total_txn_count"], r["fraud_txn_count"], r["fraud_rate"], r["risk_tier"]) for r in row] == [(10, 1, 0.1, "CRITICAL")]
