import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from cardmill.operators import features
from cardmill.operators.skew import hot_keys

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, transaction_date timestamp, amount decimal(18,2), merchant_state string"


def transactions(count, seed=7):
    """One user has a third of all rows and many rows share a second."""
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        user = "hot" if i % 3 == 0 else f"u{pick.randrange(6)}"
        at = START + timedelta(seconds=pick.choice([0, 3600, 3601, 86400, 604800, pick.randrange(20 * 86400)]))
        amount = None if pick.random() < 0.02 else Decimal(pick.randrange(-2000, 9000)) / 100
        rows.append((f"t{i:05d}", user, at, amount, pick.choice(["CA", "DC", None])))
    return rows


def brute_force(rows):
    result = {}
    for txn, user, at, amount, _ in rows:
        mine = [r for r in rows if r[1] == user]
        values = {}
        for name, seconds in {**features.COUNT_FRAMES, **features.SUM_FRAMES}.items():
            inside = [r for r in mine if timedelta(0) <= at - r[2] <= timedelta(seconds=seconds)]
            if name.startswith("txn"):
                values[name] = len(inside)
            else:
                amounts = [r[3] for r in inside if r[3] is not None]
                values[name] = float(sum(amounts)) if amounts else None
        before = [r[3] for r in mine if (r[2], r[0]) <= (at, txn) and r[3] is not None]
        average = float(sum(before)) / len(before) if before else None
        values["user_avg_amount"] = average
        values["amount_vs_user_avg_ratio"] = (
            float(amount) / average if average and average > 0 and amount is not None else None
        )
        result[txn] = values
    return result


@pytest.mark.parametrize("hot_rows,range_rows", [(10**9, 10**9), (100, 10**9), (100, 40), (0, 25)])
def test_velocity_equals_brute_force(spark, hot_rows, range_rows):
    rows = transactions(400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = features.velocity(df, hot_rows=hot_rows, range_rows=range_rows)
    assert sorted(got.columns) == sorted(
        [*df.columns, *features.COUNT_FRAMES, *features.SUM_FRAMES, "user_avg_amount", "amount_vs_user_avg_ratio"]
    )
    expected = brute_force(rows)
    collected = got.collect()
    assert len(collected) == len(rows)
    for row in collected:
        for name, value in expected[row["transaction_id"]].items():
            assert row[name] == value or abs(row[name] - value) < 1e-9, (row["transaction_id"], name)


def test_hot_keys(spark):
    df = spark.createDataFrame(transactions(300), SCHEMA)
    keys, rows = hot_keys(df, "user_id", 90)
    assert [r[0] for r in keys.collect()] == ["hot"] and rows == 100
    assert hot_keys(df, "user_id", 1000) == (None, 0)


def test_bounds_and_peers(spark):
    at = START
    rows = [
        ("a", "u", at, Decimal("1.00"), "CA"),
        ("b", "u", at + timedelta(seconds=3600), Decimal("2.00"), "CA"),
        ("c", "u", at + timedelta(seconds=3601), Decimal("3.00"), "CA"),
        ("d", "v", at, Decimal("5.00"), None),
        ("e", "v", at, Decimal("-9.00"), None),
    ]
    got = {r["transaction_id"]: r for r in features.velocity(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[t]["txn_count_last_1h"] for t in "abcde"] == [1, 2, 2, 2, 2]
    assert got["a"]["amount_vs_user_avg_ratio"] == 1.0
    assert got["e"]["amount_vs_user_avg_ratio"] is None


def test_daily_equals_full_when_history_is_carried(spark):
    rows = [r for r in transactions(300) if r[3] is not None]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*",
        "year(transaction_date) as year",
        "month(transaction_date) as month",
        "day(transaction_date) as day",
        "'b' as _batch_id",
    )
    target = datetime(2024, 1, 15).date()
    opening = features.amounts_before(features.daily_amounts(df), target)
    full = features.fraud_features(df).filter("day = 15")
    daily = features.daily_features(df, target, opening)
    split = features.daily_features(df, target, opening, hot_rows=5)
    expected = sorted(map(str, full.collect()))
    assert expected and sorted(map(str, daily.collect())) == expected
    assert sorted(map(str, split.collect())) == expected


def test_one_shuffle_for_bounded_users(spark):
    df = spark.createDataFrame(transactions(50), SCHEMA)
    plan = features.velocity(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
