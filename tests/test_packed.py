"""Rows of the large tables are moved narrow: texts as one, no column and no copy that goes no further."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_shuffles import _added, _plan, no_broadcast  # noqa: F401

from cardmill.operators import dims, enrich, marts
from cardmill.operators.packed import BETWEEN, ESCAPE, MISSING, pack, unpack
from cardmill.plans import bucketed
from cardmill.queries import tables
from cardmill.queries.registry import all_queries
from cardmill.session import materialize

ODD = ["", " ", None, "a", MISSING, BETWEEN, ESCAPE, f"{ESCAPE}e", f"{ESCAPE}b{BETWEEN}m", f"x{ESCAPE}{MISSING}", "₫ 1.2\n|;é\\", "b", "m", "e"]


def _moved(df):
    """The columns of each exchange by a key, as the plan names them."""
    lines = _plan(df).splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange hashpartitioning(" in line]


def _equal(left, right):
    return left.columns == right.columns and left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_any_texts_come_back(spark):
    rows = [(i, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in ODD for b in ODD for c in (None, "", ESCAPE, "z"))]
    df = spark.createDataFrame(rows, "n int, a string, b string, c string")
    for columns in (["a", "b", "c"], ["b"], ["c", "a"], []):
        assert _equal(unpack(pack(df, columns), columns).select(*df.columns), df)


@pytest.mark.parametrize("name", ["enrich_transactions", "stg_transactions", "fact_view", "fraud_mart"])
def test_raw_texts_are_moved_as_one(no_broadcast, name):  # noqa: F811
    run = all_queries()[name].run if name != "fraud_mart" else tables.mart_rows
    plan = _plan(run(no_broadcast, SMALL))
    by_id = plan[plan.index("Exchange hashpartitioning(_key") :]
    assert plan.index("_packed") < plan.index("Exchange hashpartitioning(_key")  # taken apart above the move
    assert "concat_ws" in by_id[: by_id.index("Exchange hashpartitioning(l_orderkey")]


def test_packed_and_plain_rows_are_the_same(spark):
    order = [F.col("_source_file").asc_nulls_last()]
    raw = tables.raw_transactions(spark, SMALL)
    texts = ("client_id", "amount", "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors")
    for tiebreak in (order, None):
        plain = enrich.clean_and_enrich(raw.filter("id IS NOT NULL"), *_added(spark), tiebreak)
        packed = enrich.clean_and_enrich(raw.filter("id IS NOT NULL"), *_added(spark), tiebreak, texts)
        assert _equal(plain, packed.select(*plain.columns))
    assert _equal(
        tables.mart_rows(spark, SMALL), tables.enriched_transactions(spark, SMALL).filter("is_valid").select(*marts.MART_SOURCE_COLUMNS)
    )


@pytest.mark.parametrize("name", ["stg_transactions", "fact_view"])
def test_rows_without_an_id_are_not_moved_for_valid_rows(no_broadcast, name):  # noqa: F811
    plan = _plan(all_queries()[name].run(no_broadcast, SMALL))
    scanned = plan[plan.index("Exchange hashpartitioning(l_orderkey") :]
    assert "l_partkey" in scanned[scanned.index("Filter") :].splitlines()[0]


def test_rows_are_not_moved_for_few_suppliers(no_broadcast):  # noqa: F811
    plan = _plan(all_queries()["dedup_latest"].run(no_broadcast, SMALL))
    assert "BroadcastHashJoin [l_suppkey" in plan and "hashpartitioning(l_suppkey" not in plan


def test_labels_are_moved_by_their_id_only(no_broadcast):  # noqa: F811
    assert "hashpartitioning(l_orderkey" not in _plan(tables.labels(no_broadcast, SMALL))


def test_invalid_rows_are_not_moved_to_the_cards(no_broadcast):  # noqa: F811
    plan = _plan(tables.mart_rows(no_broadcast, SMALL))
    below = plan[plan.index("Exchange hashpartitioning(card_id") :]
    assert "_money" in below[: below.index("Exchange hashpartitioning(_key")]


@pytest.mark.parametrize("name", ["fraud_mart", "fraud_mart_bucketed"])
def test_the_mart_is_not_moved_for_few_merchants(no_broadcast, name):  # noqa: F811
    plan = _plan(all_queries()[name].run(no_broadcast, SMALL))
    assert "BroadcastHashJoin [merchant_id" in plan and "hashpartitioning(merchant_id" not in plan


def test_intermediate_tables_are_packed(spark):
    assert all(".zstd." in file for file in materialize(spark.range(3), "packed").inputFiles())


def test_buckets_follow_the_input_and_need_no_move(no_broadcast, tmp_path):  # noqa: F811
    assert bucketed.bucket_count(0, 16) == 16 and bucketed.bucket_count(100 * 16 * bucketed.BYTES_PER_BUCKET, 16) == 1600
    spark = no_broadcast
    rows = spark.range(0, 500, 1, 7).selectExpr("string(id) as transaction_id", "id as v")
    spark.sql("CREATE DATABASE IF NOT EXISTS packed_test")
    try:
        left, right = (bucketed.store(rows, f"packed_test.{n}", str(tmp_path / n), buckets=4, dealt=n == "b") for n in ("a", "b"))
        assert len(list((tmp_path / "a").glob("*.parquet"))) > 4 == len(list((tmp_path / "b").glob("*.parquet")))
        both = left.join(right.withColumnRenamed("v", "w"), "transaction_id")
        assert "Exchange" not in _plan(both) and both.filter("v = w").count() == 500
    finally:
        spark.sql("DROP DATABASE IF EXISTS packed_test CASCADE")
