"""How often the rows of the large tables are moved, and that moving them less changes no row."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from cardmill import session
from cardmill.operators import cleaning, dims, enrich, features, marts
from cardmill.operators.skew import RANGE_ROWS, range_count
from cardmill.queries import tables
from cardmill.queries.registry import all_queries
from cardmill.session import SQL_SETTINGS
from cardmill.sources import read_json_entries


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _added(spark):
    return tables.mcc_codes(spark, SMALL), tables.cards(spark, SMALL), tables.labels(spark, SMALL)


def test_labels_need_no_shuffle_of_transactions(no_broadcast):
    plan = _plan(tables.enriched_transactions(no_broadcast, SMALL))
    assert plan.count("Exchange hashpartitioning(_key") == 1
    assert plan.count("Exchange hashpartitioning(transaction_id") == 1  # the labels' own


def test_cleaning_and_enriching_in_one_equals_one_after_the_other(spark):
    order = [F.col("_source_file").asc_nulls_last()]
    raw = tables.raw_transactions(spark, SMALL)
    steps = enrich.enrich_transactions(cleaning.clean_transactions(raw, order), *_added(spark))
    both = enrich.clean_and_enrich(raw, *_added(spark), order).select(*steps.columns)
    assert steps.exceptAll(both).isEmpty() and both.exceptAll(steps).isEmpty()
    unordered = enrich.clean_and_enrich(raw, *_added(spark))
    assert unordered.count() == steps.count()
    assert unordered.filter("transaction_id IS NULL").count() == raw.filter("id IS NULL").count()


def test_the_mart_of_rows_equals_the_mart_of_stored_features(spark):
    valid = tables.enriched_transactions(spark, SMALL).filter("is_valid").cache()
    users = dims.first_versions(tables.user_snapshot(spark, SMALL, 1), "user_id", datetime(2024, 1, 1))
    merchants = dims.merchant_dimension(valid)
    stored = marts.fraud_mart(marts.fact_transactions(valid), users, features.fraud_features(valid), merchants)
    direct = marts.fraud_mart_of(valid, users, merchants)
    assert stored.schema.simpleString() == direct.schema.simpleString()
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()
    valid.unpersist()


def test_the_mart_of_rows_moves_them_by_user_only(no_broadcast):
    valid = tables.enriched_transactions(no_broadcast, SMALL).filter("is_valid")
    users = dims.first_versions(tables.user_snapshot(no_broadcast, SMALL, 1), "user_id", datetime(2024, 1, 1))
    plan = _plan(marts.fraud_mart_of(valid, users, dims.merchant_dimension(valid).limit(10)))
    assert "transaction_id" not in " ".join(line for line in plan.splitlines() if "Join" in line and "_key" not in line)
    assert plan.count("Exchange hashpartitioning(user_id") == 2  # the rows, and the users


def test_methods_too_large_for_the_jvm_are_not_generated():
    assert int(SQL_SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000


def test_ranges_of_a_hot_key_do_not_grow_with_its_rows():
    assert range_count(0, 5000) == 1 and range_count(20_000, 5000) == 4
    assert range_count(6_600_000, 5000) <= 400 and range_count(240_000_000, 5000) <= 400
    assert range_count(100 * 400 * RANGE_ROWS, 5000) == 40_000  # a range never holds more than a task can


@pytest.mark.parametrize("name", ["unique_keys", "dedup_latest"])
def test_tasks_do_not_grow_with_a_table_of_few_partitions(spark, name):
    """The session has 8 shuffle partitions; large tables get as many tasks as they need."""
    plan = _plan(all_queries()[name].run(spark, SMALL))
    dealt = [line for line in plan.splitlines() if "hashpartitioning(id" in line or "hashpartitioning(l_orderkey" in line]
    assert dealt and all(", 1000)" in line for line in dealt)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == SQL_SETTINGS["spark.sql.files.maxPartitionBytes"]


@pytest.fixture
def own_partitions(spark):
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.mark.parametrize("name", ["unique_keys", "dedup_latest"])
def test_more_partitions_of_a_session_are_kept(own_partitions, name):
    own_partitions.conf.set("spark.sql.shuffle.partitions", "3000")
    plan = _plan(all_queries()[name].run(own_partitions, SMALL))
    dealt = [line for line in plan.splitlines() if "hashpartitioning(id" in line or "hashpartitioning(l_orderkey" in line]
    assert dealt and all(", 3000)" in line for line in dealt)


def test_partitions_grow_with_the_input(own_partitions, monkeypatch):
    read = sum((Path(SMALL) / f"{t}.parquet").stat().st_size for t in ("lineitem", "orders", "supplier"))
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 50)
    latest = all_queries()["dedup_latest"].run(own_partitions, SMALL)
    dealt = [line for line in _plan(latest).splitlines() if "hashpartitioning(id" in line or "hashpartitioning(l_orderkey" in line]
    assert read > 1000 * 50
    assert dealt and all(f", {-(-read // 50)})" in line for line in dealt)


@pytest.mark.parametrize("name", ["user_daily_stats", "label_coverage"])
def test_queries_join_no_side_they_take_nothing_from(no_broadcast, name):
    plan = _plan(all_queries()[name].run(no_broadcast, SMALL))
    assert "card_id" not in plan and "mcc" not in plan


def test_daily_stats_deal_valid_rows_once(no_broadcast):
    plan = _plan(all_queries()["user_daily_stats"].run(no_broadcast, SMALL))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert [line.count("user_id") for line in dealt if "user_id" in line or "merchant_id" in line] == [1]


@pytest.mark.parametrize("name", ["user_daily_stats", "dim_merchants", "merchant_risk_score"])
def test_only_labels_that_are_fraud_move_to_count_frauds(no_broadcast, name):
    plan = _plan(all_queries()[name].run(no_broadcast, SMALL))
    scanned = plan[plan.rindex("Exchange hashpartitioning(transaction_id") :]
    assert "Filter" in scanned and "l_quantity" in scanned[scanned.index("Filter") :].splitlines()[0]


def test_rows_to_count_frauds_give_the_counts_of_all_labels(spark):
    labels = spark.createDataFrame([("a", "Yes"), ("a", "No"), ("b", "no"), ("c", "YES"), ("d", None)], "transaction_id string, is_fraud string")
    assert [r.transaction_id for r in cleaning.clean_labels(labels, frauds_only=True).orderBy("transaction_id").collect()] == ["a", "c"]
    assert cleaning.clean_labels(labels).count() == 4
    full = tables.enriched_transactions(spark, SMALL, with_cards=False)
    counted = tables.counted_transactions(spark, SMALL)
    for mart in (marts.user_daily_stats, marts.merchant_risk_score, lambda rows: dims.merchant_dimension(rows.filter("is_valid"))):
        left, right = mart(full), mart(counted)
        assert left.columns == right.columns
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("name", ["mcc_enrich_unknown", "card_enrich", "label_enrich"])
def test_amounts_are_not_parsed_for_queries_without_them(spark, name):
    assert "_money" not in _plan(all_queries()[name].run(spark, SMALL))


def test_merchants_are_counted_before_their_texts_are_sorted(no_broadcast):
    plan = _plan(all_queries()["dim_merchants"].run(no_broadcast, SMALL))
    assert "card_id" not in plan
    below = plan[plan.rindex("SortAggregate(key=[merchant_id") :]
    assert "HashAggregate(keys=[merchant_id" in below


def test_pieces_of_json_are_not_moved_to_join_their_splits(no_broadcast, tmp_path):
    texts = {"a": '"Yes"', "b": r'"say \"no\", {x}"', "c": "null", "d": "5", "": '""', "e": '{"f": [1, "g"]}', "h\u2028": '"i:j"', "k\\u0041": '"l"'}
    entries = [f'"{k}" \n:\t{v}' for k, v in texts.items()] + ['"m": "\x01"', '"n": "o"  ', '"a": "last"', "p"]
    (tmp_path / "map.json").write_text("{" + ",".join(entries) + "}", encoding="utf-8")
    found = read_json_entries(no_broadcast, str(tmp_path / "map.json"))
    assert "BroadcastHashJoin [_file" in _plan(found)
    rows = {r.key: r.value for r in found.collect() if r.rejected is None}
    assert rows == {
        "a": "last", "b": 'say "no", {x}', "c": None, "d": "5", "": "", "e": '{"f":[1,"g"]}', "h\u2028": "i:j", "kA": "l", "n": "o",
    }
    assert sorted(r.rejected.strip() for r in found.collect() if r.rejected) == ['"m": "\x01"', "p"]
