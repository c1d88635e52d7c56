"""Every registered query against its SQL, and the shape of some plans."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from cardmill.operators.enrich import add_mcc_description
from cardmill.queries.inputs import TEST_TABLES
from cardmill.session import scratch_root
from tools.compare import compare

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TEST_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    line = compare(spark, duck, SMALL, name, QUERIES[name], SQL[name])
    assert line.startswith("ok"), line
    assert "types" not in line, line


def test_entry(spark):
    assert contract.entry(spark).count() == 1000


@pytest.mark.parametrize("name", ["clean_transactions", "enrich_transactions", "user_daily_stats", "dim_merchants", "scd2_merge"])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["dedup_latest", "clean_transactions", "dq_report"])
def test_the_large_source_is_read_once(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert "WindowGroupLimit" in plan


def test_codes_are_salted_where_they_are_not_broadcast(spark):
    txns = spark.range(9).selectExpr("string(id) AS transaction_id", "int(id % 2) AS mcc")
    codes = spark.createDataFrame([(1, "one")], "mcc int, mcc_description string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = add_mcc_description(txns, codes)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and joined.count() == 9
        assert joined.filter("mcc_description = 'one'").count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class _Cluster:
    """The two things ``scratch_root`` asks a session for."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "test-app"})


def test_scratch_folder_is_the_one_the_cluster_names():
    assert scratch_root(_Cluster("hdfs://shared/run/", "yarn")) == "hdfs://shared/run"
    assert scratch_root(_Cluster("/shared/run", "local[2]")) == "/shared/run"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Cluster(None, "yarn"))
    assert scratch_root(_Cluster(None, "local[2]")) == scratch_root(_Cluster(None, "local[2]"))
