from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cardmill.operators import quality
from cardmill import files
from cardmill.plans import ingest, maintenance
from cardmill.plans.layout import Lake
from cardmill.schemas import RAW
from cardmill.sinks import recover, recover_partitions, swap, drop_partition, overwrite_partitions, replace_table
from cardmill.sources import JdbcSource, read_csv, read_json_entries, read_day, read_days, read_json_labels, read_json_map, read_table_if_present

DAYS = "transaction_id string, user_id string, _loaded_at timestamp, year int, month int, day int"


def rows(spark, entries):
    return spark.createDataFrame([(t, u, datetime(2024, 1, n), 2024, 1, d) for t, u, n, d in entries], DAYS)


def content(df):
    return sorted((r["transaction_id"], r["day"]) for r in df.collect())


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert overwrite_partitions(rows(spark, [("a", "u", 1, 1), ("b", "u", 1, 2)]), path, ["year", "month", "day"]) == 2
    for _ in range(2):
        assert overwrite_partitions(rows(spark, [("c", "u", 1, 2)]), path, ["year", "month", "day"]) == 1
    assert content(spark.read.parquet(path)) == [("a", 1), ("c", 2)]
    assert content(read_day(spark, path, date(2024, 1, 2))) == [("c", 2)]
    assert content(read_days(spark, path, date(2023, 12, 31), date(2024, 1, 1))) == [("a", 1)]
    assert drop_partition(spark, path, {"year": 2024, "month": 1, "day": 1})
    assert content(spark.read.parquet(path)) == [("c", 2)]


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(rows(spark, [("a", "u", 1, 1), ("b", "u", 1, 2)]), path, ["year", "month", "day"])
    plan = read_days(spark, path, date(2024, 1, 2), date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "year#" in filters
    assert len(read_day(spark, path, date(2024, 1, 2)).inputFiles()) >= 1


def test_a_table_can_be_replaced_by_its_own_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_table(spark.range(10), path) == 10
    for expected in (20, 40):
        stored = spark.read.parquet(path)
        assert replace_table(stored.union(stored), path) == expected
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_replacement_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        replace_table(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3


def test_compaction(spark, tmp_path):
    path, warm = str(tmp_path / "t"), str(tmp_path / "warm")
    entries = [(f"t{i % 40}", f"u{i % 4}", 1 + i % 2, 1 + i % 2) for i in range(200)]
    rows(spark, entries).repartition(8).write.partitionBy("year", "month", "day").parquet(path)
    # 80 rows of the day are 20 different ids.
    result = maintenance.compact_day(spark, path, date(2024, 1, 1), "transaction_id", file_bytes=5_000)
    assert result.rows == 20 and result.files == 2
    assert content(read_day(spark, path, date(2024, 1, 1))) == sorted((f"t{i}", 1) for i in range(0, 40, 2))
    files = list((tmp_path / "t" / "year=2024" / "month=1" / "day=1").glob("*.parquet"))
    assert len(files) == 2
    again = maintenance.compact_day(spark, path, date(2024, 1, 1), "transaction_id", file_bytes=5_000)
    assert again == result
    assert maintenance.compact_yesterday(spark, path, today=date(2024, 3, 1)).rows is None
    month = maintenance.compact_month(spark, path, warm, 2024, 1, "transaction_id")
    assert month.rows == 40
    packed = list((tmp_path / "warm" / "year=2024" / "month=1").glob("*.parquet"))
    assert len(packed) == 1 and ".zstd." in packed[0].name
    assert maintenance.compact_month(spark, path, warm, 2023, 1).rows is None


def test_one_large_user_fills_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    entries = [(f"t{i:03d}", "one", 1, 1) for i in range(100)]
    rows(spark, entries).write.partitionBy("year", "month", "day").parquet(path)
    maintenance.compact_day(spark, path, date(2024, 1, 1), "transaction_id", file_bytes=10_000)
    files = list((tmp_path / "t" / "year=2024" / "month=1" / "day=1").glob("*.parquet"))
    assert len(files) == 5


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "q")
    old, new = datetime(2023, 1, 1), datetime(2024, 1, 20)
    entries = [("a", False, None, 1), ("b", True, old, 1), ("c", True, new, 2), ("d", True, old, 3), ("e", True, None, 4)]
    df = spark.createDataFrame([(*e[:3], 2024, 1, e[3]) for e in entries], "transaction_id string, is_resolved boolean, resolved_at timestamp, year int, month int, day int")
    overwrite_partitions(df, path, ["year", "month", "day"])
    assert maintenance.vacuum_quarantine(spark, path, 30, date(2024, 1, 31)) == {"removed": 3, "remaining": 2}
    assert content(spark.read.parquet(path)) == [("a", 1), ("c", 2)]
    assert maintenance.vacuum_quarantine(spark, path, 30, date(2024, 1, 31)) == {"removed": 0, "remaining": 2}
    assert maintenance.vacuum_quarantine(spark, str(tmp_path / "none")) == {"removed": 0, "remaining": 0}


def test_csv(spark, tmp_path):
    file = tmp_path / "mcc.csv"
    file.write_text('mcc_code,description\n5812,"Eating, ""Places"""\n5411,\n5499,""\n')
    rows = {r["mcc_code"]: r["description"] for r in read_csv(spark, str(file), RAW["mcc_codes"]).collect()}
    assert rows == {"5812": 'Eating, "Places"', "5411": None, "5499": None}


def test_json_map(spark, tmp_path):
    file = tmp_path / "mcc.json"
    file.write_text('{"5812": "Eating, Places", "5411": "Grocery",\n "5812": "Restaurants"}')
    rows = {r["mcc_code"]: r["description"] for r in read_json_map(spark, str(file), "mcc_code", "description").collect()}
    assert rows == {"5812": "Restaurants", "5411": "Grocery"}
    wrapped = tmp_path / "labels.json"
    wrapped.write_text('{"target": {"1": "Yes"}}')
    assert [tuple(r) for r in read_json_map(spark, str(wrapped), "k", "v", "target").collect()] == [("1", "Yes")]
    assert sorted(tuple(r) for r in read_json_map(spark, str(file), "k", "v", "target").collect())[0] == ("5411", "Grocery")


@pytest.mark.parametrize("text", ['{"1": "Yes", "2": "No", "1": "No"}', '{"target": {"1":"Yes","2":"No",\n"1":"No"}}'])
def test_json_labels(spark, tmp_path, text):
    file = tmp_path / "labels.json"
    file.write_text(text)
    assert sorted(tuple(r) for r in read_json_labels(spark, str(file)).collect()) == [("1", "No"), ("2", "No")]


def test_a_large_label_file_is_read_in_pieces(spark, tmp_path):
    file = tmp_path / "labels.json"
    file.write_text("{" + ", ".join(f'"{i}": "{"Yes" if i % 3 == 0 else "No"}"' for i in range(20_000)) + "}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        labels = read_json_labels(spark, str(file))
        assert spark.read.option("lineSep", ",").text(str(file)).rdd.getNumPartitions() > 4
        assert labels.count() == 20_000
        assert labels.filter("is_fraud = 'Yes'").count() == 6_667
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_jdbc_options():
    source = JdbcSource("jdbc:postgresql://db/payments", "org.postgresql.Driver", "reader", "secret")
    assert "secret" not in repr(source)
    assert source.options()["fetchsize"] == "10000"
    assert source.bounds_query("raw_users", "id") == "(SELECT MIN(CAST(id AS BIGINT)) AS low, MAX(CAST(id AS BIGINT)) AS high FROM raw_users) bounds"
    options = source.range_options("raw_users", "id", 4, 1, 99)
    assert options["dbtable"] == "(SELECT t.*, CAST(t.id AS BIGINT) AS range_key FROM raw_users t) ranged"
    assert (options["partitionColumn"], options["numPartitions"], options["lowerBound"], options["upperBound"]) == ("range_key", "4", "1", "99")


def test_ingest(spark, tmp_path):
    lake = Lake(str(tmp_path))
    spec = {s.table: s for s in ingest.TABLE_SPECS}
    columns = RAW["transactions"].names
    base = dict.fromkeys(columns)
    txns = spark.createDataFrame(
        [tuple({**base, "id": i, "date": d}[c] for c in columns) for i, d in (("1", "2024-01-05 10:00:00"), ("2", "bad"))],
        RAW["transactions"],
    )
    for _ in range(2):
        result = ingest.ingest(lake, spec["transactions"], txns, now=datetime(2024, 2, 1))
        assert result.rows == 2 and result.batch_id.startswith("batch_20240201_000000_")
    stored = {r["id"]: r for r in spark.read.parquet(lake.raw("transactions")).collect()}
    assert (stored["1"]["year"], stored["1"]["month"], stored["1"]["day"]) == (2024, 1, 5)
    assert stored["2"]["year"] is None
    assert stored["1"]["_source_file"] == "raw_transactions" and stored["1"]["_ingested_at"] == datetime(2024, 2, 1)
    assert read_table_if_present(spark, lake.raw("users")) is None


def test_gate(spark):
    df = spark.createDataFrame([("1", "US"), (None, "XX"), ("1", None)], "id string, f string")
    report = quality.union_reports(
        quality.column_checks(df, ["id"], {"f": ["US"]}), quality.unique_check(df, "id")
    )
    rows = {r["check"]: (r["failures"], r["total"], r["passed"]) for r in report.collect()}
    assert rows == {
        "has_rows": (0, 3, True),
        "not_null.id": (1, 3, False),
        "accepted_values.f": (1, 3, False),
        "unique.id": (1, 2, False),
    }
    with pytest.raises(quality.QualityError, match="accepted_values.f, not_null.id, unique.id"):
        quality.gate(report)
    empty = quality.column_checks(df.filter("1 = 0"))
    assert [tuple(r) for r in empty.collect()] == [("has_rows", 1, 0, False)]


@pytest.mark.parametrize("labeled,total,passed", [(80, 100, True), (79, 100, False), (0, 10, False), (0, 0, False)])
def test_label_coverage(spark, labeled, total, passed):
    df = spark.range(total).selectExpr("2023 as year", f"if(id < {labeled}, true, null) as is_fraud")
    assert quality.label_coverage(df, 2023).first()["passed"] is passed


@pytest.mark.parametrize("stop", ["before", "moved", "placed"])
def test_a_stopped_replacement_is_ended_by_the_next_reader(spark, tmp_path, stop):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    folder = swap.swap_folder(path)
    spark.range(5).write.parquet(f"{folder}/{swap.INCOMING}")
    if stop != "before":
        files.rename(spark, path, f"{folder}/{swap.OUTGOING}")
    if stop == "placed":
        files.rename(spark, f"{folder}/{swap.INCOMING}", path)
    assert read_table_if_present(spark, path).count() == (3 if stop == "before" else 5)
    assert not files.exists(spark, folder) and not recover(spark, path)


def test_a_failed_replacement_keeps_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="no"):
        replace_table(spark.range(5).selectExpr("raise_error('no') AS id"), path)
    real = files.rename

    def refuse(session, source, target):
        if source.endswith(swap.INCOMING):
            raise RuntimeError("refused")
        real(session, source, target)

    monkeypatch.setattr(files, "rename", refuse)
    with pytest.raises(RuntimeError, match="refused"):
        replace_table(spark.range(5), path)
    monkeypatch.undo()
    assert read_table_if_present(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_swap_inside_a_partitioned_table_is_no_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6).selectExpr("id", "2024 AS year", "1 AS month", "int(id % 2) + 1 AS day")
    overwrite_partitions(df, path, ["year", "month", "day"])
    day = f"{path}/year=2024/month=1/day=2"
    spark.range(9).write.parquet(f"{swap.swap_folder(day)}/{swap.INCOMING}")
    assert spark.read.parquet(path).count() == 6
    files.rename(spark, day, f"{swap.swap_folder(day)}/{swap.OUTGOING}")
    assert recover_partitions(spark, path) == 1
    assert spark.read.parquet(path).groupBy("day").count().orderBy("day").collect() == [(1, 3), (2, 9)]


def test_json_entries_of_any_shape(spark, tmp_path):
    file = tmp_path / "m.json"
    file.write_text(r'{"1":"Yes","a\\b":"Yes","3":true,"4":null,"n":{"a":[1,2],"b":"}"},"c,d":"x, \"y\" {","1":"No", oops, "6": "z"}')
    for size in ("128m", "7"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = read_json_entries(spark, str(file)).collect()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert {r["key"]: r["value"] for r in rows if r["rejected"] is None} == {
            "1": "No", "a\\b": "Yes", "3": "true", "4": None, "n": '{"a":[1,2],"b":"}"}', "c,d": 'x, "y" {', "6": "z"
        }
        assert [r["rejected"].strip() for r in rows if r["rejected"]] == ["oops"]
