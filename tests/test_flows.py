"""A small lake taken through all jobs, in one go and day by day."""

import re
from datetime import date, datetime

import pytest

from cardmill.operators import quality
from cardmill.plans import catalog, flows, incremental, ingest, labels, warehouse
from cardmill.plans.layout import Lake
from cardmill.schemas import RAW

NOW = datetime(2024, 2, 1)

TRANSACTIONS = [
    ("1", "2024-01-01 10:00:00", "u1", "c1", "$10.00", "Swipe Transaction", "m1", "Town", "CA", "1234.0", "5812", None),
    ("2", "2024-01-01 10:30:00", "u1", "c1", "$-5.00", "Chip Transaction", "m1", "ONLINE", None, None, "9999", "Bad PIN"),
    ("3", "2024-01-02 10:00:00", "u1", "c1", "$30.00", "Online Transaction", "m2", "Rome", "Italy", None, None, None),
    ("4", "2024-01-02 11:00:00", "u2", "c9", "1,234", None, "m2", "Rome", "Italy", None, "5812", None),
    ("5", "2024-01-02 12:00:00", "u2", "c2", "$7.00", None, "m2", "Rome", "Italy", None, "5812", None),
]


def fill(spark, lake, labels):
    columns = {
        "transactions": TRANSACTIONS,
        "users": [
            (f"u{i}", "30", "65", "1990", "5", "Female", "Street", "1.5", "2.5", "$1", "$2,000", "$3", "700", "2") for i in (1, 2)
        ],
        "cards": [
            (f"c{i}", f"u{i}", "Visa", "Debit", "4344676511950444", "12/2026", "123", "YES", "1", "$100", "09/2002", "2010", "No")
            for i in (1, 2)
        ],
        "mcc_codes": [("5812", "Eating Places")],
        "fraud_labels": labels,
    }
    specs = {s.table: s for s in ingest.TABLE_SPECS}
    for table, rows in columns.items():
        df = spark.createDataFrame(rows, RAW[table]).selectExpr("*", "timestamp'2024-01-31 00:00:00' as _loaded_at")
        ingest.ingest(lake, specs[table], df, "batch_1", NOW)


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    labels = [("1", "No"), ("2", "Yes"), ("3", "No")]
    at_once, daily = (Lake(str(tmp_path_factory.mktemp(n))) for n in ("once", "daily"))
    fill(spark, at_once, labels)
    fill(spark, daily, labels)
    result = flows.run_backfill(spark, at_once, NOW)
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        flows.run_day(spark, daily, day, NOW)
    return at_once, daily, result


def test_backfill(spark, lakes):
    lake, _, result = lakes
    assert result["transactions"] == {"valid": 4, "quarantine": 1}
    assert result["marts"]["fraud_features"] == 4
    staged = {r["transaction_id"]: r for r in spark.read.parquet(lake.staging("transactions")).collect()}
    assert staged["2"]["is_refund"] and staged["2"]["merchant_state"] == "ONLINE" and staged["2"]["mcc_description"] == "UNKNOWN"
    assert staged["1"]["zip"] == "01234" and staged["1"]["card_number_masked"] == "XXXX-XXXX-XXXX-0444"
    assert [staged[i]["is_fraud"] for i in "1235"] == [False, True, False, None]
    quarantined = spark.read.parquet(lake.quarantine("transactions")).collect()
    assert [(r["transaction_id"], r["quarantine_reason"]) for r in quarantined] == [("4", "AMBIGUOUS")]
    mart = {r["transaction_id"]: r for r in spark.read.parquet(lake.warehouse("fraud_features")).collect()}
    assert mart["2"]["txn_count_last_1h"] == 2 and mart["2"]["merchant_risk_tier"] == "CRITICAL"
    assert mart["3"]["is_foreign_merchant"] and mart["1"]["current_age"] == 30


def test_daily_runs_give_the_same_tables(spark, lakes):
    at_once, daily, _ = lakes
    for path in ("staging:transactions", "warehouse:feat_fraud_features", "warehouse:fraud_features", "warehouse:dim_merchants"):
        layer, table = path.split(":")
        once, by_day = (spark.read.parquet(lake.path(layer, table)) for lake in (at_once, daily))
        assert sorted(once.columns) == sorted(by_day.columns)
        assert sorted(map(str, by_day.select(*once.columns).collect())) == sorted(map(str, once.collect())), table


def test_secrets_stay_out(spark, lakes):
    lake = lakes[0]
    assert "cvv" not in spark.read.parquet(lake.raw("cards")).columns
    assert not {"cvv", "card_number"} & set(spark.read.parquet(lake.staging("cards")).columns)


def test_raw_gate_stops_an_empty_day(spark, lakes):
    with pytest.raises(quality.QualityError, match="transactions.has_rows"):
        flows.run_day(spark, lakes[1], date(2024, 1, 9), NOW)


def test_catalog_and_views(spark, lakes):
    lake = lakes[0]
    names = catalog.register_tables(spark, lake, "flow_")
    assert "flow_warehouse.dim_users" in names
    assert "flow_staging.transactions" in catalog.sync_partitions(spark, lake, "flow_")
    assert spark.table("flow_staging.transactions").count() == 4
    assert spark.table("flow_warehouse.dim_users").filter("is_current").count() == 2
    warehouse.publish_views(spark, lake)
    assert spark.sql("SELECT count(*) FROM fact_transactions WHERE is_valid").first()[0] == 4


def test_marts_and_views_by_name(spark, lakes):
    lake = lakes[0]
    catalog.register_tables(spark, lake, "named_")
    catalog.sync_partitions(spark, lake, "named_")
    assert "named_warehouse.fraud_features" in catalog.register_marts(spark, lake, "named_")
    assert spark.table("named_warehouse.fraud_features").count() == 4
    assert "named_warehouse.fact_transactions" in catalog.create_views(spark, "named_")
    assert spark.newSession().table("named_warehouse.fact_transactions").count() == 4


def _raw(spark, lake, rows):
    spec = next(s for s in ingest.TABLE_SPECS if s.table == "transactions")
    stamped = [(*r[:-1], r[-1]) for r in rows]
    df = spark.createDataFrame([r[:-1] for r in stamped], RAW["transactions"])
    loaded = spark.createDataFrame([(r[0], r[1], r[-1]) for r in stamped], "id string, date string, at string")
    df = df.join(loaded, ["id", "date"]).selectExpr(*RAW["transactions"].names, "to_timestamp(at) as _loaded_at")
    ingest.ingest(lake, spec, df, "batch_2", NOW)


ODD = [
    (*TRANSACTIONS[0], "2024-02-01 00:00:00"),
    (*TRANSACTIONS[2], "2024-02-01 00:00:00"),
    ("7", "2024-01-01 09:00:00", "u1", "c1", "$4.00", None, "m1", "Town", "CA", None, "5812", None, "2024-02-01 00:00:00"),
    ("7", "2024-01-03 09:00:00", "u1", "c1", "$5.00", None, "m1", "Town", "CA", None, "5812", None, "2024-02-02 00:00:00"),
    ("8", "never", "u1", "c1", "$5.00", None, "m1", "Town", "CA", None, "5812", None, "2024-02-01 00:00:00"),
]


def test_days_one_by_one_equal_the_backfill(spark, tmp_path):
    at_once, daily = (Lake(str(tmp_path / n)) for n in ("once", "daily"))
    for lake in (at_once, daily):
        fill(spark, lake, [("1", "No")])
        _raw(spark, lake, ODD)
    flows.run_backfill(spark, at_once, NOW)
    for day in (date(2024, 1, 3), date(2024, 1, 1), date(2024, 1, 2)):
        flows.run_day(spark, daily, day, NOW)
    for layer, table in (("staging", "transactions"), ("warehouse", "feat_fraud_features"), ("warehouse", "user_daily_amounts"), ("warehouse", "fraud_features")):
        once, by_day = (spark.read.parquet(lake.path(layer, table)) for lake in (at_once, daily))
        assert sorted(map(str, by_day.select(*once.columns).collect())) == sorted(map(str, once.collect())), table
    for lake in (at_once, daily):
        assert [(r["transaction_id"], r["year"]) for r in spark.read.parquet(lake.quarantine("transactions")).filter("year IS NULL").collect()] == [("8", None)]
    assert flows.needs_review(spark, daily)
    with pytest.raises(quality.QualityError, match="label_coverage"):
        flows.check_labels(spark, daily, 2024)


def test_a_corrected_row_and_a_renewed_card_leave_nothing_behind(spark, tmp_path):
    lake = Lake(str(tmp_path))
    fill(spark, lake, [("1", "No")])
    flows.run_backfill(spark, lake, NOW)
    rows = [(*t, "2024-02-01 00:00:00") for t in TRANSACTIONS]
    rows[0] = (*rows[0][:4], "N/A", *rows[0][5:])
    rows[1] = (*rows[1][:4], "N/A", *rows[1][5:])
    _raw(spark, lake, rows)
    cards = next(s for s in ingest.TABLE_SPECS if s.table == "cards")
    renewed = [(f"c{i}", f"u{i}", "Visa", "Debit", "4344676511950444", "12/2029", "123", "YES", "1", "$100", "09/2002", "2010", "No") for i in (1, 2)]
    df = spark.createDataFrame(renewed, RAW["cards"]).selectExpr("*", "timestamp'2024-02-02 00:00:00' as _loaded_at")
    ingest.ingest(lake, cards, df, "batch_2", datetime(2024, 2, 2))
    flows.run_day(spark, lake, date(2024, 1, 1), NOW)
    staged = spark.read.parquet(lake.staging("transactions"))
    assert staged.count() == staged.select("transaction_id").distinct().count() == 2
    for table in ("user_daily_amounts", "feat_fraud_features", "fraud_features", "user_daily_stats"):
        assert spark.read.parquet(lake.warehouse(table)).filter("day = 1").count() == 0, table
    flows.run_backfill(spark, lake, NOW)
    assert spark.read.parquet(lake.staging("cards")).count() == 2


def test_jobs_from_the_command_line(spark, lakes, capsys):
    from cardmill.__main__ import main

    root = ["--root", lakes[0].root, "--date", "2024-01-02"]
    main(["check", *root, "--layer", "raw"], spark)
    main(["check", *root], spark)
    assert main(["features", *root], spark) == 2
    assert main(["vacuum", *root], spark)["removed"] == 0
    assert "transactions.has_rows" in capsys.readouterr().out


def _scans(spark, after):
    """(folder, whether days are selected, columns read) of every Parquet scan of the executions after one."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    runs = [listed.apply(i) for i in range(listed.size())]
    texts = [r.physicalPlanDescription() for r in runs if r.executionId() > after]
    scans = [block for text in texts for block in text.split("\n\n") if re.match(r"\(\d+\) Scan parquet", block)]
    for block in scans:
        folder = re.search(r"Location: \w+ \[(?:file:)?([^],]*)", block)[1]
        yield folder, "PartitionFilters: [" in block, re.search(r"ReadSchema: struct<(.*)>", block)[1]


def _last(spark):
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((listed.apply(i).executionId() for i in range(listed.size())), default=-1)


def test_a_day_reads_no_other_days_in_full(spark, tmp_path):
    """Of the staged transactions a day reads days it names; of all days only the key column, to find repeated keys."""
    lake = Lake(str(tmp_path))
    fill(spark, lake, [("1", "No")])
    flows.run_backfill(spark, lake, NOW)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        before = _last(spark)
        flows.run_day(spark, lake, date(2024, 1, 2), NOW)
        seen = list(_scans(spark, before))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    staged = [(days, columns) for folder, days, columns in seen if folder.rstrip("/").endswith("staging/transactions")]
    assert any(days for days, _ in staged)
    assert {columns for days, columns in staged if not days} <= {"transaction_id:string"}


def test_one_feature_job_and_one_mart_job_for_all_later_days(spark, tmp_path, monkeypatch):
    lake, calls = Lake(str(tmp_path)), []
    fill(spark, lake, [("1", "No")])
    flows.run_backfill(spark, lake, NOW)
    for name in ("build_features_days", "build_marts_days"):
        real = getattr(warehouse, name)
        monkeypatch.setattr(warehouse, name, lambda *a, real=real, name=name: calls.append((name, a[2])) or real(*a))
    flows.run_day(spark, lake, date(2024, 1, 1), NOW)
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    assert calls == [("build_features_days", days), ("build_marts_days", days)]


def test_late_labels_reach_the_marts(spark, tmp_path):
    once, later = (Lake(str(tmp_path / n)) for n in ("once", "later"))
    all_labels = [("1", "No"), ("2", "Yes"), ("5", "Yes")]
    for lake, given in ((once, all_labels), (later, all_labels[:1])):
        fill(spark, lake, given)
        flows.run_backfill(spark, lake, NOW)
    late = spark.createDataFrame(all_labels[1:], RAW["fraud_labels"])
    assert labels.run_labels(spark, later, late)["days"] == ["2024-01-01", "2024-01-02"]
    assert labels.run_labels(spark, later, late) == {"days": []}
    for table in ("feat_fraud_features", "fraud_features", "user_daily_stats", "dim_merchants", "merchant_risk_score"):
        left, right = (spark.read.parquet(lake.warehouse(table)) for lake in (once, later))
        assert sorted(map(str, right.select(*left.columns).collect())) == sorted(map(str, left.collect())), table


def test_users_and_cards_by_batch(spark, lakes):
    lake = lakes[0]
    for _ in range(2):
        assert incremental.load_users(spark, lake) == {"loaded": 2, "rows": 2}
        assert incremental.load_cards(spark, lake) == {"loaded": 2, "rows": 2}
    assert "is_valid" not in incremental.read_batches(spark, lake.warehouse("users_by_batch")).columns
