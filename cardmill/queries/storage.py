"""Tables written to the scratch folder by the sinks and read back."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators import cleaning
from cardmill.operators import quality as ops
from cardmill.plans import catalog, ingest, maintenance, repack
from cardmill.plans.layout import Lake
from cardmill.queries import inputs, tables
from cardmill.queries.registry import query
from cardmill.schemas import PARTITIONING, RAW, STAGING, conform
from cardmill.session import materialize, scratch_path
from cardmill.sinks import overwrite_day, overwrite_partitions, overwrite_single_file, replace_table
from cardmill.sources import read_csv, read_days, read_json_labels, read_json_map, read_table, read_table_if_present
from cardmill.sources.files import explode_json_map

_DAY = ("year", "month", "day")
TARGET = date(2024, 1, 15)

_EVENT_COLUMNS = "transaction_id, user_id, transaction_date, CAST(amount AS DOUBLE) AS amount, merchant_state, year, month, day"


def _events(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        "user_id",
        "transaction_date",
        F.col("amount").cast("double").alias("amount"),
        "merchant_state",
        *_DAY,
    )


@query(
    "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 'rewritten' ELSE o_orderpriority END AS o_orderpriority, "
    "CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM {orders}"
)
def dynamic_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """All months are written, then those of one year again: only they change."""
    path = scratch_path(spark, "overwrite")
    orders = inputs.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    overwrite_partitions(orders, path, ["year", "month"])
    rewritten = orders.filter("year = 1998").withColumn("o_orderpriority", F.lit("rewritten"))
    for _ in range(2):
        overwrite_partitions(rewritten, path, ["year", "month"])
    return spark.read.parquet(path)


@query("SELECT r_regionkey, n_nationkey, n_name, s_suppkey FROM {region} JOIN {nation} ON r_regionkey = n_regionkey JOIN {supplier} ON n_nationkey = s_nationkey")
def replace_while_reading(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced by a query that reads it."""
    path = scratch_path(spark, "replace")
    nation = inputs.table(spark, folder, "nation").join(
        inputs.table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey")
    )
    replace_table(nation.select("r_regionkey", "n_nationkey", "n_name"), path)
    suppliers = inputs.table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    stored = spark.read.parquet(path)
    replace_table(stored.join(suppliers, F.col("n_nationkey") == F.col("s_nationkey")).drop("s_nationkey"), path)
    return spark.read.parquet(path)


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev WHERE day <> 16 AND (day <> 15 OR is_fraud IS NOT NULL)")
def rerun_day(spark: SparkSession, folder: str) -> DataFrame:
    """Two days are written again, one with fewer rows, one with none: their old rows go, other days stay."""
    path = scratch_path(spark, "rerun")
    events = tables.event_transactions(spark, folder)
    overwrite_partitions(events, path, _DAY)
    overwrite_day(events.filter("day = 15 AND is_fraud IS NOT NULL"), path, TARGET)
    overwrite_day(events.filter("day = 16 AND false"), path, date(2024, 1, 16))
    return _events(spark.read.parquet(path))


def _stored_events(spark: SparkSession, folder: str) -> str:
    """Event transactions stored by day, each row twice in small files."""
    path = scratch_path(spark, "events")
    rows = tables.event_transactions(spark, folder)
    rows.unionByName(rows).write.partitionBy(*_DAY).parquet(path)
    return path


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev UNION ALL SELECT {_EVENT_COLUMNS} FROM q_ev WHERE day <> 15")
def compact_day(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated rows disappear from the compacted day only."""
    path = _stored_events(spark, folder)
    maintenance.compact_day(spark, path, TARGET, "transaction_id")
    return _events(spark.read.parquet(path))


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev")
def compact_month(spark: SparkSession, folder: str) -> DataFrame:
    path, warm = _stored_events(spark, folder), scratch_path(spark, "warm")
    maintenance.compact_month(spark, path, warm, 2024, 1, "transaction_id")
    months = spark.read.parquet(warm)
    return _events(months.withColumns({"year": F.year("transaction_date"), "month": F.month("transaction_date"), "day": F.dayofmonth("transaction_date")}))


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev UNION ALL SELECT {_EVENT_COLUMNS} FROM q_ev WHERE day <> 15")
def compact_yesterday(spark: SparkSession, folder: str) -> DataFrame:
    """The day before a given one."""
    path = _stored_events(spark, folder)
    maintenance.compact_yesterday(spark, path, "transaction_id", date(2024, 1, 16))
    return _events(spark.read.parquet(path))


@query("SELECT mcc, mcc_code, mcc_description, CAST(1 AS BIGINT) AS files FROM q_mcc")
def single_file(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension as one file, twice; every row says how many files there are."""
    path = scratch_path(spark, "single")
    for _ in range(2):
        overwrite_single_file(tables.mcc_codes(spark, folder).select("mcc", "mcc_code", "mcc_description"), path)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    return stored.select("mcc", "mcc_code", "mcc_description", F.lit(stored.select(F.count_distinct("file")).scalar()).alias("files"))


@query("SELECT 'orders' AS name, count(*) AS rows FROM {orders} UNION ALL SELECT 'missing', CAST(0 AS BIGINT)")
def optional_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table and one that was never written."""
    root = scratch_path(spark, "optional")
    replace_table(inputs.table(spark, folder, "orders"), f"{root}/orders")
    found = {name: read_table_if_present(spark, f"{root}/{name}") for name in ("orders", "missing")}
    empty = inputs.table(spark, folder, "orders").limit(0)
    return ops.row_counts({name: empty if df is None else df for name, df in found.items()}).toDF("name", "rows")


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS rows, sum(count(*)) OVER () = (SELECT count(*) FROM {orders}) AS complete FROM {orders} GROUP BY 1")
def observed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each partition, and whether they add up to the count that the writing stage observed."""
    path = scratch_path(spark, "observed")
    observed = overwrite_partitions(inputs.table(spark, folder, "orders").withColumn("year", F.year("o_orderdate")), path, ["year"])
    counts = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("complete", F.lit(counts.select(F.sum("rows")).scalar()) == observed)


@query("SELECT transaction_id, amount_raw, amount_format, quarantine_reason, is_resolved, year, month FROM q_quarantine")
def quarantine_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows stored by month, those without a date in a partition of their own."""
    path = scratch_path(spark, "quarantine")
    rejected = conform(cleaning.quarantine_rows(tables.cleaned_transactions(spark, folder)), STAGING["quarantine"])
    replace_table(rejected, path, partition_by=("year", "month"))
    stored = spark.read.parquet(path)
    return stored.select("transaction_id", "amount_raw", "amount_format", "quarantine_reason", "is_resolved", "year", "month")


@query("SELECT user_id, age_group, credit_score_band, created_year, created_month FROM q_users")
def cohort_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Users stored by the year and month of their cohort."""
    path = scratch_path(spark, "cohorts")
    replace_table(conform(tables.users(spark, folder), STAGING["users"]), path, partition_by=PARTITIONING["users"])
    return spark.read.parquet(path).select("user_id", "age_group", "credit_score_band", *PARTITIONING["users"])


_FACTS = ("transaction_id", "user_id", "merchant_id", "merchant_city", "merchant_state", "mcc", "mcc_description", "is_fraud", "year", "month", "day")


@query(f"SELECT {', '.join(_FACTS)}, CAST(amount AS DOUBLE) AS amount FROM q_evm WHERE is_valid")
def view_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The fact view over registered staging tables, read by name and stored as a table."""
    lake, prefix = Lake(scratch_path(spark, "lake")), f"cardmill_{uuid.uuid4().hex}_"
    events = inputs.derive(spark, folder, inputs.EVENT_PAYMENTS)
    overwrite_partitions(conform(events, STAGING["transactions"]), lake.staging("transactions"), _DAY)
    catalog.register_tables(spark, lake, prefix)
    catalog.sync_partitions(spark, lake, prefix)
    try:
        catalog.create_views(spark, prefix)
        replace_table(spark.table(f"{prefix}warehouse.fact_transactions"), lake.warehouse("facts"))
    finally:
        for database in ("staging", "warehouse"):
            spark.sql(f"DROP DATABASE {prefix}{database} CASCADE")
    return read_table(spark, lake.warehouse("facts")).select(*_FACTS, "amount")


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev UNION ALL SELECT {_EVENT_COLUMNS} FROM q_ev WHERE day <> 15")
def repack_days(spark: SparkSession, folder: str) -> DataFrame:
    """Small files of two days are gathered; the copies of one of them go, the other is packed as it is."""
    path = _stored_events(spark, folder)
    repack.repack_day(spark, path, TARGET, "transaction_id")
    repack.repack_day(spark, path, date(2024, 1, 16))
    return _events(spark.read.parquet(path))


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev")
def repack_month(spark: SparkSession, folder: str) -> DataFrame:
    path, warm = _stored_events(spark, folder), scratch_path(spark, "warm")
    repack.repack_month(spark, path, warm, 2024, 1, "transaction_id")
    months = spark.read.parquet(warm)
    return _events(months.withColumns({"year": F.year("transaction_date"), "month": F.month("transaction_date"), "day": F.dayofmonth("transaction_date")}))


@query(f"SELECT {_EVENT_COLUMNS} FROM q_ev WHERE day BETWEEN 8 AND 15")
def lookback_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "days")
    overwrite_partitions(tables.event_transactions(spark, folder), path, _DAY, sort_by=["user_id"])
    return _events(read_days(spark, path, date(2024, 1, 8), TARGET))


_RESOLVED = "(is_fraud IS NULL OR day <= 5)"
_RESOLVED_AT = "CASE WHEN day <= 5 THEN TIMESTAMP '2023-11-20 00:00:00' WHEN is_fraud IS NULL THEN TIMESTAMP '2024-01-20 00:00:00' END"


@query(
    f"SELECT transaction_id, is_resolved, resolved_at, year, month, day FROM (SELECT *, {_RESOLVED} AS is_resolved, "
    f"{_RESOLVED_AT} AS resolved_at FROM q_ev) WHERE NOT is_resolved OR resolved_at >= TIMESTAMP '2024-01-01 00:00:00'"
)
def vacuum_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Days that lose all their rows disappear too."""
    path = scratch_path(spark, "quarantine")
    events = tables.event_transactions(spark, folder).withColumns(
        {
            "is_resolved": F.expr(_RESOLVED),
            "resolved_at": F.expr(_RESOLVED_AT),
            "amount_format": F.lit("INVALID"),
        }
    )
    overwrite_partitions(conform(events, STAGING["quarantine"]), path, _DAY)
    maintenance.vacuum_quarantine(spark, path, 30, date(2024, 1, 31))
    return spark.read.parquet(path).select("transaction_id", "is_resolved", "resolved_at", *_DAY)


_CARD_TEXTS = ", ".join(f"nullif({c}, '') AS {c}" for c in RAW["cards"].names)


@query(f"SELECT {_CARD_TEXTS} FROM q_raw_cards")
def csv_source(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    tables.raw_cards(spark, folder).select(*RAW["cards"].names).write.option("header", True).option("nullValue", "").csv(path)
    return read_csv(spark, path, RAW["cards"])


@query("SELECT event_id, key, CAST(value AS STRING) AS value FROM (SELECT event_id, unnest(map_entries(CAST(CAST(props AS JSON) AS MAP(STRING, STRING))), recursive := true) FROM {events})")
def json_map_explode(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events").select("event_id", "props")
    return explode_json_map(events, "props", "key", "value")


@query("SELECT transaction_id, CASE WHEN is_fraud THEN 'Yes' ELSE 'No' END AS is_fraud FROM q_label")
def json_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels written as entries of a JSON object and read back by many tasks."""
    path = scratch_path(spark, "labels")
    entries = F.format_string('"%s": "%s",', "transaction_id", F.when(F.col("is_fraud"), "Yes").otherwise("No"))
    tables.labels(spark, folder).select(entries.alias("value")).write.text(path)
    return read_json_labels(spark, path)


_ODD = {
    0: ("c_name || ', \"the\" one'", "c_mktsegment || ', {x} [y] \\ z'"),
    1: ("c_name", "'true'"),
    2: ("c_name || ' \\'", "NULL"),
    3: ("c_name", "CAST(c_nationkey AS STRING)"),
}


def _odd(part: int) -> str:
    return "CASE c_custkey % 4 " + " ".join(f"WHEN {k} THEN {v[part]}" for k, v in _ODD.items()) + " END"


@query(f"SELECT {_odd(0)} AS key, {_odd(1)} AS value FROM {{customer}}")
def json_map(spark: SparkSession, folder: str) -> DataFrame:
    """Entries with commas, quotes, escapes, brackets, true, null and numbers, each key twice: the last one counts."""
    path = scratch_path(spark, "map")
    plain = {k: tuple(x and x.replace("\\", "\\\\") for x in v) for k, v in _ODD.items()}
    odd = ["CASE c_custkey % 4 " + " ".join(f"WHEN {k} THEN {v[i]}" for k, v in plain.items()) + " END" for i in (0, 1)]
    rows = inputs.table(spark, folder, "customer").select("c_custkey", F.expr(odd[0]).alias("k"), F.expr(odd[1]).alias("v"))
    text = F.to_json(F.create_map("k", "v"))
    bare = F.to_json(F.create_map("k", F.lit("@")))
    entry = F.expr("substr(e, 2, length(e) - 2)")
    raw = F.when(F.col("c_custkey") % 4 == 0, text).otherwise(F.replace(bare, F.lit('"@"'), F.coalesce("v", F.lit("null"))))
    new = rows.withColumn("e", raw).select(F.concat(entry, F.lit(",")).alias("value"))
    old = rows.withColumn("e", bare).select(F.concat(entry, F.lit(",")).alias("value"))
    old.unionByName(new).write.text(path)
    return read_json_map(spark, path, "key", "value")


@query(
    "SELECT id, client_id, card_brand, card_type, card_number, expires, has_chip, num_cards_issued, credit_limit, acct_open_date, "
    "year_pin_last_changed, card_on_dark_web, 'raw_cards' AS _source_file, 'batch_7' AS _batch_id, "
    "TIMESTAMP '2024-01-31 00:00:00' AS _ingested_at, lower(card_brand) AS card_brand_part, "
    "TRY_CAST(nullif(split_part(expires, '/', 2), '') AS INT) AS expires_year_part FROM q_raw_cards"
)
def ingest_template(spark: SparkSession, folder: str) -> DataFrame:
    """Source rows to the raw layer: secrets dropped, audit and partition columns added."""
    lake = Lake(scratch_path(spark, "lake"))
    spec = next(s for s in ingest.TABLE_SPECS if s.table == "cards")
    rows = tables.raw_cards(spark, folder).select(*RAW["cards"].names)
    ingest.ingest(lake, spec, rows, "batch_7", datetime(2024, 1, 31))
    return spark.read.parquet(lake.raw("cards"))


@query("SELECT card_id, card_brand, credit_limit, card_brand_part, expires_year_part FROM q_cards")
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table registered in the catalog, its partitions discovered, then read by name."""
    lake = Lake(scratch_path(spark, "lake"))
    overwrite_partitions(tables.cards(spark, folder), lake.staging("cards"), ("card_brand_part", "expires_year_part"))
    prefix = f"cardmill_{uuid.uuid4().hex}_"
    catalog.register_tables(spark, lake, prefix)
    catalog.sync_partitions(spark, lake, prefix)
    cards = spark.table(f"{prefix}staging.cards")
    found = materialize(cards.select("card_id", "card_brand", "credit_limit", "card_brand_part", "expires_year_part"), "by-name")
    for database in ("staging", "warehouse"):
        spark.sql(f"DROP DATABASE {prefix}{database} CASCADE")  # the tables are external: files stay
    return found
