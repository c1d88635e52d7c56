"""External catalog tables over the lake directories."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cardmill.operators import marts
from cardmill.plans.layout import Lake
from cardmill.schemas import PARTITIONING, STAGING
from cardmill import files

# Database, table, contract and layer directory.
TABLES = (
    ("staging", "transactions", "transactions", ("staging", "transactions")),
    ("staging", "users", "users", ("staging", "users")),
    ("staging", "cards", "cards", ("staging", "cards")),
    ("staging", "mcc_codes", "mcc_codes", ("staging", "mcc_codes")),
    ("staging", "transactions_quarantine", "quarantine", ("quarantine", "transactions")),
    ("warehouse", "dim_users", "dim_users", ("warehouse", "dim_users")),
    ("warehouse", "dim_cards", "dim_cards", ("warehouse", "dim_cards")),
    ("warehouse", "feat_fraud_features", "features", ("warehouse", "feat_fraud_features")),
)

# Stored marts, which bring their own columns, and their partitions.
MARTS = {
    "dim_merchants": (),
    "merchant_days": ("year", "month", "day"),
    "merchant_months": ("year", "month"),
    "user_daily_amounts": ("year", "month", "day"),
    "fraud_features": ("year", "month", "day"),
    "user_daily_stats": ("year", "month", "day"),
    "merchant_risk_score": ("year", "month"),
}

# Name, and the table it is a view of.
VIEWS = {
    "stg_transactions": (marts.staging_transactions, "transactions"),
    "stg_users": (marts.staging_users, "users"),
    "stg_cards": (marts.staging_cards, "cards"),
    "fact_transactions": (marts.fact_transactions, "transactions"),
}


def create_table_sql(database: str, table: str, contract: str, location: str) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STAGING[contract].fields)
    keys = PARTITIONING[contract]
    partitioned = f" PARTITIONED BY ({', '.join(keys)})" if keys else ""
    return f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet{partitioned} LOCATION '{location}'"


def register_tables(spark: SparkSession, lake: Lake, prefix: str = "") -> list[str]:
    """Create the databases and external tables that do not exist yet. ``prefix`` goes before the database names."""
    names = []
    for database, table, contract, (layer, directory) in TABLES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{database}")
        spark.sql(create_table_sql(prefix + database, table, contract, lake.path(layer, directory)))
        names.append(f"{prefix}{database}.{table}")
    return names


def sync_partitions(spark: SparkSession, lake: Lake, prefix: str = "") -> list[str]:
    """Make new and removed partition directories of the stored tables visible in the catalog."""
    synced = []
    for database, table, contract, (layer, directory) in TABLES:
        if PARTITIONING[contract] and files.exists(spark, lake.path(layer, directory)):
            spark.sql(f"MSCK REPAIR TABLE {prefix}{database}.{table} SYNC PARTITIONS")
            synced.append(f"{prefix}{database}.{table}")
    return synced


def register_marts(spark: SparkSession, lake: Lake, prefix: str = "") -> list[str]:
    """External tables over the marts that are stored; columns are read from their files."""
    names = []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}warehouse")
    for table, keys in MARTS.items():
        path, name = lake.warehouse(table), f"{prefix}warehouse.{table}"
        if not files.has_data(spark, path):
            continue
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        if keys:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
        names.append(name)
    return names


def create_views(spark: SparkSession, prefix: str = "") -> list[str]:
    """Staging and fact views that outlive the session, over the registered staging tables."""
    names = []
    for view, (projection, table) in VIEWS.items():
        source = f"{prefix}staging.{table}"
        wanted = projection(spark.table(source))
        columns = ", ".join(
            f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in wanted.schema.fields
        )
        key = {"transactions": "is_valid", "users": "user_id IS NOT NULL", "cards": "card_id IS NOT NULL"}[table]
        name = f"{prefix}warehouse.{view}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}warehouse")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {source} WHERE {key}")
        names.append(name)
    return names
