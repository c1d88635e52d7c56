"""Parquet scans. Days are selected by partition columns, so Spark prunes directories."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardmill.operators.features import between_days
from cardmill import files
from cardmill.sinks.swap import recover


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    recover(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table_if_present(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """None when the table has not been written yet; other errors are not hidden."""
    recover(spark, path)
    return read_table(spark, path, schema) if files.has_data(spark, path) else None


def read_day(spark: SparkSession, path: str, day: date, schema: StructType | str | None = None) -> DataFrame:
    return read_table(spark, path, schema).filter(f"year = {day.year} AND month = {day.month} AND day = {day.day}")


def read_days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    return between_days(read_table(spark, path), first, last)
