"""Labels that arrive late: only the days they change are written again.

The labels are joined to the keys and current labels of the staged transactions, three narrow columns, which names the
days that differ. A label that says what is already stored changes nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators import cleaning
from cardmill.operators.features import on_days
from cardmill.plans import warehouse
from cardmill.plans.layout import Lake
from cardmill.session import drop_table, materialize, scratch_run
from cardmill.sinks import overwrite_days
from cardmill.sources import read_table

_DAY = ("year", "month", "day")


def days_touched(txns: DataFrame, labels: DataFrame) -> list[date]:
    """Days with a transaction whose label is not the stored one; one row a day comes back."""
    new = labels.select("transaction_id", F.col("is_fraud").alias("_label"))
    joined = txns.select("transaction_id", "is_fraud", *_DAY).join(new, "transaction_id")
    found = joined.filter(~F.col("is_fraud").eqNullSafe(F.col("_label"))).select(*_DAY).distinct().collect()
    return sorted(date(r["year"], r["month"], r["day"]) for r in found)


def relabel(txns: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions with the label of ``labels`` where it has one, which may be NULL, and their own otherwise."""
    new = labels.select("transaction_id", F.struct("is_fraud").alias("_label"))
    label = F.when(F.col("_label").isNotNull(), F.col("_label.is_fraud")).otherwise(F.col("is_fraud"))
    return txns.join(new, "transaction_id", "left").withColumn("is_fraud", label).select(*txns.columns)


def stage_labels(spark: SparkSession, lake: Lake, raw_labels: DataFrame) -> list[date]:
    """Bring labels as they arrive into the staged transactions; returns the days that were written."""
    labels = materialize(cleaning.clean_labels(raw_labels), "labels")
    try:
        txns = read_table(spark, lake.staging("transactions"))
        days = days_touched(txns, labels)
        if days:
            changed = materialize(relabel(on_days(txns, days), labels), "relabelled")
            overwrite_days(changed, lake.staging("transactions"), days, sort_by=["user_id"])
            drop_table(changed)
        return days
    finally:
        drop_table(labels)


def run_labels(spark: SparkSession, lake: Lake, raw_labels: DataFrame) -> dict:
    """Late labels through all layers. Features count no labels, so no day after the touched ones changes."""
    with scratch_run(spark):
        days = stage_labels(spark, lake, raw_labels)
        if not days:
            return {"days": []}
        return {
            "days": [d.isoformat() for d in days],
            "features": warehouse.build_features_days(spark, lake, days),
            "marts": warehouse.build_marts_days(spark, lake, days),
        }
