"""Checks of a table by days as stored state: counts for each day, and the keys that are repeated.

A run counts the days that changed. Their keys, and keys known to be repeated, are looked up in the key column of the
table; nothing else of other days is read and no other key is grouped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardmill import files
from cardmill.operators import quality
from cardmill.operators.features import on_days
from cardmill.plans.layout import Lake
from cardmill.schemas import STAGING
from cardmill.session import materialize
from cardmill.sinks import overwrite_days, replace_table
from cardmill.sources import read_table

DAY = ("year", "month", "day")
COUNTS = "total bigint, keyed bigint, failures map<string,bigint>, year int, month int, day int"


@dataclass(frozen=True)
class DayChecks:
    """What is checked of a table by days, and the folder of its state."""

    table: str
    state: str
    key: str
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    prefix: str = ""
    schema: StructType | str | None = None  # of the table, for when it has no rows

    @property
    def checks(self) -> list[str]:
        return [*(f"not_null.{c}" for c in self.not_null), *(f"accepted_values.{c}" for c in self.accepted)]

    def _paths(self) -> tuple[str, str]:
        return f"{self.state}/counts", f"{self.state}/repeated"

    def build(self, spark: SparkSession) -> None:
        """The state from the whole table."""
        counts, repeated = self._paths()
        table = read_table(spark, self.table, self.schema)
        replace_table(quality.day_counts(table, self.key, self.not_null, self.accepted), counts, partition_by=DAY)
        replace_table(quality.repeated_keys(table, self.key, table), repeated)

    def refresh(self, spark: SparkSession, days: Sequence[date]) -> None:
        """The state after some days have changed."""
        counts, repeated = self._paths()
        if not (files.exists(spark, counts) and files.exists(spark, repeated)):
            return self.build(spark)
        table = read_table(spark, self.table, self.schema)
        changed = on_days(table, days)
        overwrite_days(quality.day_counts(changed, self.key, self.not_null, self.accepted), counts, days)
        candidates = changed.select(self.key).unionByName(read_table(spark, repeated, f"{self.key} string"))
        replace_table(materialize(quality.repeated_keys(table, self.key, candidates), "repeated"), repeated)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row for each check, from the state alone."""
        counts, repeated = self._paths()
        return quality.checks_of_days(read_table(spark, counts, COUNTS), read_table(spark, repeated, f"{self.key} string"), self.key, self.checks, self.prefix)


def transactions(lake: Lake) -> DayChecks:
    """The checks of staged transactions."""
    return DayChecks(
        lake.staging("transactions"),
        lake.warehouse("checks/transactions"),
        "transaction_id",
        quality.NEVER_NULL,
        quality.ACCEPTED,
        "transactions.",
        STAGING["transactions"],
    )
