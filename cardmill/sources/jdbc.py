"""Relational sources over JDBC, read in ranges of a text key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

RANGE_COLUMN = "range_key"


@dataclass(frozen=True)
class JdbcSource:
    """One database. ``url``, ``driver`` and credentials come from the deployment."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 10_000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        named = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        given = {k: v for k, v in named.items() if v is not None}
        return {**given, "fetchsize": str(self.fetch_size), **self.extra}

    @staticmethod
    def _numeric(key: str) -> str:
        """The same expression gives the bounds and the ranges."""
        return f"CAST({key} AS BIGINT)"

    def bounds_query(self, table: str, key: str) -> str:
        number = self._numeric(key)
        return f"(SELECT MIN({number}) AS low, MAX({number}) AS high FROM {table}) bounds"

    def ranged_query(self, table: str, key: str) -> str:
        return f"(SELECT t.*, {self._numeric('t.' + key)} AS {RANGE_COLUMN} FROM {table} t) ranged"

    def bounds(self, spark: SparkSession, table: str, key: str) -> tuple[int, int]:
        row = spark.read.format("jdbc").options(**self.options(), dbtable=self.bounds_query(table, key)).load().first()
        low, high = (row[0], row[1]) if row else (None, None)
        return int(low if low is not None else 0), int(high if high is not None else 1)

    def range_options(self, table: str, key: str, partitions: int, low: int, high: int) -> dict[str, str]:
        return {
            **self.options(),
            "dbtable": self.ranged_query(table, key),
            "partitionColumn": RANGE_COLUMN,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }

    def read(self, spark: SparkSession, table: str, key: str | None = None, partitions: int = 1) -> DataFrame:
        """Whole table; with a key, ``partitions`` connections read one range each."""
        if key is None or partitions <= 1:
            return spark.read.format("jdbc").options(**self.options(), dbtable=table).load()
        low, high = self.bounds(spark, table, key)
        ranged = spark.read.format("jdbc").options(**self.range_options(table, key, partitions, low, high)).load()
        # Databases fold unquoted names, so match the helper column without case.
        return ranged.drop(*[c for c in ranged.columns if c.lower() == RANGE_COLUMN])
