"""Collects the queries: a Spark function and, where SQL can say it, the SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardmill.queries import oracle
from cardmill.session import tune


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register the decorated function under its own name."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(tune(spark), folder)

        name = function.__name__
        _QUERIES[name] = Query(name, run, None if sql is None else oracle.query(sql))
        return function

    return register


def all_queries() -> dict[str, Query]:
    from cardmill.queries import (  # noqa: F401  (registering imports)
        cleaning,
        features,
        quality,
        storage,
        warehouse,
    )

    return dict(_QUERIES)
