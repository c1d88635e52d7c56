"""Data-quality checks. Each returns rows ``check, failures, total, passed``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Smallest accepted share of labelled transactions.
MIN_LABEL_COVERAGE = 0.80

# Columns of staged transactions that are never NULL, and the values a column may have.
NEVER_NULL = ("transaction_id", "user_id", "amount_format", "is_valid")
ACCEPTED = {"amount_format": ("US", "EU", "CLEAN", "VN", "AMBIGUOUS", "INVALID")}


class QualityError(RuntimeError):
    """At least one check failed."""


def column_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Row count, not-null and accepted-values checks in one pass over the table."""
    failures: dict[str, Column] = {f"not_null.{c}": F.col(c).isNull() for c in not_null}
    failures |= {f"accepted_values.{c}": ~F.col(c).isin(*v) for c, v in (accepted or {}).items()}
    names = list(failures)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count(F.when(failures[n], 1)).alias(f"f{i}") for i, n in enumerate(names)),
    )
    empty = F.struct(
        F.lit(f"{prefix}has_rows").alias("check"), F.when(F.col("total") > 0, 0).otherwise(1).cast("bigint").alias("failures")
    )
    rows = [empty] + [
        F.struct(F.lit(prefix + n).alias("check"), F.col(f"f{i}").alias("failures")) for i, n in enumerate(names)
    ]
    report = counted.select(F.explode(F.array(*rows)).alias("r"), "total")
    return report.select("r.check", "r.failures", "total", (F.col("r.failures") == 0).alias("passed"))


def unique_check(df: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """Number of keys that occur more than once."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counted = sizes.agg(
        F.count(F.when(F.col("n") > 1, 1)).alias("failures"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    return counted.select(
        F.lit(f"{prefix}unique.{key}").alias("check"), "failures", "total", (F.col("failures") == 0).alias("passed")
    )


def table_checks(
    df: DataFrame,
    key: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``column_checks`` and ``unique_check`` together: failures are counted per key first, so the table is read once."""
    failing: dict[str, Column] = {f"not_null.{c}": F.col(c).isNull() for c in not_null}
    failing |= {f"accepted_values.{c}": ~F.col(c).isin(*v) for c, v in (accepted or {}).items()}
    names = list(failing)
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(failing[n]).alias(f"f{i}") for i, n in enumerate(names))
    )
    known = F.col(key).isNotNull()
    total = F.coalesce(F.sum("n"), F.lit(0))
    counted = per_key.agg(
        total.alias("all"),
        F.count_if(known & (F.col("n") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("keyed"),
        *(F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(names))),
    )
    found = [("has_rows", F.when(F.col("all") > 0, 0).otherwise(1).cast("bigint"), "all")]
    found += [(name, F.col(f"f{i}"), "all") for i, name in enumerate(names)]
    found += [(f"unique.{key}", F.col("repeated"), "keyed")]
    rows = [F.struct(F.lit(prefix + n).alias("check"), f.alias("failures"), F.col(t).alias("total")) for n, f, t in found]
    report = counted.select(F.inline(F.array(*rows)))
    return report.withColumn("passed", F.col("failures") == 0)


def _failing(not_null: Sequence[str], accepted: Mapping[str, Sequence[str]] | None) -> dict[str, Column]:
    failing: dict[str, Column] = {f"not_null.{c}": F.col(c).isNull() for c in not_null}
    return failing | {f"accepted_values.{c}": ~F.col(c).isin(*v) for c, v in (accepted or {}).items()}


def day_counts(
    df: DataFrame, key: str, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows, keyed rows and failures of every column check for each day: counts that add up over days."""
    failing = _failing(not_null, accepted)
    return df.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(key).alias("keyed"),
        F.map_from_arrays(
            F.array(*map(F.lit, failing)), F.array(*(F.count(F.when(condition, 1)) for condition in failing.values()))
        ).alias("failures"),
    )


def repeated_keys(df: DataFrame, key: str, candidates: DataFrame) -> DataFrame:
    """The candidates that occur on more than one row; of ``df`` only the key column is read, and only candidates are grouped."""
    wanted = candidates.select(key).filter(F.col(key).isNotNull()).distinct()
    counted = df.select(key).join(wanted, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1").select(key)


def checks_of_days(counts: DataFrame, repeated: DataFrame, key: str, checks: Sequence[str], prefix: str = "") -> DataFrame:
    """The report of ``table_checks`` from the counts of all days and the keys that are repeated."""
    total = counts.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("keyed"), F.lit(0)).alias("keyed"),
        *(F.coalesce(F.sum(F.col("failures")[name]), F.lit(0)).alias(f"f{i}") for i, name in enumerate(checks)),
    )
    rows = [("has_rows", F.when(F.col("total") > 0, 0).otherwise(1).cast("bigint"), "total")]
    rows += [(name, F.col(f"f{i}"), "total") for i, name in enumerate(checks)]
    rows += [(f"unique.{key}", F.lit(repeated.select(F.count(F.lit(1))).scalar()), "keyed")]
    structs = [F.struct(F.lit(prefix + n).alias("check"), f.alias("failures"), F.col(t).alias("total")) for n, f, t in rows]
    return total.select(F.inline(F.array(*structs))).withColumn("passed", F.col("failures") == 0)


def null_rows(df: DataFrame, key: str) -> DataFrame:
    """The offending rows themselves: none means the check passes."""
    return df.filter(F.col(key).isNull()).select(key)


def label_coverage(facts: DataFrame, year: int, minimum: float = MIN_LABEL_COVERAGE) -> DataFrame:
    """Share of a year's transactions that have a label. No rows, or no labels, fails."""
    counted = facts.filter(F.col("year") == year).agg(
        F.count(F.lit(1)).alias("total"), F.count("is_fraud").alias("labeled")
    )
    ratio = F.coalesce(F.try_divide(F.col("labeled").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    return counted.withColumn("passed", ratio >= minimum)


def raw_checks(transactions: DataFrame, mcc_codes: DataFrame) -> DataFrame:
    """Gate after ingest: a day has rows and no missing ids; the code table is not empty."""
    return column_checks(transactions, ["id"], prefix="transactions.").unionByName(
        column_checks(mcc_codes, prefix="mcc_codes.")
    )


def staging_checks(transactions: DataFrame, users: DataFrame, cards: DataFrame) -> DataFrame:
    return union_reports(
        table_checks(transactions, "transaction_id", NEVER_NULL, ACCEPTED, "transactions."), dimension_checks(users, cards)
    )


def dimension_checks(users: DataFrame, cards: DataFrame) -> DataFrame:
    return union_reports(
        table_checks(users, "user_id", ["user_id"], prefix="users."), table_checks(cards, "card_id", ["card_id"], prefix="cards.")
    )


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def gate(report: DataFrame) -> None:
    """Raise when a check of the report failed. The report has one row per check."""
    failed = [row["check"] for row in report.filter("NOT passed").collect()]
    if failed:
        raise QualityError("failed checks: " + ", ".join(sorted(failed)))


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per event day and reason, with the number still open."""
    return quarantine.groupBy("year", "month", "day", "quarantine_reason").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(~F.col("is_resolved"), 1)).alias("open_rows")
    )


def has_quarantine(quarantine: DataFrame) -> bool:
    return not quarantine.isEmpty()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_reports(*counts)
