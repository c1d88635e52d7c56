"""A document pipeline: bad quality out, repeated lines out, near copies out, benchmark leaks out, then pieces.

Each stage reads what its predecessor wrote. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.llm import decontaminate, lines, minhash, pieces, quality
from cardmill.llm.tables import fresh, read, ready
from cardmill.session import materialize


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a stored key of its own for every row, as ``doc_id`` may be null or repeated; and the name of that key."""
    row = fresh(docs, "__row")
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def _without(rows: DataFrame, found: DataFrame, row: str) -> DataFrame:
    return rows.join(found.select(row).distinct(), row, "left_anti").drop(row)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ready(spark)
    added = fresh(docs, "__score"), fresh(docs, "__predicted")
    return quality.classify(docs, read(spark, sf_dir, "labels"), added=added).filter(F.col(added[1]) == 1).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; those that lose all their lines go."""
    ready(spark)
    counts = tuple(fresh(docs, c) for c in ("__lines", "__removed", "__runs_removed"))
    total, removed = F.col(counts[0]), F.col(counts[1])
    found = lines.remove_repeated_lines(docs, names=counts).filter((removed == 0) | (removed < total))
    length = F.when(removed > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (similarity 0.8 or more), the one with the smallest id; null ids come last.

    Rows are compared whatever their ids are. Texts without words are near to nothing, but of rows that agree in id and
    such a text one stays.
    """
    ready(spark)
    rows, row = _keyed(docs)
    found = minhash.near_duplicates(rows, 0.8, key=row)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), row)
    members = found.join(rows.select(row, "doc_id", F.md5("text").alias("text_md5"), order.alias("order")), row)
    wordless = F.col("n_shingles") == 0
    same = F.when(wordless, F.struct("doc_id", "text_md5"))
    alone = F.when(~wordless | F.col("doc_id").isNull(), F.col("component_id"))  # its own key, if it has no words
    kept = members.groupBy(alone.alias("group"), same.alias("same")).agg(F.min("order").alias("first")).select(F.col(f"first.{row}").alias(row))
    return _without(rows, rows.select(row).join(kept, row, "left_anti"), row)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ready(spark)
    rows, row = _keyed(docs)
    return _without(rows, decontaminate.leaks(rows, read(spark, sf_dir, "benchmark"), key=row), row)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of a sampled segmentation of each text, and whether they decode to it."""
    ready(spark)
    model = pieces.model_bytes(spark)
    found = pieces.encode_and_decode(docs, model)
    lossless = F.col("decoded").eqNullSafe(F.col("text")).alias("lossless")
    return found.select("doc_id", "lang", "source", "n_chars", F.size("pieces").alias("n_pieces"), "pieces", lossless)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece", to_pieces),
]

#: Classifier votes, MinHash candidates and sampled pieces cannot be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
