"""Hard negatives by slot-decomposed selection.

An anchor's positives set windows on the scores of its negatives: from ``low`` to ``high`` per cent of each positive's
score. The windows overlap, but their upper limits alone cut the scores into disjoint slots, at most one for each
positive.

* Anchors are a stated query set and meet all rows in blocks: rows and anchors are dealt into blocks of bounded size,
  and each pair of blocks is one group, whose scores are one matrix product. Of a group only the best rows leave.
* First pass: the best rows of the anchor's own label are its positives.
* Second pass: every group keeps the best rows of other labels for each anchor and slot; scores above all slots or
  below every window are left out. The groups' rows are combined by slot, again keeping the best.
* A window reaches from its own slot downwards, so its best rows are the best of that slot and all lower ones: the slots
  are merged from the lowest up, each suffix keeping its best rows. The lower limit then cuts the end of the list.

Components become floor(scale * x) in double precision and scores are their exact integer products: in doubles while no
product can leave their range, else in Python's integers, and then held within 64 bits. A shorter vector counts as one
with zeros at its end.

Rows with a null label, a null vector, or a null or non-finite component take no part. Equal scores are ordered by key,
null keys last. Rows with equal keys are rows of their own, and each may be an anchor, a positive of its namesake or a
negative. A positive with a negative score has an empty window. Empty tables, and tables without anchors, give nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardmill.llm.tables import read, ready
from cardmill.session import materialize

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SCALE = 256
ROW_VALUES, ANCHOR_VALUES = 1 << 19, 1 << 18  # vector components of one block
AT_ONCE = 256  # anchors of one matrix product


def _matrix(column, width: int, scale: float) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a with all rows of b."""
    largest = [np.abs(x).max(initial=0.0) for x in (a, b)]
    if a.shape[1] * largest[0] * largest[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape) for x in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The k best of ``places``, which are in the order that breaks ties."""
    found = scores[places]
    if len(found) > k:
        places = places[found >= np.partition(found, len(found) - k)[len(found) - k]]
        found = scores[places]
    return places[np.argsort(-found, kind="stable")[:k]]


def _ordered(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_end"))


def _codes(*columns) -> list[np.ndarray]:
    both = pa.chunked_array([c for column in columns for c in column.chunks], type=columns[0].type).combine_chunks()
    codes = both.dictionary_encode().indices.to_numpy()
    cuts = np.cumsum([len(c) for c in columns])[:-1]
    return np.split(codes, cuts)


def _blocks(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Rows and anchors grouped by pairs of blocks."""

    def numbered(count: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = rows.select(numbered(row_blocks).alias("rb"), every(anchor_blocks).alias("ab"), *rows.columns)
    named = [F.col(c).alias(f"anchor_{c}") for c in anchors.columns]  # names of their own: both sides come from one table
    right = anchors.select(every(row_blocks).alias("rb"), numbered(anchor_blocks).alias("ab"), *named)
    return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab"))


def _ranked(df: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def _hundredth(percent: int, up: bool) -> Column:
    """``percent`` hundredths of the score as a whole number, rounded down or up."""
    exact = F.col("score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
    row_values: int = ROW_VALUES,
    anchor_values: int = ANCHOR_VALUES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    named = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), odd.alias("odd"))
    valid = named.filter("label IS NOT NULL AND vec IS NOT NULL AND NOT odd").drop("odd")
    stored = materialize(valid.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = stored.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("vec")).alias("width")).first()
    width = max(sizes.width or 1, 1)
    row_blocks = max(1, math.ceil(sizes.rows * width / row_values))
    anchor_blocks = max(1, math.ceil(sizes.anchors * width / anchor_values))
    candidates, anchors = stored.drop("anchor"), stored.filter("anchor").drop("anchor")

    def scored(left: pa.Table, right: pa.Table, own_label: bool):
        """(anchor's place, scores against all rows, rows with or without its label) for every anchor of a group."""
        ids, labels = left["row"].to_numpy(), _codes(right["anchor_label"], left["label"])
        r = _matrix(left["vec"], width, scale)
        for at in range(0, right.num_rows, AT_ONCE):
            part = right.slice(at, AT_ONCE)
            scores = _products(_matrix(part["anchor_vec"], width, scale), r)
            rows = part["anchor_row"].to_numpy()
            for i in range(part.num_rows):
                fits = labels[1] == labels[0][at + i]
                yield at + i, scores[i], fits & (ids != rows[i]) if own_label else ~fits

    def table(right: pa.Table, left: pa.Table, anchor: list, slot: list, place: list, score: list) -> pa.Table:
        def joined(parts, kind):
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        counts = [len(p) for p in place]
        return pa.table(
            {
                "anchor": right["anchor_row"].take(pa.array(np.repeat(np.array(anchor, np.int64), counts))),
                "slot": pa.array(np.repeat(np.array(slot, np.int32), counts), pa.int32()),
                "score": pa.array(joined(score, np.int64), pa.int64()),
                "id": left["id"].take(pa.array(joined(place, np.int64), pa.int64())),
            }
        )

    def own(left: pa.Table, right: pa.Table) -> pa.Table:
        left, found = _ordered(left), ([], [], [], [])
        for i, scores, fits in scored(left, right, True):
            best = _best(scores, np.flatnonzero(fits), positives)
            for part, value in zip(found, (i, 0, best, scores[best])):
                part.append(value)
        return table(right, left, *found)

    def others(left: pa.Table, right: pa.Table) -> pa.Table:
        left, found = _ordered(left), ([], [], [], [])
        limits, floors = right["anchor_limits"].to_pylist(), right["anchor_lowest"].to_pylist()
        for i, scores, fits in scored(left, right, False):
            fits = np.flatnonzero(fits & (scores >= floors[i]) & (scores <= limits[i][0]))
            # Slot 0 lies between the first and the second limit, and so on down.
            slots = np.searchsorted(-np.array(limits[i]), -scores[fits], side="right") - 1
            for slot in np.unique(slots):
                best = _best(scores, fits[slots == slot], negatives)
                for part, value in zip(found, (i, slot, best, scores[best])):
                    part.append(value)
        return table(right, left, *found)

    kept = f"anchor long, slot int, score long, id {dict(stored.dtypes)['id']}"
    near = _blocks(candidates, anchors, row_blocks, anchor_blocks).applyInArrow(own, kept)
    near = _ranked(near, ["anchor"], positives, "nth").withColumns({"upper": _hundredth(high, False), "lower": _hundredth(low, True)})
    place = Window.partitionBy("anchor").orderBy(F.col("upper").desc())
    near = materialize(near.withColumn("slot", F.dense_rank().over(place) - 1), "positives")

    limits = near.groupBy("anchor").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("lowest"))
    asked = anchors.join(limits.withColumnRenamed("anchor", "row"), "row")
    far = _blocks(candidates, asked, row_blocks, anchor_blocks).applyInArrow(others, kept)
    by_slot = _ranked(far, ["anchor", "slot"], negatives, "nth").drop("nth")
    suffixes = by_slot.withColumn("slot", F.explode(F.sequence(F.lit(0), "slot")))
    merged = _ranked(suffixes, ["anchor", "slot"], negatives, "rank")
    windows = near.select("anchor", "slot", "lower", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        merged.join(windows, ["anchor", "slot"])
        .filter(F.col("score") >= F.col("lower"))
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def op11_negatives(spark, folder: str) -> DataFrame:
    ready(spark)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, folder, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS other, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id) <= 10
"""
