"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact confirmation.

A document's set holds its distinct five-word shingles (a shorter text gives one shingle, an empty or null text none).
Documents with equal sets form a class; classes are compared, so that copies cost one row each.

1. Signatures of ``rows * bands`` minima; ``bands`` is chosen so that a pair at the threshold meets in no band with at
   most probability ``miss``.
2. Each bucket compares its members with one hub, the member with the most company over all buckets. That is linear in
   the members, and joins the copies of one original to it. Members that end up in different components although they
   share a bucket are then compared pair by pair, block against block inside the tasks, so no link between components
   is lost; only pairs that pass step 3 leave a task.
3. A candidate pair is compared signature batch by signature batch; it is dropped as soon as the posterior probability
   (uniform prior) that its similarity reaches the threshold is below ``miss`` (Satuluri and Parthasarathy, 2012).
4. Every survivor is confirmed on the full shingle sets.

Defined cases: rows with a null key are never linked and are kept; their component is null. Rows with the same key are
one node, linked by any of its texts. Empty tables give empty results. Only the key and the text are read, so other
columns may have any names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm import text as tx
from cardmill.llm.components import stored_components
from cardmill.llm.tables import read, ready
from cardmill.session import materialize

WORDS = 5
ROWS = 7
MISS = 1e-6
BATCH = 28  # signature values compared at a time
VALUES = 504  # signature values of 8 bits kept for comparison; the bands use the first ones in full
BLOCK = 1024  # members of a bucket compared at a time


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def least_matches(threshold: float, total: int, batch: int = BATCH, miss: float = MISS) -> dict[int, int]:
    """For each number of compared values, the fewest matches with P(similarity >= threshold | matches) >= miss."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    chance = grid + (1 - grid) / 256  # of equal values, which have 8 bits
    out = {}
    for n in [*range(batch, total, batch), total]:
        low, high = 0, n
        while low < high:
            m = (low + high) // 2
            log = m * np.log(chance) + (n - m) * np.log1p(-chance)
            density = np.exp(log - log.max())
            if density[grid >= threshold].sum() / density.sum() >= miss:
                high = m
            else:
                low = m + 1
        out[n] = low
    return out


def _minima(values: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """MinHash signature (count 32-bit minima) of each run of distinct shingles."""
    seeds = tx.mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    factor, shift = (seeds[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), seeds[count:].astype(np.uint32)
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((count, len(starts)), dtype=np.uint32)
    for a in range(0, count, 16):
        table = x[None, :] * factor[a : a + 16, None]
        table += shift[a : a + 16, None]
        out[a : a + 16] = np.minimum.reduceat(table, starts, axis=1)
    return out.T


def describe(docs: DataFrame, key: str, text_column: str, rows: int, bands: int) -> DataFrame:
    """key, n_shingles, 128-bit hash of the shingle set, band keys, signature (8 bits a value)."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                n = b - a
                values, owners = tx.distinct(*tx.shingles(*tx.words(data, offsets)[:2], WORDS))
                sizes = np.bincount(owners, minlength=n).astype(np.int64)
                full = np.flatnonzero(sizes)
                high, low = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                keys, signatures = [None] * n, [None] * n
                if len(full):
                    starts = (np.cumsum(sizes) - sizes)[full]
                    high[full] = np.add.reduceat(tx.mix(values), starts)
                    low[full] = np.add.reduceat(tx.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                    minima = _minima(values, starts, max(rows * bands, VALUES))
                    banded = np.zeros((len(full), bands), dtype=np.uint64)
                    for r in range(rows):
                        banded = tx.mix(banded * np.uint64(31) + minima[:, r : rows * bands : rows])
                    banded = tx.mix(banded + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                    short = (minima[:, :VALUES] >> np.uint32(11)).astype(np.uint8)
                    for i, row in enumerate(full):
                        keys[row], signatures[row] = banded[i], short[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, n), pa.array(sizes), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)),
                        pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary()),
                    ],
                    ["id", "n", "high", "low", "bands", "signature"],
                )

    plain = docs.select(F.col(key).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(run, "id long, n long, high long, low long, bands array<long>, signature binary")


def sets(docs: DataFrame, key: str, text_column: str) -> DataFrame:
    """key and sorted distinct shingles."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                values, owners = tx.distinct(*tx.shingles(*tx.words(data, offsets)[:2], WORDS))
                ends = np.searchsorted(owners, np.arange(b - a + 1))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column], ["id", "shingles"])

    plain = docs.select(F.col(key).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(run, "id long, shingles array<long>")


def _passing(left: np.ndarray, right: np.ndarray, needed: dict[int, int], at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Which of the pairs (left[at], right[to]) pass the sequential test."""
    alive, matches, seen = np.arange(len(at)), np.zeros(len(at), dtype=np.int64), 0
    for upto, least in needed.items():
        matches = matches + (left[at[alive], seen:upto] == right[to[alive], seen:upto]).sum(axis=1)
        keep = matches >= least
        alive, matches, seen = alive[keep], matches[keep], upto
    return alive


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), VALUES)


def across_components(rest: DataFrame, close: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components in the same bucket that pass the sequential test.

    ``rest`` has bucket, id, component, size. A large bucket is cut into blocks, and each pair of blocks is a group of
    its own, so no task holds more than two blocks of one bucket. A pair that shares several buckets leaves from the
    first of them only.
    """
    needed = least_matches(threshold, VALUES)
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = rest.withColumn("own", F.pmod(F.xxhash64("id"), count).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    placed = placed.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
    rows = placed.join(close, "id").select("bucket", "x", "y", "own", "id", "component", "signature", "bands")
    rows = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def run(batches):
        for _, table in tx.groups(batches, 3):
            own, ids, component = (table.column(i).to_numpy() for i in (3, 4, 5))
            x, y = table.column(1)[0].as_py(), table.column(2)[0].as_py()
            signatures = _signatures(table.column(6))
            bands = table.column(7).combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
            for a in range(0, len(left), 64):
                p, q = np.repeat(left[a : a + 64], len(right)), np.tile(right, len(left[a : a + 64]))
                apart = (component[p] != component[q]) & ((ids[p] < ids[q]) | (x != y))
                p, q = p[apart], q[apart]
                found = _passing(signatures, signatures, needed, p, q)
                equal = bands[p[found]] == bands[q[found]]
                found = found[bands[p[found], equal.argmax(axis=1)] == table.column(0)[0].as_py()]
                low, high = np.minimum(ids[p[found]], ids[q[found]]), np.maximum(ids[p[found]], ids[q[found]])
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").filter("a < b").distinct()


def passing(pairs: DataFrame, close: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that pass the sequential test."""
    needed = least_matches(threshold, VALUES)

    def prune(batches):
        for batch in batches:
            every = np.arange(batch.num_rows)
            if len(every):
                alive = _passing(_signatures(batch.column(2)), _signatures(batch.column(3)), needed, every, every)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).take(pa.array(alive))

    signature = close.select("id", "signature")
    candidates = pairs.join(signature.toDF("a", "x"), "a").join(signature.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return candidates.mapInArrow(prune, "a long, b long").distinct()


def confirmed(survivors: DataFrame, docs: DataFrame, key: str, text_column: str, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold on full sets."""
    survivors = materialize(survivors, "survivors")
    members = survivors.select("a").union(survivors.select("b")).distinct().toDF("__id")
    wanted = docs.join(members, F.col(key).cast("long") == F.col("__id"), "left_semi")
    full = materialize(sets(wanted, key, text_column), "shingle-sets")
    both = survivors.join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b")
    both = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("i"), F.size("x").alias("p"), F.size("y").alias("q"))
    return materialize(both.filter(f"100 * i >= {round(100 * threshold)} * (p + q - i)").select("a", "b").distinct(), "links")


def near_duplicates(docs: DataFrame, threshold: float, key="doc_id", text_column="text", rows=ROWS, miss=MISS) -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest linked key), kept."""
    docs = docs.select(key, text_column)
    bands = bands_for(threshold, rows, miss)
    described = materialize(describe(docs, key, text_column, rows, bands), "signatures")
    known = described.filter("n > 0 and id is not null")
    classes = known.groupBy("high", "low", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copies = materialize(classes.filter("copies > 1").drop("copies"), "copies")
    others = known.join(copies.select("high", "low", "n", F.col("rep").alias("id")), ["high", "low", "n"], "left_anti")
    reps = others.select("id", "bands").union(known.join(copies, ["high", "low", "n"]).filter("id = rep").select("id", "bands"))
    members = reps.select("id", F.explode("bands").alias("bucket")).distinct()
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(members.join(shared, "bucket"), "buckets")

    # The signatures of documents that share a bucket, moved once; all later joins are with these few.
    close = known.select("id", "signature", "bands").join(members.select("id").distinct(), "id", "left_semi")
    close = materialize(close.dropDuplicates(["id", "signature"]), "close")

    company = members.groupBy("id").agg(F.sum("size").alias("company"))
    hubs = members.join(company, "id").groupBy("bucket").agg(F.max(F.struct("company", -F.col("id"))).alias("hub"))
    hubs = hubs.select("bucket", (-F.col("hub.col2")).alias("hub"))
    pair = F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    stars = materialize(members.join(hubs, "bucket").filter("id <> hub").select(*pair).distinct(), "stars")
    links = confirmed(passing(stars, close, threshold), docs, key, text_column, threshold)

    placed = members.join(stored_components(links).toDF("id", "component"), "id", "left").select("bucket", "size", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p < q").select("bucket")
    rest = materialize(placed.join(mixed, "bucket"), "mixed-buckets")
    across = across_components(rest, close, threshold).join(stars, ["a", "b"], "left_anti")
    links = links.union(confirmed(across, docs, key, text_column, threshold))

    found = stored_components(links).toDF("rep", "component")
    rows_ = described.select("id", "n", "high", "low").join(copies, ["high", "low", "n"], "left")
    rows_ = rows_.select("id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "id")).otherwise(F.col("id")).alias("rep"))
    out = rows_.join(found, "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def op7_minhash(spark, folder: str) -> DataFrame:
    ready(spark)
    return near_duplicates(read(spark, folder, "documents"), 0.85)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), shingle AS (
  SELECT doc_id, unnest(s) AS x FROM sets
), pairs AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM shingle p JOIN shingle q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b WHERE 100 * i >= 85 * (len(p.s) + len(q.s) - i)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), smallest AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM sets LEFT JOIN smallest ON a = doc_id
"""
