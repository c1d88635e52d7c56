"""Quality classifier: votes of nearest labelled documents in a latent-semantic space.

Terms describe the form of a text, not its words: hashed four-grams of character classes, and how often words repeat.
Term frequencies are damped, weighted by inverse document frequency over *all* documents, and projected on the leading
singular vectors of a bounded sample of labelled rows. The labelled vectors are broadcast (their number is bounded by
``sample``, 32 floats each); every document is compared with all of them by blocked matrix products, and its nearest
neighbours vote with their cosine as weight.

Null and empty texts have no terms: their vector is zero, and they score the share of label 1 in the sample. Rows with
the same ``doc_id`` are scored each for itself. Labels that are null, or belong to no document, are not learned from;
without any label the score is 0.5. Columns other than the key and the text are kept as they are, except that one with
the name of an added column is replaced. Ties among neighbours are broken by their place in the sample, which is sorted by hash and key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm import text as tx
from cardmill.llm.tables import held_out, read, ready

SHAPE_BUCKETS = 1024
RATIOS = 3
STEPS = 16
TERMS = SHAPE_BUCKETS + RATIOS * STEPS
SAMPLE = 4000  # labelled rows that are learned from, at most
DIMENSIONS = 32
NEIGHBOURS = 15
RATIO_WEIGHT = 8.0


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    table[ord("a") : ord("z") + 1] = 1
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    table[128:] = 1
    return table


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Damped term frequencies, one row for each text."""
    n = len(offsets) - 1
    counts = np.zeros((n, TERMS), dtype=np.float32)
    if len(data) >= 4:
        c = _classes()[data]
        code = tx.mix(c[:-3] + (c[1:-2] << np.uint64(8)) + (c[2:-1] << np.uint64(16)) + (c[3:] << np.uint64(24)))
        row = np.repeat(np.arange(n), np.diff(offsets))
        whole = row[3:] == row[:-3]
        at = row[:-3][whole] * SHAPE_BUCKETS + (code[whole] >> np.uint64(54)).astype(np.int64)
        shapes = np.bincount(at, minlength=n * SHAPE_BUCKETS).reshape(n, SHAPE_BUCKETS)
        counts[:, :SHAPE_BUCKETS] = np.log1p(shapes)
    hashes, rows, _, _ = tx.words(data, offsets)
    if len(hashes):
        total = np.maximum(np.bincount(rows, minlength=n), 1)
        repeats = np.bincount(rows[1:], weights=(hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1]), minlength=n)
        _, owners = tx.distinct(hashes, rows)
        kinds = np.bincount(owners, minlength=n)
        size = np.log2(total) / STEPS
        has = np.bincount(rows, minlength=n) > 0
        for i, ratio in enumerate((repeats / total, kinds / total, size)):
            step = np.minimum((ratio * STEPS).astype(np.int64), STEPS - 1)
            counts[np.flatnonzero(has), SHAPE_BUCKETS + i * STEPS + step[has]] = RATIO_WEIGHT
    return counts


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame, text_column: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each term occurs (over all of them), and how many documents there are."""

    def count(batches):
        total, n = np.zeros(TERMS, dtype=np.int64), 0
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                total += (term_counts(data, offsets) > 0).sum(axis=0)
                n += b - a
        yield pa.RecordBatch.from_pydict({"term": np.arange(TERMS + 1), "n": np.r_[total, n]})

    found = (
        docs.select(F.col(text_column).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    )  # one row for each term
    counts = np.zeros(TERMS + 1, dtype=np.int64)
    for row in found:
        counts[row.term] = row.n
    return counts[:TERMS], int(counts[TERMS])


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text_column: str, label: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled rows outside the held-out fold, in an order set by a hash of the key."""
    known = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    known = known.filter(~held_out(F.col("__key"))).groupBy("__key").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("__key"), "__key").limit(sample)
    rows = docs.select(F.col(key).alias("__key"), F.col(text_column).alias("text"))
    return rows.join(F.broadcast(chosen), "__key")  # at most ``sample`` pairs of numbers


def train(docs: DataFrame, labels: DataFrame, key="doc_id", text_column="text", label="quality", sample=SAMPLE) -> dict:
    """The model: term weights, projection, vectors and labels of the sample. All of it is bounded by ``sample``."""
    frequency, n = document_frequencies(docs, text_column)
    weights = np.log((1.0 + n) / (1.0 + frequency)) + 1.0

    def describe(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                rows = term_counts(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([r.tobytes() for r in rows])], ["key", "label", "terms"]
                )

    chosen = labelled_sample(docs, labels, key, text_column, label, sample).withColumn("__key", F.col("__key").cast("string"))
    found = chosen.select("__key", "text", "label").mapInArrow(describe, "key string, label int, terms binary").orderBy("key", "terms").limit(sample).collect()
    if not found:
        return {"weights": weights, "projection": np.zeros((TERMS, 1)), "vectors": np.zeros((0, 1)), "labels": np.zeros(0), "prior": 0.5}
    x = _unit(np.stack([np.frombuffer(r.terms, dtype=np.float16) for r in found]).astype(np.float64) * weights)
    y = np.array([r.label for r in found], dtype=np.float64)
    _, vectors = np.linalg.eigh(x.T @ x)
    projection = np.ascontiguousarray(vectors[:, ::-1][:, : min(DIMENSIONS, len(found))])
    return {
        "weights": weights.astype(np.float32), "projection": projection.astype(np.float32), "vectors": _unit(x @ projection).astype(np.float32),
        "labels": y, "prior": float(y.mean()),
    }


def vote(model: dict, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Score of each row of term counts."""
    score = np.full(len(counts), model["prior"])
    if not len(model["labels"]) or not len(counts):
        return score
    latent = _unit(_unit(counts * model["weights"]) @ model["projection"])
    k = min(neighbours, len(model["labels"]))
    for a in range(0, len(latent), 256):
        cosine = latent[a : a + 256] @ model["vectors"].T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64)
        total = weight.sum(axis=1)
        some = total > 0
        score[a : a + 256][some] = np.clip((weight * model["labels"][near]).sum(axis=1)[some] / total[some], 0.0, 1.0)
    return score


def score(docs: DataFrame, model: dict, text_column="text", name="score") -> DataFrame:
    """``docs`` with a score column (0 to 1) appended."""
    spark = docs.sparkSession
    docs = docs.drop(name)
    shared = spark.sparkContext.broadcast(model)
    width = len(docs.columns)

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch, "__text"):
                values = vote(shared.value, term_counts(data, offsets))
                columns = [batch.column(i).slice(a, b - a) for i in range(width)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], schema=None, names=[f"c{i}" for i in range(width + 1)])

    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(text_column).alias("__text"))
    fields = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(docs.dtypes))
    out = plain.mapInArrow(run, f"{fields}, c{width} double")
    return out.toDF(*docs.columns, name)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, added=("score", "predicted"), **names) -> DataFrame:
    """``docs`` with its score and the predicted label (1 if the score reaches the threshold) added."""
    model = train(docs, labels, **names)
    scored = score(docs.drop(*added), model, names.get("text_column", "text"), added[0])
    return scored.withColumn(added[1], (F.col(added[0]) >= threshold).cast("int"))


def op10_quality(spark, folder: str) -> DataFrame:
    ready(spark)
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = classify(docs, read(spark, folder, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
