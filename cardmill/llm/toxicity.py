"""Toxicity: votes of the nearest labelled examples by TF-IDF cosine, found with a block-max inverted index.

Examples are a bounded sample of labelled rows (``sample``, half of each label where there are enough), chosen by a hash
of the key. The vocabulary is the ``vocabulary`` words that separate the labels best by chi square in the sample and
lean to label 1; inverse document frequencies count all documents. The index keeps the examples in blocks with the
largest weight of each word in a block. A query visits blocks by descending bound and stops when no block can beat its
k-th neighbour, so its neighbours are exact. All of the index is bounded by ``sample`` and ``vocabulary``.

Neighbours vote with their cosine, each label weighted by how much it was thinned out in the sample; the share of
label 1 among labelled rows enters as one more vote. Texts without a word of the vocabulary (null and empty ones too)
have no neighbours and score that share; without labels it is 0. Ties go to the example that comes first by hash and
key. Rows are scored each for itself, whatever their key; columns other than key and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardmill.llm import text as tx
from cardmill.llm.decontaminate import plain_words
from cardmill.llm.tables import held_out, read, ready

SAMPLE = 8000
VOCABULARY = 512
LEAST_CHI_SQUARE = 15.0  # a word by chance reaches this once in 10 000
NEIGHBOURS = 15
BLOCK = 64
LEAN = 0.8  # share of label 1 among the sample's documents with the word, both labels weighted alike
PRIOR_WEIGHT = 1.5


def _lowered(df: DataFrame, text_column: str, *columns) -> DataFrame:
    return df.select(*columns, F.lower(text_column).alias("text"))


def _counts(data, offsets, words: np.ndarray) -> np.ndarray:
    """How often each word of the sorted vocabulary occurs in each text."""
    n = len(offsets) - 1
    hashes, rows = plain_words(data, offsets)
    if not len(words) or not len(hashes):
        return np.zeros((n, len(words)), dtype=np.float32)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = words[at] == hashes
    return np.bincount(rows[hit] * len(words) + at[hit], minlength=n * len(words)).reshape(n, len(words)).astype(np.float32)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def examples(labels: DataFrame, key: str, label: str, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """Keys and labels of the sample, and how many labelled rows there are by label."""
    known = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and __key is not null")
    known = known.filter(~held_out(F.col("__key"))).groupBy("__key").agg(F.max("label").alias("label"))
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    parts = [known.filter(F.col("label") == y).orderBy(F.xxhash64("__key"), "__key").limit(sample // 2) for y in (0, 1)]
    return parts[0].union(parts[1]), totals


def vocabulary(chosen: DataFrame, size: int) -> np.ndarray:
    """Hashes of the words that tell label 1 best, sorted; ``chosen`` has label and lowered text."""

    def spread(batches):
        for batch in batches:
            labels = batch.column(0).to_numpy()
            for a, b, data, offsets in tx.text_slices(batch):
                values, rows = tx.distinct(*plain_words(data, offsets))
                words, at = np.unique(values, return_inverse=True)
                toxic = np.bincount(at, weights=labels[a:b][rows], minlength=len(words)).astype(np.int64)
                total = np.bincount(at, minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(toxic), pa.array(total)], ["word", "p", "n"])

    sizes = {r.label: r["count"] for r in chosen.groupBy("label").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return np.zeros(0, np.uint64)
    counted = chosen.mapInArrow(spread, "word long, p long, n long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, q = F.col("p"), F.col("n") - F.col("p")
    chi = F.pow(p * (good - q) - q * (bad - p), F.lit(2)) / ((p + q) * (bad + good - p - q) + F.lit(1e-9))
    lean = (p / bad) / (p / bad + q / good)
    chi = chi * (bad + good) / F.lit(float(bad) * good)
    best = counted.filter((chi >= LEAST_CHI_SQUARE) & (lean >= LEAN)).orderBy(chi.desc(), "word").limit(size).collect()
    return np.sort(np.array([r.word for r in best], dtype=np.int64).view(np.uint64))


def frequencies(docs: DataFrame, words: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each word occurs, and how many documents there are."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        total, n = np.zeros(len(shared.value), dtype=np.int64), 0
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                total += (_counts(data, offsets, shared.value) > 0).sum(axis=0)
                n += b - a
        yield pa.RecordBatch.from_pydict({"word": np.arange(len(total) + 1), "n": np.r_[total, n]})

    found = docs.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(words) + 1, dtype=np.int64)
    for row in found:
        counts[row.word] = row.n
    return counts[:-1], int(counts[-1])


def train(docs: DataFrame, labels: DataFrame, key="doc_id", text_column="text", label="toxic", sample=SAMPLE, size=VOCABULARY) -> dict:
    keys, totals = examples(labels, key, label, sample)
    rows = _lowered(docs, text_column, F.col(key).alias("__key")).join(F.broadcast(keys), "__key")  # at most ``sample`` keys
    one = Window.partitionBy("text").orderBy(F.xxhash64("__key"), "__key")
    chosen = rows.withColumn("__copy", F.row_number().over(one)).filter("__copy = 1").select("label", F.col("__key").cast("long").alias("key"), "text")
    words = vocabulary(chosen.select("label", "text"), size)
    known = sum(totals.values())
    prior = totals.get(1, 0) / known if known else 0.0
    model = {"words": words, "prior": prior, "vectors": np.zeros((0, len(words)), np.float32), "labels": np.zeros(0), "votes": np.zeros(0), "keys": np.zeros(0, np.int64)}
    model["idf"] = np.ones(len(words))
    if not len(words):
        return model | {"blocks": np.zeros((0, 0), np.float32)}
    frequency, n = frequencies(_lowered(docs, text_column), words)
    model["idf"] = np.log((1.0 + n) / (1.0 + frequency)) + 1.0

    def describe(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                counts = np.minimum(_counts(data, offsets, words), 60000).astype(np.uint16)
                keep = pa.array(counts.any(axis=1))
                out = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([c.tobytes() for c in counts])]
                yield pa.RecordBatch.from_arrays(out, ["label", "key", "counts"]).filter(keep)

    found = chosen.mapInArrow(describe, "label int, key long, counts binary").orderBy(F.xxhash64("key"), "key").limit(sample).collect()
    if not found:
        return model | {"blocks": np.zeros((0, len(words)), np.float32)}
    x = _vectors(np.stack([np.frombuffer(r.counts, np.uint16) for r in found]).astype(np.float64), model["idf"])
    y = np.array([r.label for r in found])
    size_of = {v: max(1, min(sample // 2, totals.get(v, 0))) for v in (0, 1)}
    order = np.argsort(x.argmax(axis=1), kind="stable")  # examples with the same leading word share blocks
    x, y = x[order].astype(np.float32), y[order]
    blocks = np.stack([x[a : a + BLOCK].max(axis=0) for a in range(0, len(x), BLOCK)])
    votes = np.array([totals[v] / size_of[v] for v in y])
    return model | {"vectors": x, "labels": y.astype(np.float64), "votes": votes / votes.min(), "keys": np.array([r.key for r in found])[order], "blocks": blocks}


def nearest(model: dict, queries: np.ndarray, k: int):
    """Cosines and places of the k nearest examples of each query, by blocks in the order of their bounds."""
    n = len(queries)
    best, place = np.full((n, k), -1.0, dtype=np.float32), np.full((n, k), -1)
    bounds = queries @ model["blocks"].T
    order = np.argsort(-bounds, axis=1, kind="stable")
    alive = np.arange(n)
    for step in range(bounds.shape[1]):
        block = order[alive, step]
        bound = bounds[alive, block]
        go = (bound > 0) & (bound + 1e-6 >= best[alive].min(axis=1))
        alive, block = alive[go], block[go]
        if not len(alive):
            break
        for b in np.unique(block):
            rows = alive[block == b]
            cosine = queries[rows] @ model["vectors"][b * BLOCK : (b + 1) * BLOCK].T
            at = np.broadcast_to(np.arange(b * BLOCK, b * BLOCK + cosine.shape[1]), cosine.shape)
            both, places = np.hstack([best[rows], cosine]), np.hstack([place[rows], at])
            top = np.lexsort((places, -both), axis=1)[:, :k]
            best[rows], place[rows] = np.take_along_axis(both, top, 1), np.take_along_axis(places, top, 1)
    return best, np.where(best > 0, place, -1)


def vote(model: dict, counts: np.ndarray, k: int = NEIGHBOURS):
    """Scores, and the keys and cosines of the neighbours as evidence."""
    n = len(counts)
    score, keys, cosines = np.full(n, float(model["prior"])), [[] for _ in range(n)], [[] for _ in range(n)]
    some = np.flatnonzero(counts.any(axis=1)) if len(model["labels"]) else np.zeros(0, np.int64)
    if len(some):
        best, place = nearest(model, _vectors(counts[some], model["idf"]).astype(np.float32), k)
        weight = np.where(place >= 0, np.maximum(best, 0), 0).astype(np.float64) * model["votes"][place]
        total = weight.sum(axis=1) + PRIOR_WEIGHT
        score[some] = np.clip(((weight * model["labels"][place]).sum(axis=1) + PRIOR_WEIGHT * model["prior"]) / total, 0, 1)
        for i, row in enumerate(some):
            real = place[i] >= 0
            keys[row], cosines[row] = model["keys"][place[i][real]].tolist(), best[i][real].astype(float).tolist()
    return score, keys, cosines


def score(docs: DataFrame, model: dict, key="doc_id", text_column="text") -> DataFrame:
    """key, score, keys and cosines of the nearest examples (evidence)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                values, keys, cosines = vote(shared.value, _counts(data, offsets, shared.value["words"]))
                columns = [pa.array(values), pa.array(keys, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["id", "score", "neighbours", "cosines"])

    plain = _lowered(docs, text_column, F.col(key).cast("long").alias("id"))
    return plain.mapInArrow(run, "id long, score double, neighbours array<long>, cosines array<double>").withColumnRenamed("id", key)


def op5_toxicity(spark, folder: str) -> DataFrame:
    ready(spark)
    docs = read(spark, folder, "documents")
    found = score(docs, train(docs, read(spark, folder, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "neighbours", "cosines"
    )
