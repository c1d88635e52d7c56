"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, table distances, exact cosines.

Vectors are compared only within one label and one length. Copies form a class and are compared once.

* The coarse centroids and the residual codebooks are fitted on at most ``SAMPLE`` vectors, chosen by hash; every vector
  is indexed.
* Two unit vectors with cosine >= t lie at most r = sqrt(2 - 2t) apart. A query at distance d from its nearest centroid
  c can only have such a partner in the list of c' if the bisector of c and c' is at most r away; exactly those lists
  are probed. The probes are sufficient: no link is lost by them.
* Distances to coded vectors come from tables of the query's residual (asymmetric). A vector y with code y' and
  |y - y'| = e is dropped only if |x - y'| > r + e, so no link is lost here either. The rest is compared by cosine in
  double precision.
* A list is cut into blocks of about ``BLOCK`` vectors and its queries into blocks too, so a hot label or cluster is
  spread over many groups. A group returns counts and a spanning forest of its links, never the pairs.

Null, zero or non-finite vectors, and vectors with a null label, link with nothing. Rows with equal or null keys are
vectors of their own: they count as links of one another and of their neighbours, and links lead through them. The
component is named by the smallest key in it; a row with a null key has a null component and is kept. Finite vectors of
any size are compared: in double precision they are first scaled by a power of two. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm.components import stored_components
from cardmill.llm.tables import read, ready
from cardmill.session import materialize

SAMPLE = 16_384
LIST_SIZE = 2048  # vectors of the largest label in one list, on average
MOST_LISTS = 1024
SUBSPACES = 8
CODES = 64
BLOCK = 2048
SLACK = 1e-6  # rounding of distances in tables


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _scaled(v: list, kind: str) -> np.ndarray:
    """The vector as ``kind``; in double precision with its largest component between 1/2 and 1, so that squares are finite."""
    x = np.array(v, dtype=np.float64)
    return (x if kind == "float32" else np.ldexp(x, -np.frexp(np.abs(x).max())[1])).astype(kind)


def _matrix(column, width: int, kind: str) -> np.ndarray:
    """Vectors kept as bytes of ``kind``, padded with zeros to ``width``, as float64."""
    parts, size = column.to_pylist(), width * np.dtype(kind).itemsize
    return np.frombuffer(b"".join(p.ljust(size, b"\0") for p in parts), dtype=kind).reshape(len(parts), width).astype(np.float64)


def _lloyd(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(np.int64)].copy()
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> dict:
    """Coarse centroids and codebooks (subspace, code, dimension) of residuals. Bounded by the sample."""
    x = _unit(sample)
    centroids = _lloyd(x, lists)
    residual = x - centroids[(x @ centroids.T - 0.5 * (centroids**2).sum(axis=1)).argmax(axis=1)]
    books = [_lloyd(part, CODES) for part in np.split(residual, SUBSPACES, axis=1)]
    return {"centroids": centroids, "books": books}


def _nearest(model, x):
    c = model["centroids"]
    squares = (x**2).sum(axis=1)[:, None] - 2 * x @ c.T + (c**2).sum(axis=1)
    return squares.argmin(axis=1), np.maximum(squares, 0)


def _encode(model, residual):
    codes = np.empty((len(residual), SUBSPACES), dtype=np.uint8)
    rebuilt = np.empty_like(residual)
    size = residual.shape[1] // SUBSPACES
    for j, book in enumerate(model["books"]):
        part = residual[:, j * size : (j + 1) * size]
        codes[:, j] = (part @ book.T - 0.5 * (book**2).sum(axis=1)).argmax(axis=1)
        rebuilt[:, j * size : (j + 1) * size] = book[codes[:, j]]
    return codes, np.linalg.norm(residual - rebuilt, axis=1)


def _forest(a: np.ndarray, b: np.ndarray):
    """Edges (node, root) that connect what the links (a, b) connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def link_block(model, list_number, ids, codes, errors, vectors, weights, queries, query_ids, threshold):
    """Links between a block of one list and queries: weighted counts of each query, and the links (query, id)."""
    reach = math.sqrt(2 - 2 * threshold)
    size = vectors.shape[1] // SUBSPACES
    x, y = _unit(queries), _unit(vectors)
    residual = x - model["centroids"][list_number]
    squares = np.zeros((len(x), len(y)), dtype=np.float32)
    for j, book in enumerate(model["books"]):
        part = residual[:, j * size : (j + 1) * size]
        table = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
        squares += table.astype(np.float32)[:, codes[:, j]]
    q, i = np.nonzero(squares <= (reach + errors + SLACK)[None, :] ** 2 + SLACK)
    other = query_ids[q] != ids[i]
    q, i = q[other], i[other]
    cosine = np.concatenate([np.einsum("ij,ij->i", x[q[a : a + 65536]], y[i[a : a + 65536]]) for a in range(0, len(q), 65536)] or [np.zeros(0)])
    q, i = q[cosine >= threshold], i[cosine >= threshold]
    return np.bincount(q, weights=weights[i], minlength=len(x)).astype(np.int64), q, i


def near_vectors(vectors: DataFrame, threshold: float, key="vec_id", vector="embedding", label="label") -> DataFrame:
    """One row per vector: key, n_links (other vectors linked directly), component_id, kept."""
    spark = vectors.sparkSession
    stored = "float32" if dict(vectors.dtypes)[vector] == "array<float>" else "float64"  # no precision is lost
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = rows.filter(valid)
    classes = usable.groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    numbered = {"id": F.monotonically_increasing_id(), "dim": F.size("v"), "class": F.xxhash64("label", "v")}
    classes = materialize(classes.withColumns(numbered), "classes")
    shape = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).agg(F.max("n"), F.max("dim")).first()
    if not shape[0]:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    width = -(-shape[1] // SUBSPACES) * SUBSPACES

    def pack(batches):
        for batch in batches:
            column = pa.array([_scaled(v, stored).tobytes() for v in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), column, *[batch.column(i) for i in range(2, 5)]], ["id", "v", "label", "dim", "weight"])

    kind = dict(classes.dtypes)["label"]
    packed = materialize(classes.select("id", "v", "label", "dim", "weight").mapInArrow(pack, f"id long, v binary, label {kind}, dim int, weight long"), "packed-vectors")
    drawn = packed.orderBy(F.xxhash64("id"), "id").select("v").limit(SAMPLE).toArrow()
    model = fit(_matrix(drawn.column("v"), width, stored), max(1, min(MOST_LISTS, shape[0] // LIST_SIZE)))
    shared = spark.sparkContext.broadcast(model)
    reach = math.sqrt(2 - 2 * threshold)

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column(1), width, stored))
                near, _ = _nearest(shared.value, x)
                codes, errors = _encode(shared.value, x - shared.value["centroids"][near])
                more = [pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], ["id", "v", "label", "dim", "weight", "list", "codes", "error"])

    def probe(batches):
        c = shared.value["centroids"]
        apart = np.sqrt(np.maximum(((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2), 0))
        for batch in batches:
            if batch.num_rows:
                near, squares = _nearest(shared.value, _unit(_matrix(batch.column(1), width, stored)))
                margin = squares - squares[np.arange(len(near)), near][:, None]
                q, lists = np.nonzero(margin <= 2 * (reach + SLACK) * apart[near] + SLACK)
                at = pa.array(q)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(4)], pa.array(lists.astype(np.int32))], ["id", "v", "label", "dim", "list"])

    indexed = materialize(packed.mapInArrow(index, f"id long, v binary, label {kind}, dim int, weight long, list int, codes binary, error double"), "codes")
    probes = packed.select("id", "v", "label", "dim").mapInArrow(probe, f"id long, v binary, label {kind}, dim int, list int")
    part = ["label", "dim", "list"]
    blocks = indexed.groupBy(*part).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    wanted = materialize(probes, "probes")
    spread = wanted.groupBy(*part).agg(F.ceil(F.count("*") / (2 * BLOCK)).cast("int").alias("spread"))
    sizes = blocks.join(spread, part)
    block, own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("id"), F.col("spread")).cast("int")
    left = indexed.join(sizes, part).withColumn("block", block).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)))
    right = wanted.join(sizes, part).withColumn("turn", own).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [*part, "block", "turn"]

    def compare(x, y):
        none = [np.zeros(0, np.int64)] * 3
        ids, counts, roots = none
        if len(x) and len(y):
            vectors_, queries = _matrix(x.column("v"), width, stored), _matrix(y.column("v"), width, stored)
            codes = np.frombuffer(b"".join(x.column("codes").to_pylist()), dtype=np.uint8).reshape(len(x), SUBSPACES)
            index_ids, query_ids = x.column("id").to_numpy(), y.column("id").to_numpy()
            number, errors, weights = x.column("list")[0].as_py(), x.column("error").to_numpy(), x.column("weight").to_numpy()
            counted, from_, to = [], [], []
            for a in range(0, len(queries), 256):
                some = slice(a, a + 256)
                n, q, i = link_block(shared.value, number, index_ids, codes, errors, vectors_, weights, queries[some], query_ids[some], threshold)
                counted.append(n)
                from_.append(query_ids[some][q])
                to.append(index_ids[i])
            nodes, root = _forest(np.concatenate(from_), np.concatenate(to))
            total = np.concatenate(counted)
            ids = np.concatenate([query_ids[total > 0], nodes])
            counts = np.concatenate([total[total > 0], np.zeros(len(nodes), np.int64)])
            roots = np.concatenate([query_ids[total > 0], root])
        return pa.table({"a": ids, "b": roots, "n": counts})

    found = left.select(*group, "id", "v", "weight", "codes", "error").groupBy(*group).cogroup(right.select(*group, "id", "v").groupBy(*group))
    found = materialize(found.applyInArrow(compare, "a long, b long, n long"), "vector-links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n")).toDF("rep", "n")
    component = stored_components(found.filter("a <> b").select("a", "b")).toDF("rep", "component")

    class_of = classes.select("class", "label", "v", F.col("id").alias("rep"), "least", "weight")
    smallest = class_of.select("rep", "least").join(component, "rep").groupBy("component").agg(F.min("least").alias("smallest"))
    named = rows.withColumn("class", F.when(valid, F.xxhash64("label", "v"))).alias("r").join(
        class_of.alias("c"), (F.col("r.class") == F.col("c.class")) & (F.col("r.label") == F.col("c.label")) & (F.col("r.v") == F.col("c.v")), "left"
    )
    named = named.select("r.id", "rep", "least", "weight").join(counts, "rep", "left").join(component.join(smallest, "component"), "rep", "left")
    links = F.coalesce(F.col("weight") - 1, F.lit(0)) + F.coalesce("n", F.lit(0))
    place = F.when(F.col("id").isNotNull(), F.coalesce("smallest", "least", "id"))
    return named.select(
        F.col("id").alias(key), links.cast("long").alias("n_links"), place.alias("component_id"), F.coalesce(F.col("id") == place, F.lit(True)).alias("kept")
    )


def op2_vectors(spark, folder: str) -> DataFrame:
    ready(spark)
    return near_vectors(read(spark, folder, "embeddings"), 0.93)


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, coalesce(
    label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)) > 0,
    false) AS valid
  FROM embeddings
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE p.valid AND q.valid AND list_cosine_similarity(p.e, q.e) >= 0.93
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), smallest AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM v LEFT JOIN smallest s ON s.a = vec_id LEFT JOIN counts c ON c.a = vec_id
"""
