"""How far the sources of a language differ in their words, priced on a quadtree over the matrix of counts.

A language is a matrix: one row for each source, one column for each kept term, with the counts as cells. Smoothed shares
of the terms are whole numbers, p = 1 + floor(10^9 * (count + 5) / (N + 5 V)), so all sums are exact. The distance of two
sources is the sum of |p - q| over all kept terms.

* Words are counted for each batch of texts with their bytes as identity, then summed by Spark; a source or a term with
  very many rows is one small row for each batch.
* Columns are numbered by falling count, rows by falling number of terms, so filled cells lie together. The matrix is
  cut into strips of ``STRIP`` columns and bands of ``BAND`` rows; a strip and a pair of bands is one group.
* In a group each band is a k-squared tree (k = 2): a quadrant is marked if any of its cells is filled. Two rows are
  compared by walking down both trees together: a quadrant that is empty for both is uniform in either row, and its
  columns are priced at once, width times |p0 - q0|; filled quadrants are followed to their cells.

Null text, language and source count as ''. A language without kept terms has distances of zero; a language with one
source has none. Repeated rows are documents of their own. Other columns play no part. An empty table gives nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardmill.llm import text as tx
from cardmill.llm.tables import numbered, read, ready
from cardmill.session import materialize

LEAST_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
STRIP, BAND = 4096, 256
SLICE = 4 << 20

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Terms of the texts, A-Z lowered, with the text each stands in."""
    starts, ends, rows = tx.bounds(data, offsets, _LETTERS[data])
    places = np.append(0, np.cumsum(ends - starts))
    kept = _LOWER[data[_LETTERS[data]]]
    column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(kept.tobytes()))
    return column.dictionary_encode(), rows


def _windows(data: np.ndarray):
    """One long text in parts that end between terms; a longer term stays whole."""
    breaks, at = np.flatnonzero(~_LETTERS[data]), 0
    while at < len(data):
        i = int(np.searchsorted(breaks, at + SLICE))
        to = int(breaks[i]) + 1 if i < len(breaks) else len(data)
        yield data[at:to]
        at = to


def _counted(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """(group, term, occurrences, documents) for the texts, which belong to the given groups."""
    if len(offsets) == 2 and len(data) > SLICE:
        parts = [_counted_at_once(w, np.array([0, len(w)]), group) for w in _windows(data)]
        coded = pa.chunked_array([p[1] for p in parts]).combine_chunks().dictionary_encode()
        count = np.bincount(coded.indices.to_numpy(), np.concatenate([p[2] for p in parts])).astype(np.int64)
        return np.full(len(count), group[0]), coded.dictionary, count, np.ones(len(count), np.int64)
    return _counted_at_once(data, offsets, group)


def _counted_at_once(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    coded, rows = _terms(data, offsets)
    size, index = max(len(coded.dictionary), 1), coded.indices.to_numpy()
    in_text, times = np.unique(rows * size + index, return_counts=True)
    keys, first = np.unique(group[in_text // size] * size + in_text % size, return_inverse=True)
    count = np.bincount(first, times, len(keys)).astype(np.int64)
    return keys // size, coded.dictionary.take(pa.array(keys % size)), count, np.bincount(first, minlength=len(keys))


def _count_batches(batches):
    for batch in batches:
        pair = pa.StructArray.from_arrays([batch.column(0).dictionary_encode().indices, batch.column(1).dictionary_encode().indices], ["a", "b"])
        codes = pair.field(0).to_numpy().astype(np.int64) << 32 | pair.field(1).to_numpy()
        _, first, group = np.unique(codes, return_index=True, return_inverse=True)
        for a, b, data, offsets in tx.text_slices(batch, "text", SLICE):
            owner, term, count, documents = _counted(data, offsets, group[a:b])
            row = pa.array(first[owner])
            columns = [batch.column(0).take(row), batch.column(1).take(row), term.cast(pa.string()), pa.array(count), pa.array(documents)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "documents"])


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the terms kept: those in enough documents of their language."""
    counted = docs.mapInArrow(_count_batches, "lang string, source string, term string, n long, documents long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    language = Window.partitionBy("lang", "term")
    whole = summed.withColumns({"lang_n": F.sum("n").over(language), "lang_documents": F.sum("documents").over(language)})
    return whole.filter(F.col("lang_documents") >= least_documents).select("lang", "source", "term", "n", "lang_n")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)) in whole numbers of 38 digits."""
    above = (count + SMOOTHING).cast("decimal(27,0)") * F.lit(UNIT).cast("decimal(11,0)")
    below = (total + kept * SMOOTHING).cast("decimal(38,0)")
    return F.lit(1) + F.call_function("div", above, below)


def _levels(filled: np.ndarray) -> list[np.ndarray]:
    """Marks of the quadrants, from single cells up to the whole matrix."""
    levels = [filled]
    while max(levels[-1].shape) > 1:
        m = levels[-1]
        m = np.pad(m, [(0, n % 2) for n in m.shape])
        levels.append(m.reshape(m.shape[0] // 2, 2, m.shape[1] // 2, 2).any(axis=(1, 3)))
    return levels


def _compare(g: int, others: np.ndarray, trees, shares, empty, width: int) -> np.ndarray:
    """Distances of row g of the first matrix to rows of the second, over ``width`` columns, walking both trees."""
    total = np.zeros(len(others), dtype=np.int64)
    gap = np.abs(empty[0][g] - empty[1][others])
    depth = max(len(trees[0]), len(trees[1])) - 1
    pair, column = np.arange(len(others)), np.zeros(len(others), dtype=np.int64)
    for level in range(depth, -1, -1):
        a, b = (t[min(level, len(t) - 1)] for t in trees)  # above its root a tree is its root
        filled = a[min(g >> level, len(a) - 1), column] | b[np.minimum(others[pair] >> level, len(b) - 1), column]
        span = np.minimum((column + 1) << level, width) - (column << level)
        np.add.at(total, pair[~filled], (span * gap[pair])[~filled])
        pair, column = pair[filled], column[filled]
        if level:
            pair, column = np.repeat(pair, 2), (np.repeat(column * 2, 2).reshape(-1, 2) + (0, 1)).reshape(-1)
            inside = column << (level - 1) < width
            pair, column = pair[inside], column[inside]
    np.add.at(total, pair, np.abs(shares[0][g, column] - shares[1][others[pair], column]))
    return total


def _price(key, cells: pa.Table, rows: pa.Table) -> pa.Table:
    lang, strip, low, high = (k.as_py() for k in key)
    number, band = rows["row"].to_numpy(), rows["row"].to_numpy() // BAND
    kept = rows["kept"][0].as_py() if rows.num_rows else 0
    width = min(STRIP, kept - strip * STRIP)
    at, column, p = cells["row"].to_numpy(), cells["column"].to_numpy() % STRIP, cells["p"].to_numpy()
    sides = []
    for b in (low, high):
        mine = np.flatnonzero(band == b)
        mine = mine[np.argsort(number[mine])]
        empty = rows["empty"].to_numpy()[mine]
        shares = np.repeat(empty[:, None], max(width, 1), axis=1)
        filled = np.zeros(shares.shape, dtype=bool)
        here = at // BAND == b
        shares[at[here] - b * BAND, column[here]] = p[here]
        filled[at[here] - b * BAND, column[here]] = True
        sides.append((number[mine], _levels(filled), shares, empty))
    (a_rows, *a), (b_rows, *b) = sides
    left, right, value = [], [], []
    for g in range(len(a_rows)):
        others = np.arange(g + 1 if low == high else 0, len(b_rows))
        if len(others):
            left.append(np.repeat(a_rows[g], len(others)))
            right.append(b_rows[others])
            value.append(_compare(g, others, *zip(a, b), width) if width > 0 else np.zeros(len(others), np.int64))
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (left, right, value)]
    return pa.table([pa.array([lang] * len(columns[0]), pa.string()), *map(pa.array, columns)], ["lang", "a", "b", "value"])


def _every(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(count, F.lit(1)).cast("long") - 1))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and terms above the language's share."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = materialize(term_counts(named, least_documents), "term-counts")
    terms = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).withColumn("falling", -F.col("lang_n"))
    columns = materialize(numbered(terms, ["lang"], ["falling", "term"], "column").select("lang", "term", "column"), "columns")
    languages = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), (-F.count("*")).alias("falling"))
    groups = named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left").na.fill(0)
    empty = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(0).cast("long"))
    groups = numbered(groups.withColumn("empty", empty), ["lang"], ["falling", "source"], "row")
    groups = materialize(groups.withColumn("bands", F.ceil((F.max("row").over(Window.partitionBy("lang")) + 1) / BAND)), "sources")

    facts = groups.select("lang", "source", "row", "bands", "total", "kept", "lang_total")
    cells = kept.join(columns, ["lang", "term"]).join(facts, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))
    cells = materialize(cells.withColumn("above", F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))), "cells")

    band, other = F.floor(F.col("row") / BAND), F.col("other")
    pair = [F.least(band, other).alias("low"), F.greatest(band, other).alias("high")]
    dealt = cells.withColumn("other", _every(F.col("bands"))).select("lang", F.floor(F.col("column") / STRIP).alias("strip"), *pair, "row", "column", "p")
    sides = groups.withColumn("strip", _every(F.ceil(F.col("kept") / STRIP))).withColumn("other", _every(F.col("bands")))
    sides = sides.select("lang", "strip", *pair, "row", "empty", "kept")
    by = ["lang", "strip", "low", "high"]
    priced = dealt.groupBy(*by).cogroup(sides.groupBy(*by)).applyInArrow(_price, "lang string, a long, b long, value long")
    summed = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = summed.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "value")
    names = groups.select("lang", "source", "row")
    pairs = (
        both.select("lang", F.col("p.a").alias("row"), F.col("p.b").alias("b"), "value")
        .join(names, ["lang", "row"])
        .join(names.select("lang", F.col("row").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    over = cells.filter("above > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("above").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).union(over.withColumn("rank", rank).filter(F.col("rank") <= top_terms))


def op12_divergence(spark, folder: str) -> DataFrame:
    ready(spark)
    return audit(read(spark, folder, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), c AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), v AS (
  SELECT lang, count(*) AS kept, sum(n) AS n FROM k GROUP BY lang
), t AS (
  SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // CAST(coalesce(t.n, 0) + 5 * v.kept AS HUGEINT) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // CAST(v.n + 5 * v.kept AS HUGEINT) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    CAST(coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms) WHERE rank <= 50
"""
