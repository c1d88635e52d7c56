"""Removal of long repeated byte strings by a sorted, thinned-out set of suffixes.

Every string of ``LENGTH`` bytes picks one of its places by its content alone: the one whose next ``SEED`` bytes have the
smallest hash (winnowing; Schleimer, Wilkerson, Aiken 2003). Equal strings pick the same place, so it is enough to
compare the suffixes at picked places (about one in 85) and the bytes before them.

1. Seeds that occur once in the corpus are left out; they are counted over all documents.
2. A picked place with its *context*, the bytes of all the strings that picked it, is grouped with equal ones. Contexts
   that occur more than once are covered as a whole. One place stands for each context from here on.
3. Seeds with several different contexts: their suffixes are range-partitioned by sampled splitters on their leading
   bytes (the seed, so that no seed is cut), and each bucket sorts its suffixes, and the reversed bytes before the
   place, by multikey quicksort on 8-byte keys; only ties go on to the next key. The common prefixes of neighbours in
   both orders tell which strings occur twice.
4. A seed with more than ``HOT`` different contexts doesn't go into one bucket: its strings are counted by digest, which
   aggregates before the shuffle.

Strings are judged on the input. Matches never cross documents. Null texts are empty. Rows with equal key and text are
documents of their own that repeat each other; a null key counts as the smallest. Texts shorter than ``LENGTH`` stay.
Empty tables give no rows. Only the key and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm import bloom
from cardmill.llm import text as tx
from cardmill.llm.tables import read, ready
from cardmill.session import materialize

LENGTH = 200
SEED = 32
HOT = 4096
BATCH_CONTEXTS = 8192
_U = np.uint64
ROW = "doc long, hash long"


def _rows(docs: DataFrame, key: str, text_column: str) -> DataFrame:
    doc = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc")
    return docs.select(doc, F.xxhash64(text_column).alias("hash"), F.coalesce(text_column, F.lit("")).alias("text"))


def seed_hashes(data: np.ndarray, size: int = SEED) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from each place on."""
    h, base, step = tx._byte_values(False)[data], 0x9E3779B97F4A7C15, 1
    while step < size:
        factor = _U(pow(base, step, 1 << 64))
        h = h[:-step] * factor + h[step:]
        step *= 2
    return tx.mix(h)


def picked(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, size: int = SEED):
    """Place, first and last start of the strings that picked it, row and seed hash."""
    none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, _U)]
    if len(data) < length:
        return none
    h = seed_hashes(data, size)
    width = length - size + 1
    best = (h & ~_U(0xFFFFFFFF)) | (_U(0xFFFFFFFF) - np.arange(len(h), dtype=_U))
    step = 1
    while 2 * step <= width:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    best = np.minimum(best[: len(best) - (width - step)], best[width - step :]) if width > step else best
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    if not sizes.sum():
        return none
    rows = np.repeat(np.arange(len(sizes)), sizes)
    starts = offsets[:-1][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = (_U(0xFFFFFFFF) - (best[starts] & _U(0xFFFFFFFF))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])])
    last = np.r_[first[1:], len(place)] - 1
    return place[first], starts[first], starts[last], rows[first], h[place[first]]


def _context_hashes(data, first, last, length):
    return tuple(tx.span_hashes(data, first, last + length, lower=False, kind=kind) for kind in (0, 1))


def _seed_counts(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in tx.text_slices(batch):
                seeds, counts = np.unique(picked(data, offsets, length)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(counts)], ["seed", "n"])

    return rows.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1").select("seed")


PLACES = f"{ROW}, at int, first int, last int, seed long, c1 long, c2 long"


def _places(rows: DataFrame, length: int, shared) -> DataFrame:
    """Picked places whose seed passes the filter, with hashes of their contexts."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                at, first, last, row, seed = picked(data, offsets, length)
                keep = bloom.contains(shared.value, seed)
                at, first, last, row, seed = at[keep], first[keep], last[keep], row[keep], seed[keep]
                c1, c2 = _context_hashes(data, first, last, length)
                ids = [batch.column(i).slice(a, b - a).take(pa.array(row)) for i in (0, 1)]
                origin = offsets[:-1][row]
                numbers = [pa.array((x - origin).astype(np.int32)) for x in (at, first, last)]
                hashes = [pa.array(x.view(np.int64)) for x in (seed, c1, c2)]
                yield pa.RecordBatch.from_arrays([*ids, *numbers, *hashes], ["doc", "hash", "at", "first", "last", "seed", "c1", "c2"])

    return rows.mapInArrow(run, PLACES)


def _context_key(doc, text_hash, at) -> np.ndarray:
    return tx.mix(tx.mix(doc.view(_U)) ^ tx.mix(text_hash.view(_U) + _U(1)) ^ (at.astype(np.int64).view(_U) * _U(0xD6E8FEB86659FD93))).view(np.int64)


def _key_column(places: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            doc, text_hash, at = (batch.column(i).to_numpy() for i in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(_context_key(doc, text_hash, at))], ["key"])

    return places.select("doc", "hash", "at").mapInArrow(run, "key long")


def _contexts(rows: DataFrame, length: int, shared) -> DataFrame:
    """Bytes of the contexts whose place passes the filter."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                at, first, last, row, _ = picked(data, offsets, length)
                doc, text_hash = (batch.column(i).slice(a, b - a).to_numpy()[row] for i in (0, 1))
                origin = offsets[:-1][row]
                keep = np.flatnonzero(bloom.contains(shared.value, _context_key(doc, text_hash, at - origin)))
                whole = data.tobytes()
                bytes_ = [whole[first[i] : last[i] + length] for i in keep]
                seeds = [whole[at[i] : at[i] + SEED] for i in keep]
                columns = [pa.array(doc[keep]), pa.array(text_hash[keep]), pa.array((at - origin)[keep].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(bytes_, pa.binary()), pa.array(seeds, pa.binary())], ["doc", "hash", "at", "bytes", "lead"])

    return rows.mapInArrow(run, f"{ROW}, at int, bytes binary, lead binary")


def multikey_order(group: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group and keys (a column at a time, ties only), and equal bytes with the row before.

    ``keys`` are big-endian 8-byte pieces of the strings. The count is -1 where the group changes.
    """
    n, width = keys.shape
    order = np.argsort(group, kind="stable")
    fresh = np.r_[True, group[order][1:] != group[order][:-1]]  # where a new class of ties begins
    for w in range(width):
        classes = np.cumsum(fresh) - 1
        sizes = np.bincount(classes)
        tied = np.flatnonzero(sizes[classes] > 1)
        if not len(tied):
            break
        values = keys[order[tied], w]
        within = np.lexsort((values, classes[tied]))
        order[tied] = order[tied][within]
        values, own = values[within], classes[tied]
        fresh[tied[1:]] |= (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    sorted_keys = keys[order].astype(">u8").view(np.uint8).reshape(n, width * 8)
    common = np.full(n, -1, dtype=np.int64)
    if n > 1:
        differ = sorted_keys[1:] != sorted_keys[:-1]
        same_group = group[order][1:] == group[order][:-1]
        common[1:] = np.where(same_group, np.where(differ.any(axis=1), differ.argmax(axis=1), width * 8), -1)
    return order, common


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p[:width].ljust(width, b"\0") for p in parts), dtype=">u8").reshape(len(parts), width // 8).astype(_U)


def repeated_starts(seeds: list, contexts: list[bytes], left: np.ndarray, length: int = LENGTH):
    """(context, start in it) of every string that another context of the same seed holds too.

    ``left`` is the number of bytes before the place in each context.
    """
    n = len(contexts)
    group = np.unique(np.array(seeds, dtype=object), return_inverse=True)[1]
    sizes = np.array([len(c) for c in contexts])
    right_width, left_width = -(-length // 8) * 8, -(-int(length - SEED) // 8) * 8
    right, common_right = multikey_order(group, _padded([c[k:] for c, k in zip(contexts, left)], right_width))
    before, common_left = multikey_order(group, _padded([c[:k][::-1] for c, k in zip(contexts, left)], left_width))
    last = sizes - length  # the last start in each context
    found, starts = [], []
    for back in range(int(left.max(initial=-1)) + 1):
        some = np.flatnonzero((left >= back) & (left - back <= last))
        if len(some) < 2:
            continue
        class_right, class_left = np.empty(n, np.int64), np.empty(n, np.int64)
        class_right[right] = np.cumsum(common_right < length - back)
        class_left[before] = np.cumsum(common_left < back)
        both = class_right[some] * (n + 1) + class_left[some]
        order = np.argsort(both, kind="stable")
        equal = both[order][1:] == both[order][:-1]
        twice = np.zeros(len(some), dtype=bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        found.append(some[twice])
        starts.append((left[some] - back)[twice])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, starts = np.concatenate(found), np.concatenate(starts)
    order = np.lexsort((starts, found))
    return found[order], starts[order]


SPANS = f"{ROW}, low int, high int"


def _spans(table, found, starts, origin, length):
    """Runs of consecutive starts as byte ranges of the documents."""
    if not len(found):
        return None
    first = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (starts[1:] != starts[:-1] + 1)])
    last = np.r_[first[1:], len(found)] - 1
    low, high = origin[found[first]] + starts[first], origin[found[first]] + starts[last] + length
    ids = [pa.array(table.column(c).to_numpy()[found[first]]) for c in ("doc", "hash")]
    return pa.RecordBatch.from_arrays([*ids, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["doc", "hash", "low", "high"])


def _bucket_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated byte ranges of contexts that share a seed (columns doc, hash, at, first, lead, bytes)."""

    def compare(held):
        table = pa.Table.from_batches(held).combine_chunks()
        left = table.column("at").to_numpy() - table.column("first").to_numpy()
        found, starts = repeated_starts(table.column("lead").to_pylist(), table.column("bytes").to_pylist(), left, length)
        return _spans(table, found, starts, table.column("first").to_numpy(), length)

    def run(batches):
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if count + batch.num_rows > BATCH_CONTEXTS and count:
                # Whole seeds only: those up to the last one held, which may go on in this batch.
                lead = held[-1].column(held[-1].num_columns - 2)[-1]
                goes_on = int(np.argmin([x == lead for x in batch.column(batch.num_columns - 2)] + [False]))
                held.append(batch.slice(0, goes_on))
                if goes_on < batch.num_rows:
                    out = compare(held)
                    if out is not None:
                        yield out
                    held, count = [batch.slice(goes_on)], batch.num_rows - goes_on
                else:
                    count += goes_on
                continue
            held.append(batch)
            count += batch.num_rows
        if held:
            out = compare(held)
            if out is not None:
                yield out

    sorted_ = contexts.select("doc", "hash", "at", "first", "lead", "bytes").repartitionByRange("lead").sortWithinPartitions("lead")
    return sorted_.mapInArrow(run, SPANS)


def _hot_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for seeds with very many contexts, by counting the digests of their strings."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch, "bytes"):
                sizes = np.diff(offsets) - length + 1
                row = np.repeat(np.arange(b - a), sizes)
                start = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                low = offsets[:-1][row] + start
                d1, d2 = _context_hashes(data, low, low, length)
                ids = [batch.column(i).slice(a, b - a).take(pa.array(row)) for i in (0, 1)]
                place = batch.column(3).slice(a, b - a).to_numpy()[row] + start
                yield pa.RecordBatch.from_arrays([*ids, pa.array(place.astype(np.int32)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))], ["doc", "hash", "low", "d1", "d2"])

    strings = contexts.select("doc", "hash", "at", "first", "bytes").mapInArrow(run, f"{ROW}, low int, d1 long, d2 long")
    twice = strings.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return strings.join(twice, ["d1", "d2"]).select("doc", "hash", "low", (F.col("low") + length).alias("high"))


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte ranges (doc, hash, low, high) to remove; they may overlap. ``rows`` has doc, hash, text."""
    spark = rows.sparkSession
    seeds = materialize(_seed_counts(rows, length), "seeds")
    known = spark.sparkContext.broadcast(bloom.build(seeds))  # of fixed size
    places = materialize(_places(rows, length, known).join(seeds, "seed"), "places")
    one = F.struct("doc", "hash", "at", "first")
    contexts = materialize(places.groupBy("seed", "c1", "c2").agg(F.count("*").alias("n"), F.min(one).alias("one")), "contexts")
    several = contexts.groupBy("seed").agg(F.count("*").alias("k")).filter("k > 1")
    compared = materialize(contexts.join(several, "seed").select("one.*", "n", "k"), "compared")
    wanted = spark.sparkContext.broadcast(bloom.build(_key_column(compared)))
    place = ["doc", "hash", "at"]
    strings = materialize(_contexts(rows, length, wanted).join(compared, place).dropDuplicates(place), "strings")

    copies = contexts.filter("n > 1").select("seed", "c1", "c2")
    whole = places.join(copies, ["seed", "c1", "c2"]).select("doc", "hash", F.col("first").alias("low"), (F.col("last") + length).alias("high"))
    alike = _bucket_spans(strings.filter(F.col("k") <= HOT), length)
    hot = _hot_spans(strings.filter(F.col("k") > HOT), length)
    return whole.union(alike).union(hot)


def remove_repeats(docs: DataFrame, key="doc_id", text_column="text", length: int = LENGTH) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, spans (low, high), kept (binary)."""
    rows = _rows(docs, key, text_column)
    spans = repeated_spans(rows, length).groupBy("doc", "hash").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = rows.join(spans, ["doc", "hash"], "left").select("doc", "text", "spans")

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for text, found in zip(batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                merged = []
                for low, high in sorted((s["low"], s["high"]) for s in found.as_py() or ()):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                kept, at = [], 0
                for low, high in merged:
                    kept.append(data[at:low])
                    at = high
                kept.append(data[at:])
                for column, value in zip(out, (len(data), sum(h - l for l, h in merged), len(merged), merged, b"".join(kept))):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, types)]], ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    found = joined.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")
    return found.withColumn("id", F.when(F.col("id") != F.lit(-(2**63)), F.col("id"))).withColumnRenamed("id", key)


def op4_substrings(spark, folder: str) -> DataFrame:
    ready(spark)
    found = remove_repeats(read(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT doc_id, unnest(range(0, (length(h) // 2 - 199)::BIGINT)) AS place FROM bytes
), strings AS (
  SELECT doc_id, place, md5(substr(h, 2 * place + 1, 400)) AS d FROM starts JOIN bytes USING (doc_id)
), repeated AS (
  SELECT doc_id, place FROM strings WHERE d IN (SELECT d FROM strings GROUP BY d HAVING count(*) > 1)
), ahead AS (
  SELECT *, lag(place) OVER w AS before FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), runs AS (
  SELECT *, sum(CASE WHEN before IS NULL OR place > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM ahead
), spans AS (
  SELECT doc_id, run, min(place) AS low, max(place) + 200 AS high FROM runs GROUP BY ALL
), gaps AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS previous FROM spans
), kept AS (
  SELECT doc_id, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans, max(high) AS tail,
    string_agg(substr(h, 2 * previous + 1, 2 * (low - previous)), '' ORDER BY low) AS k
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT b.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN tail IS NULL THEN h ELSE k || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM bytes b LEFT JOIN kept ON kept.doc_id = b.doc_id
"""
