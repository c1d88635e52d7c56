"""SentencePiece encoding with sampled segmentations, and decoding.

The lattice of a text has an arc for every piece that matches at a place, and one arc of byte pieces for a character
that is no piece itself. A space is the piece character U+2581; that character itself, as any other unknown one, is
written in byte pieces, so that decoding always gives back the same bytes. No other normalisation takes place.

Forward filtering adds up the weight of all segmentations that end at a place, backward sampling walks from the end and
draws each arc in proportion to its share of that sum: an exact draw among all segmentations (Kudo, 2018). The random
numbers are hashes of the row's key and the place in the text, so a row's segmentation doesn't depend on partitioning.
Where no piece goes beyond a word with its leading spaces (checked), the lattice falls apart into words, and forward
sums are computed once for each distinct word of a slice.

A unigram model's scores are log probabilities. A BPE model only ranks its pieces; their weights then follow Zipf's
law, 1 / (2 + rank). ``alpha`` is the exponent of all weights: 1 samples from the model, larger values come close to the
best segmentation.

Null texts have null pieces and decode to null; empty texts have none. Rows with equal keys and texts get equal pieces;
a null key counts as 0. Other columns are kept as they are, except that one with the name of the added column is
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm import text as tx
from cardmill.llm.tables import read, ready

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
SLICE = 1 << 19
FILTER_BITS = 18
_U = np.uint64


def model_bytes(spark, path: str = MODEL) -> bytes:
    """The model file through Spark's readers (a vocabulary: some hundred kilobytes)."""
    return bytes(spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").first().content)


class Vocabulary:
    """Piece bytes, their weights, and by length: filters of their prefixes and of themselves, sorted hashes, ids."""

    def __init__(self, model: bytes, alpha: float):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        scores = np.array([p.get_score(i) for i in range(n)])
        self.byte_ids = np.zeros(256, dtype=np.int64)
        normal = []
        for i in range(n):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[i], self.byte_ids[value] = bytes([value]), i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.bytes[i] = piece.replace(SPACE, " ").encode()
                normal.append(i)
        ranks = np.minimum(-scores, n)
        if np.array_equal(scores, np.round(scores)):
            scores = -np.log(2.0 + ranks)
        self.weights = alpha * scores
        self.byte_weight = alpha * -np.log(2.0 + 2 * n)
        self.by_word = not any(b" " in self.bytes[i].lstrip(b" ") for i in normal)
        joined = np.frombuffer(b"".join(self.bytes[i] for i in normal), dtype=np.uint8)
        ends = np.cumsum([len(self.bytes[i]) for i in normal])
        starts = np.r_[0, ends[:-1]].astype(np.int64)
        self.longest = int((ends - starts).max())
        self.tables = []
        ids = np.array(normal)
        for length in range(1, self.longest + 1):
            reach = starts[ends - starts >= length]
            whole = ends - starts == length
            hashes = tx.short_hashes(joined, starts[whole], ends[whole])
            order = np.argsort(hashes)
            prefixes = _filter(tx.short_hashes(joined, reach, reach + length))
            self.tables.append((prefixes, _filter(hashes), hashes[order], ids[whole][order]))


def _filter(hashes: np.ndarray) -> np.ndarray:
    """Which low bits occur. A place that passes by chance has no arc, it only is looked at once more."""
    out = np.zeros(1 << FILTER_BITS, dtype=bool)
    out[(hashes & _U(len(out) - 1)).astype(np.int64)] = True
    return out


def _segments(data: np.ndarray, offsets: np.ndarray, by_word: bool):
    """Start, end and row of the pieces of text that are segmented independently."""
    if by_word and len(data):
        space = data == 32
        first = np.zeros(len(data), dtype=bool)
        first[1:] = space[1:] & ~space[:-1]
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(first)
    else:
        starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
    ends = np.r_[starts[1:], len(data)][: len(starts)]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _arcs(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Start, end, weight and piece (-1: bytes) of every arc; segments lie one after the other in ``data``."""
    limit = np.repeat(ends, ends - starts)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    up, down = tx._powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(tx._byte_values(False)[data] * up[: len(data)], out=sums[1:])
    begin, end, weight, piece = [], [], [], []
    width = np.r_[at[1:], len(data)] - at
    wide = np.zeros(len(data) + 1, dtype=np.int64)
    wide[at] = width
    known = np.zeros(len(data) + 1, dtype=bool)
    alive = at
    for length, (prefixes, pieces, hashes, ids) in enumerate(v.tables, 1):
        alive = alive[alive + length <= limit[alive]]
        if not len(alive):
            break
        here = tx.mix((sums[alive + length] - sums[alive]) * down[alive] + _U(length))
        low = (here & _U((1 << FILTER_BITS) - 1)).astype(np.int64)
        maybe = np.flatnonzero(pieces[low])
        if len(maybe):
            k = np.minimum(np.searchsorted(hashes, here[maybe]), len(hashes) - 1)
            found = hashes[k] == here[maybe]
            hit, k = alive[maybe[found]], k[found]
            begin.append(hit)
            end.append(hit + length)
            weight.append(v.weights[ids[k]])
            piece.append(ids[k])
            known[hit] |= wide[hit] == length
        alive = alive[prefixes[low]]
    other = ~known[at]
    begin.append(at[other])
    end.append(at[other] + width[other])
    weight.append(v.byte_weight * width[other])
    piece.append(np.full(int(other.sum()), -1))
    # By end, the longest first: runs that are sorted already, which the stable sort merges.
    order = np.argsort(np.concatenate(end[::-1]), kind="stable")
    return tuple(np.concatenate(x[::-1])[order] for x in (begin, end, weight, piece))


def _forward(begin, end, weight, starts, ends, size):
    """log of the summed weight of all ways from the start of its segment to each place that ends an arc.

    Places are filled in the order of their distance from the start of their segment, for all segments at once.
    """
    total = np.full(size + 1, -np.inf)
    segment = np.searchsorted(starts, begin, side="right") - 1
    base = starts[segment]
    depth = end - base
    order = np.argsort(depth.astype(np.uint16) if depth.max(initial=0) < 1 << 16 else depth, kind="stable")
    begin, end, weight, depth = begin[order], end[order], weight[order], depth[order]
    inside = begin > base[order]
    cuts = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(depth)]):
        value = weight[a:b] + np.where(inside[a:b], total[begin[a:b]], 0.0)
        places = end[a:b]
        first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        # A place that ends one segment starts the next; its sum belongs to the segment it ends.
        total[places[first]] = np.logaddexp.reduceat(value, first)
    return total


def _kinds(data, starts, ends):
    """One of each of the distinct segments, and the kind of every segment; equal hashes are checked byte by byte."""
    hashes = tx.span_hashes(data, starts, ends, lower=False)
    while True:
        _, one, kind = np.unique(hashes, return_index=True, return_inverse=True)
        size, shift = ends - starts, starts[one][kind] - starts
        odd = size != size[one][kind]
        alike = data == data[np.minimum(np.repeat(shift, size) + np.arange(starts[0], ends[-1]) - starts[0], len(data) - 1)]
        odd |= ~np.logical_and.reduceat(alike, starts - starts[0])
        if not odd.any():
            return one, kind
        hashes[odd] = tx.mix(hashes[odd] + _U(1))


def segment(v: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int):
    """Start in the text and piece (-1: bytes) of each sampled arc, in order of the text."""
    starts, ends, rows = _segments(data, offsets, v.by_word)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    one, kind = _kinds(data, starts, ends)
    size = ends[one] - starts[one]
    local_end = np.cumsum(size)
    local = local_end - size
    pool = data[np.repeat(starts[one] - local, size) + np.arange(local_end[-1])]
    begin, end, weight, piece = _arcs(v, pool, local, local_end)
    sums = _forward(begin, end, weight, local, local_end, len(pool))
    head = np.zeros(len(pool) + 1, dtype=bool)
    head[local] = True
    share = np.exp(weight + np.where(head[begin], 0.0, sums[begin]) - sums[end])
    last = np.flatnonzero(np.r_[end[1:] != end[:-1], True])
    firsts = np.r_[0, last[:-1] + 1]
    running = np.cumsum(share)
    running -= np.repeat((running - share)[firsts], last - firsts + 1)
    running[last] = np.inf
    first_of = np.full(len(pool) + 1, -1)
    first_of[end[last]] = firsts
    by_kind = np.argsort(kind, kind="stable")  # neighbours in memory then look at the same arcs
    rows, kind = rows[by_kind], kind[by_kind]
    salt = tx.mix(keys.astype(np.int64).view(_U)[rows] + _U(seed) * _U(0x9E3779B97F4A7C15))
    floor, place = local[kind], local_end[kind]
    shift = starts[by_kind] - floor
    origin = shift - offsets[rows]
    out_at, out_end, out_piece = [], [], []
    while len(place):
        where = (place + origin).astype(np.int64).view(_U)
        u = (tx.mix(salt ^ (where * _U(0xD6E8FEB86659FD93))) >> _U(11)).astype(np.float64) / float(1 << 53)
        arc = first_of[place]
        more = np.flatnonzero(running[arc] <= u)
        while len(more):
            arc[more] += 1
            more = more[running[arc[more]] <= u[more]]
        out_at.append(begin[arc] + shift)
        out_end.append(place + shift)
        out_piece.append(piece[arc])
        place = begin[arc]
        go = np.flatnonzero(place > floor)
        place, floor, shift, origin, salt = place[go], floor[go], shift[go], origin[go], salt[go]
    at, to, found = np.concatenate(out_at), np.concatenate(out_end), np.concatenate(out_piece)
    order = np.argsort(at, kind="stable")
    return at[order], to[order], found[order]


def piece_ids(v: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int):
    """Ids of all texts one after the other, and the offsets of the texts in them."""
    at, to, found = segment(v, data, offsets, keys, seed)
    count = np.where(found < 0, to - at, 1)
    ends = np.cumsum(count)
    ids = np.repeat(found, count)
    loose = np.flatnonzero(ids < 0)
    arc = np.searchsorted(ends, loose, side="right")
    ids[loose] = v.byte_ids[data[at[arc] + loose - (ends - count)[arc]]]
    bound = np.r_[0, ends][np.searchsorted(at, offsets)]
    return ids.astype(np.int32), bound


def _with(docs: DataFrame, extra, added: dict[str, str], run) -> DataFrame:
    """``docs`` with more columns (names and types) computed by ``run`` from the ``extra`` columns; clashing names do no harm."""
    kept_columns = docs.drop(*added).columns
    width = len(kept_columns)
    types = [*(t for _, t in docs.drop(*added).dtypes), *added.values()]
    names = [f"c{i}" for i in range(len(types))]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept_columns)], *extra)

    def whole(batches):
        for batch in batches:
            for a, b, *columns in run(batch):
                kept = [batch.column(i).slice(a, b - a) for i in range(width)]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names)

    out = plain.mapInArrow(whole, ", ".join(f"{c} {t}" for c, t in zip(names, types)))
    return out.toDF(*kept_columns, *added)


def _coded(v: Vocabulary, keys: pa.Array, texts: pa.Array, seed: int):
    """First row, end row and pieces of each slice of a batch."""
    numbers = keys.fill_null(0).to_numpy(zero_copy_only=False)
    data, offsets = tx.flat(texts)
    for a, b in tx.slices(offsets, SLICE):
        ids, bound = piece_ids(v, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], numbers[a:b], seed)
        yield a, b, pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(ids), mask=texts.slice(a, b - a).is_null())


def _decoded(known: np.ndarray, lists: pa.Array) -> pa.Array:
    return pa.array([b"".join(known[x.values.to_numpy()]).decode("utf-8", "replace") if x.is_valid else None for x in lists], pa.string())


def _inputs(key: str, text_column: str):
    return [F.col(key).cast("long").alias("__key"), F.col(text_column).alias("__text")]


def encode(docs: DataFrame, model: bytes, key="doc_id", text_column="text", name="pieces", alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``docs`` with the ids of a sampled segmentation (array<int>) added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loaded: dict[str, Vocabulary] = {}

    def run(batch):
        if not loaded:
            loaded["v"] = Vocabulary(shared.value, alpha)
        n = batch.num_columns
        yield from _coded(loaded["v"], batch.column(n - 2), batch.column(n - 1), seed)

    return _with(docs, _inputs(key, text_column), {name: "array<int>"}, run)


def decode(docs: DataFrame, model: bytes, pieces="pieces", name="decoded") -> DataFrame:
    """``docs`` with the text of its pieces added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loaded: dict[str, np.ndarray] = {}

    def run(batch):
        if not loaded:
            loaded["v"] = np.array(Vocabulary(shared.value, 1.0).bytes, dtype=object)
        yield 0, batch.num_rows, _decoded(loaded["v"], batch.column(batch.num_columns - 1))

    return _with(docs, [F.col(pieces).alias("__pieces")], {name: "string"}, run)


def encode_and_decode(
    docs: DataFrame, model: bytes, key="doc_id", text_column="text", name="pieces", decoded="decoded", alpha: float = 1.0, seed: int = 0
) -> DataFrame:
    """``encode``, then ``decode``: one Python worker for each task does both, with one vocabulary in memory."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loaded: dict[str, Vocabulary | np.ndarray] = {}

    def run(batch):
        if not loaded:
            loaded["v"] = Vocabulary(shared.value, alpha)
            loaded["known"] = np.array(loaded["v"].bytes, dtype=object)
        n = batch.num_columns
        for a, b, ids in _coded(loaded["v"], batch.column(n - 2), batch.column(n - 1), seed):
            yield a, b, ids, _decoded(loaded["known"], ids)

    return _with(docs, _inputs(key, text_column), {name: "array<int>", decoded: "string"}, run)


def op3_pieces(spark, folder: str) -> DataFrame:
    ready(spark)
    model = model_bytes(spark)
    docs = read(spark, folder, "documents").select("doc_id", "text")
    both = encode_and_decode(docs, model)
    return both.select("doc_id", F.size("pieces").alias("n_pieces"), "pieces", F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))
