"""Best-fit packing of documents into sequences of at most ``CAPACITY`` tokens.

Lengths are whole numbers up to the capacity, so an instance of any size is a histogram with one count for each length.
The packing is planned on the histogram and says for every length how many pieces go where; the pieces themselves are
numbered within their length by ranges and look their place up. A plan step uses up a length or a class of bins, so the
plan is bounded by the capacity and not by the data.

* Reduction (Martello and Toth, 1990): for each length, from the largest, a set F of at most three pieces that holds it
  is fixed for good if F dominates every other set that holds it: nothing else fits; the best partner fills the sequence
  or beats every pair; or the best partner together with the best third is at least as large, piece by piece, as any
  pair. Some optimal packing holds such sets, so the rest may be packed without them. Counts only shrink the choice, so
  a set is fixed as often as its pieces last.
* Best fit: what remains, from the largest, goes into the fullest sequence that has room.

A null or empty text is the end token alone. A text whose ids and end token exceed the capacity is cut into full pieces,
the first of which takes the rest and may be shorter. Texts are encoded in stretches, cut only where the byte-level
splitting rule always cuts. Rows with equal or null keys, and repeated rows,
are documents of their own. Other columns are left out. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from cardmill.llm import text as tx
from cardmill.llm.tables import numbered, read, ready
from cardmill.session import materialize

CAPACITY = 1024
END = 2
STRETCH = 1 << 20  # bytes of text encoded at once
CACHED = 3 << 17  # encoded stretches of text a worker remembers
ENCODED = 4096  # stretches the tokenizer holds at once


def dominating(counts: Counter, size: int, capacity: int) -> tuple[int, ...] | None:
    """A set of pieces with ``size`` that dominates all sets with it, if one of at most three pieces is known to."""
    room = capacity - size
    rest = Counter(counts)
    rest[size] -= 1
    sizes = sorted(s for s, n in rest.items() if n > 0)
    smallest = [s for s in sizes[:3] for _ in range(min(rest[s], 3))][:3]
    if not smallest or smallest[0] > room:
        return (size,)
    fitting = [s for s in sizes if s <= room]
    best = fitting[-1]
    if best == room or len(smallest) == 1 or sum(smallest[:2]) > room:
        return (size, best)
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    pairs = [(a, b) for a, b in _pairs(fitting, rest, room)]
    if best >= max(a + b for a, b in pairs):
        return (size, best)
    thirds = [b for b in fitting if best + b <= room and (b < best or rest[b] > 1)]
    if thirds and thirds[-1] >= max(b for _, b in pairs):
        return (size, best, thirds[-1])
    return None


def _pairs(sizes: list[int], counts: Counter, room: int):
    """For each length, the largest partner of at least that length which fits beside it: (larger, smaller)."""
    top = len(sizes) - 1
    for i, b in enumerate(sizes):
        while top >= 0 and sizes[top] + b > room:
            top -= 1
        if top > i or top == i and counts[b] > 1:
            yield sizes[top], b


def reduced(counts: Counter, capacity: int = CAPACITY) -> tuple[list, Counter]:
    """Dominating sets as (pieces, how often), and the counts that remain."""
    counts, fixed, changed = Counter({s: n for s, n in counts.items() if n}), [], True
    while changed:
        changed = False
        for size in sorted(counts, reverse=True):
            while counts[size]:
                found = dominating(counts, size, capacity)
                if found is None:
                    break
                need = Counter(found)
                times = min(counts[s] // n for s, n in need.items())
                for s, n in need.items():
                    counts[s] -= times * n
                fixed.append((sorted(need.items(), reverse=True), times))
                changed = True
        counts = Counter({s: n for s, n in counts.items() if n})
    return fixed, counts


def best_fit(counts: Counter, capacity: int = CAPACITY) -> list:
    """Best-fit decreasing on counts: [(pieces as (length, number), how many such sequences)]."""
    bins: dict[int, list] = {}

    def add(room: int, content: list, times: int) -> None:
        if times:
            bins.setdefault(room, []).append((content, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in bins if r >= size):
            # A sequence that takes one stays the fullest with room, so it takes all that fit.
            fit, classes = room // size, bins.pop(room)
            for content, times in classes:
                full = min(times, left // fit)
                add(room - fit * size, [*content, (size, fit)], full)
                left -= full * fit
                last = left if full < times and left else 0
                if last:
                    add(room - last * size, [*content, (size, last)], 1)
                    left = 0
                add(room, content, times - full - (1 if last else 0))
        fit = capacity // size
        add(capacity - fit * size, [(size, fit)], left // fit)
        if left % fit:
            add(capacity - left % fit * size, [(size, left % fit)], 1)
    return [entry for classes in bins.values() for entry in classes]


def plan(counts: Counter, capacity: int = CAPACITY) -> list:
    fixed, rest = reduced(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _slots(patterns: list) -> np.ndarray:
    """Rows (length, first number, pieces in each sequence, first sequence, offset), sorted by length and number."""
    taken, rows, sequence = Counter(), [], 0
    for content, times in patterns:
        offset = 0
        for size, number in content:
            rows.append((size, taken[size], number, sequence, offset))
            taken[size] += number * times
            offset += number * size
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``; other columns ride along."""
    stored = materialize(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    lengths = stored.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most one row for each length
    odd = [r.length for r in lengths if r.length is None or not 1 <= r.length <= capacity]
    if odd:
        raise ValueError(f"lengths outside 1 to {capacity}: {odd[:5]}")
    slots = _slots(plan(Counter({int(r.length): r.n for r in lengths}), capacity))
    ranked = numbered(stored, ["length"], ["__row"], "__rank")
    names = ranked.columns
    fields = [*(f for f in ranked.schema if f.name not in ("__row", "__rank"))]
    schema = StructType(fields).add("sequence_id", LongType()).add("offset", LongType())

    def look_up(batches):
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(names.index("__rank")).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(slots[:, 0], length), np.searchsorted(slots[:, 0], length, side="right")
            while np.any(high - low > 1):  # the last slot of the length that starts at or before the number
                middle = (low + high) // 2
                right = (high - low > 1) & (slots[np.minimum(middle, len(slots) - 1), 1] <= rank)
                high = np.where(right | (high - low <= 1), high, middle)
                low = np.where(right, middle, low)
            slot = slots[low]
            step, within = np.divmod(rank - slot[:, 1], slot[:, 2])
            found = {"sequence_id": pa.array(slot[:, 3] + step), "offset": pa.array(slot[:, 4] + within * length)}
            columns = [found[f.name] if f.name in found else batch.column(names.index(f.name)) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.mapInArrow(look_up, schema)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places where the splitting rule surely begins a new token, whatever stands further left.

    Before white space after a visible character, before an ASCII mark after a letter, and after a lone line end between
    visible characters. Characters that may be white space beyond ASCII count as neither.
    """
    letter, seen = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
    letter[0x41:0x5B] = letter[0x61:0x7B] = True
    seen[0x21:0x7F] = True
    space, mark = np.zeros(256, dtype=bool), seen & ~letter
    space[[0x20, 0x0A]] = True
    mark[0x30:0x3A] = False
    cut, n = np.zeros(len(data), dtype=bool), len(data)
    if n < 4:
        return cut
    visible, letters = seen[data], letter[data]
    wide = data >= 0x80
    latin = np.zeros(n, dtype=bool)  # last byte of a letter of two bytes that begins with C3
    latin[1:] = wide[1:] & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letters |= latin
    visible |= latin
    cut[1:] = visible[:-1] & space[data[1:]] | letters[:-1] & mark[data[1:]]
    lone = (data[1:-1] == 0x0A) & visible[:-2] & seen[data[2:]]
    cut[2:] |= lone
    return cut


class Encoder:
    """Ids of byte-level pairs. Stretches between cuts are encoded once and remembered."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one of many threads already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.first = np.zeros(1 << 16, dtype=np.uint32), np.zeros(CACHED * 2, dtype=np.int64)

    def _learn(self, stretches: list[str]) -> None:
        known, at, lists = self.known, len(self.known), []
        for i in range(0, len(stretches), ENCODED):
            batch = self.tokenizer.encode_batch_fast(stretches[i : i + ENCODED], add_special_tokens=False)
            lists += [array("I", found.ids) for found in batch]
        ends = np.cumsum([len(ids) for ids in lists]) + self.first[at]
        self.first = _room(self.first, at + len(lists) + 1)
        self.first[at + 1 : at + 1 + len(lists)] = ends
        self.flat = _room(self.flat, int(ends[-1]))
        self.flat[self.first[at] : ends[-1]] = np.fromiter(chain.from_iterable(lists), np.uint32, int(ends[-1] - self.first[at]))
        known.update(zip(stretches, range(at, at + len(stretches))))

    def _numbers(self, stretches: list[str]) -> np.ndarray:
        new = [s for s in stretches if s not in self.known]
        if new and len(self.known) + len(new) > CACHED:
            self._forget()
            new = stretches
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many ids each text has."""
        counts = np.zeros(len(offsets) - 1, dtype=np.int64)
        starts = _cuts(data)
        for name in self.whole:  # names of added tokens are tokens wherever they stand
            for found in re.finditer(re.escape(name), data.tobytes()):
                starts[found.start() + 1 : found.end()] = False
        starts[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(starts)
        if not len(starts):
            return np.zeros(0, np.uint32), counts
        rows = np.searchsorted(offsets, starts, side="right") - 1
        ends = np.append(starts[1:], len(data))
        parts, at = [], 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + STRETCH, side="right")))
            places = pa.py_buffer((np.append(starts[at:to], ends[to - 1]) - starts[at]).astype(np.int32))
            column = pa.StringArray.from_buffers(to - at, places, pa.py_buffer(data[starts[at] : ends[to - 1]].tobytes()))
            coded = column.dictionary_encode()
            number = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            first, each = self.first[number], self.first[number + 1] - self.first[number]
            total = np.cumsum(each)
            parts.append(self.flat[np.repeat(first - (total - each), each) + np.arange(total[-1])])
            np.add.at(counts, rows[at:to], each)
            at = to
        return np.concatenate(parts), counts


def _of_this_worker(model: str) -> Encoder:
    """The encoder of this process. It stays for later tasks, with what it remembers; only one model is kept."""
    kept = tx.of_this_worker("encoders")
    if model not in kept:
        kept.clear()
        kept[model] = Encoder(model)
    return kept[model]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy at least twice as long if ``size`` does not fit."""
    if size <= len(array):
        return array
    longer = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    longer[: len(array)] = array
    return longer


def vocabulary(spark, path: str | None = None) -> str:
    """The tokenizer file: of an installed package, or of a store that Spark reads."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if "://" in str(path):
        return bytes(spark.read.format("binaryFile").load(path).first().content).decode()
    with open(path, encoding="utf-8") as file:
        return file.read()


def pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(key, piece, start, length, ids) of every document; ``ids`` are little-endian unsigned 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(key), F.col(text).alias("__text"))
    schema = StructType([source.schema[0]])
    for name, kind in (("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids", BinaryType())):
        schema = schema.add(name, kind)

    def cut(batches):
        encoder = _of_this_worker(shared.value)
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch, "__text", STRETCH):
                ids, counts = encoder.encode(data, offsets)
                totals = counts + 1
                closed = np.full(totals.sum(), end, dtype="<u4")
                inside = np.ones(len(closed), dtype=bool)
                inside[np.cumsum(totals) - 1] = False
                closed[inside] = ids
                number = -(-totals // capacity)
                document = np.repeat(np.arange(b - a), number)
                piece = np.arange(len(document)) - np.repeat(np.cumsum(number) - number, number)
                short = totals - (number - 1) * capacity
                length = np.where(piece == 0, short[document], capacity)
                start = np.where(piece == 0, 0, short[document] + (piece - 1) * capacity)
                ends = np.append(0, np.cumsum(length)) * 4
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(document), [None, pa.py_buffer(ends), pa.py_buffer(closed.tobytes())])
                columns = [batch.column(0).slice(a, b - a).take(pa.array(document)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), binary.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(cut, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids of each sequence, joined in the order of their offsets."""
    content = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most the capacity
    joined = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), content.alias("parts"))
    empty = F.lit(b"")
    return joined.select("sequence_id", "length", F.aggregate("parts", empty, lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def op13_packing(spark, folder: str) -> DataFrame:
    ready(spark)
    found = pieces(read(spark, folder, "documents"), vocabulary(spark))
    return place(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
