"""Benchmark decontamination by greedy string tiling (Wise, 1993).

Words are runs of letters and digits, in lower case. Every shingle of ``MIN_MATCH`` words of a benchmark item is a seed
(an item of fewer words is one seed as a whole). A document is compared with the items it shares seeds with: the
longest run of words equal in both is marked in both, again and again, until no unmarked run of ``MIN_MATCH`` words is
left. Only words inside shared seeds can be marked, so an item whose shared seeds hold less than ``COVERAGE`` of its
words is not tiled at all; short seeds meet often by chance, and nearly all such meetings end there. Runs are found with the rolling (Karp-Rabin) hashes of the seeds and grown along diagonals, and each run is
compared word by word hash. An item counts as leaked if its marked words reach ``COVERAGE`` of it, wherever in the
document and in whatever order they stand.

Seeds are broadcast in slices of items, each of about ``SLICE_WORDS`` words (8 bytes a word); a larger benchmark takes
more passes over the documents. Slices are dealt by a hash of the item, so one slice exceeds the bound at most by the
unevenness of the hash and by a single item.

Null and empty texts, on either side, match nothing; items without words are never leaked. Items with equal texts are
reported each, documents with the same key too. Empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm import text as tx
from cardmill.llm.tables import read, ready

MIN_MATCH = 4
COVERAGE = 0.5
SLICE_WORDS = 2_000_000
FILTER_BITS = 22
MEETINGS = 1_000_000  # seeds that documents share with items, looked at together; one document may have more
FOUND = "id long, item long, tiles int, covered int, item_words int, coverage double"


def plain_words(data: np.ndarray, offsets: np.ndarray):
    """Hash and row of each run of ASCII letters, digits and non-ASCII bytes."""
    inside = np.zeros(256, dtype=bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        inside[low:high] = True
    starts, ends, rows = tx.bounds(data, offsets, inside[data])
    return tx.span_hashes(data, starts, ends), rows


def tiles(runs: list[tuple[int, int, int]], least: int) -> tuple[int, int]:
    """Greedy tiling from maximal runs (length, place in the item, place in the document): tiles and marked words."""
    heap = [(-n, j, i) for n, j, i in runs]
    heapq.heapify(heap)
    in_item, in_doc, count, covered = set(), set(), 0, 0
    while heap:
        n, j, i = heapq.heappop(heap)
        free = [k for k in range(-n) if j + k not in in_item and i + k not in in_doc]
        if len(free) == -n:
            in_item.update(range(j, j - n))
            in_doc.update(range(i, i - n))
            count, covered = count + 1, covered - n
            continue
        at = 0
        while at < len(free):
            to = at
            while to + 1 < len(free) and free[to + 1] == free[to] + 1:
                to += 1
            if to - at + 1 >= least:
                heapq.heappush(heap, (-(to - at + 1), j + free[at], i + free[at]))
            at = to + 1
    return count, covered


def diagonal_runs(places: list[tuple[int, int]], seed: int) -> list[tuple[int, int, int]]:
    """Maximal runs from the (item place, document place) of equal seeds."""
    runs, last = [], None
    for diagonal, j in sorted((i - j, j) for j, i in places):
        if last and last[0] == diagonal and last[1] + 1 == j:
            last[1] = j
        else:
            last = [diagonal, j, j]
            runs.append(last)
    return [(to - at + seed, at, at + diagonal) for diagonal, to, at in ((r[0], r[1], r[2]) for r in runs)]


def _index(items: list[tuple[int, np.ndarray]], least: int) -> dict[int, tuple]:
    """By seed length: sorted seeds, the item and place of each, and a bit filter on their low bits."""
    index = {}
    for length in sorted({min(least, len(w)) for _, w in items}):
        chosen = [(k, w) for k, (_, w) in enumerate(items) if min(least, len(w)) == length]
        hashes = np.concatenate([w for _, w in chosen])
        owner = np.repeat([k for k, _ in chosen], [len(w) for _, w in chosen])
        seeds, place = _rolled(hashes, owner, length)
        start = np.zeros(len(items), dtype=np.int64)
        start[[k for k, _ in chosen]] = np.cumsum([0] + [len(w) for _, w in chosen])[:-1]
        owner = owner[place]
        order = np.argsort(seeds, kind="stable")
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        bits[(seeds & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        index[length] = (seeds[order], owner[order], (place - start[owner])[order], bits)
    return index


def _rolled(hashes: np.ndarray, rows: np.ndarray, k: int):
    """Karp-Rabin hash of every k consecutive words of a row, and where each begins."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + hashes[j : len(hashes) - k + 1 + j]
    at = np.flatnonzero(rows[k - 1 :] == rows[: len(acc)])
    return tx.mix(acc[at] + np.uint64(k)), at


def _promising(row: np.ndarray, low: np.ndarray, high: np.ndarray, owners: np.ndarray, places: np.ndarray, length: int, needed: np.ndarray):
    """Pairs (row, owner) whose distinct shared seeds hold at least ``needed[owner]`` words, from seeds low..high met in each row."""
    fresh = np.ones(len(row), dtype=bool)
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    fresh[1:] = (row[1:] != row[:-1]) | (low[1:] != low[:-1])
    row, low, count = row[fresh], low[fresh], (high - low)[fresh]
    ends = np.cumsum(count)
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))  # of each row
    chunk = (ends - count)[first] // MEETINGS
    cuts = np.concatenate([first[np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))], [len(row)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        n = count[a:b]
        seed = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        its_row, owner, place = np.repeat(row[a:b], n), owners[seed], places[seed]
        order = np.lexsort((place, owner, its_row))
        its_row, owner, place = its_row[order], owner[order], place[order]
        begins = np.concatenate([[True], (its_row[1:] != its_row[:-1]) | (owner[1:] != owner[:-1])])
        held = np.full(len(place), length)
        inner = np.flatnonzero(~begins)
        held[inner - 1] = np.minimum(length, place[inner] - place[inner - 1])
        at = np.flatnonzero(begins)
        enough = np.add.reduceat(held, at) >= needed[owner[at]]
        yield from zip(its_row[at[enough]].tolist(), owner[at[enough]].tolist())


def compare(items: list[tuple[int, np.ndarray]], index: dict, data: np.ndarray, offsets: np.ndarray, least: int, coverage: float):
    """(row, item id, tiles, covered, words of the item) of every leaked item of each text."""
    hashes, rows = plain_words(data, offsets)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    needed = np.array([coverage * len(w) for _, w in items])
    met: dict[tuple[int, int], list] = {}
    for length, (seeds, owners, places, bits) in index.items():
        rolled, at = _rolled(hashes, rows, length)
        maybe = np.flatnonzero(bits[(rolled & np.uint64(len(bits) - 1)).astype(np.int64)])
        low, high = np.searchsorted(seeds, rolled[maybe], "left"), np.searchsorted(seeds, rolled[maybe], "right")
        hit = low < high
        at, low, high = at[maybe[hit]], low[hit], high[hit]
        if not len(at):
            continue
        row = rows[at]
        for r, k in _promising(row, low, high, owners, places, length, needed):
            its_seeds, its_places = _rolled(items[k][1], np.zeros(len(items[k][1]), np.int64), length)
            where: dict[int, list[int]] = {}
            for seed, j in zip(np.searchsorted(seeds, its_seeds).tolist(), its_places.tolist()):
                where.setdefault(seed, []).append(j)
            a, b = np.searchsorted(row, r, "left"), np.searchsorted(row, r, "right")
            met[r, k] = [(j, i) for seed, i in zip(low[a:b].tolist(), (at[a:b] - first[r]).tolist()) for j in where.get(seed, ())]
    for (row, k), seeds_met in sorted(met.items()):
        item, its_words = items[k]
        own = hashes[first[row] : first[row + 1]]
        seed = min(least, len(its_words))
        runs = [(n, j, i) for n, j, i in diagonal_runs(seeds_met, seed) if (own[i : i + n] == its_words[j : j + n]).all()]
        count, covered = tiles(runs, seed)
        if covered >= coverage * len(its_words):
            yield row, item, count, covered, len(its_words)


def _item_words(benchmark: DataFrame, key: str, text_column: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for a, b, data, offsets in tx.text_slices(batch):
                hashes, rows = plain_words(data, offsets)
                ends = np.searchsorted(rows, np.arange(b - a + 1))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column], ["item", "words"])

    plain = benchmark.select(F.col(key).cast("long").alias("item"), F.lower(text_column).alias("text"))
    return plain.mapInArrow(run, "item long, words array<long>").filter(F.size("words") > 0)


def leaks(
    docs: DataFrame, benchmark: DataFrame, key="doc_id", text_column="text", item_key="item_id", item_text="text",
    least: int = MIN_MATCH, coverage: float = COVERAGE, slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """One row for each document and leaked item: id, item, tiles, covered, item_words, coverage."""
    spark = docs.sparkSession
    words = _item_words(benchmark, item_key, item_text)
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    count = max(1, math.ceil(total / slice_words))
    plain = docs.select(F.col(key).cast("long").alias("id"), F.lower(text_column).alias("text"))
    out = spark.createDataFrame([], FOUND)
    for number in range(count if total else 0):
        part = words.filter(F.pmod(F.xxhash64("item"), F.lit(count)) == number).orderBy("item").collect()  # about slice_words words
        items = [(r.item, np.array(r.words, dtype=np.int64).view(np.uint64)) for r in part]
        if not items:
            continue
        shared = spark.sparkContext.broadcast((items, _index(items, least)))

        def run(batches, shared=shared):
            for batch in batches:
                for a, b, data, offsets in tx.text_slices(batch):
                    found = list(compare(*shared.value, data, offsets, least, coverage))
                    ids = batch.column(0).slice(a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([f[0] for f in found], pa.int64())), pa.array([f[1] for f in found], pa.int64()),
                            *[pa.array([f[i] for f in found], pa.int32()) for i in (2, 3, 4)],
                            pa.array([f[3] / f[4] for f in found], pa.float64()),
                        ],
                        ["id", "item", "tiles", "covered", "item_words", "coverage"],
                    )

        out = out.union(plain.mapInArrow(run, FOUND))
    return out.select(F.col("id").alias(key), F.col("item").alias(item_key), "tiles", "covered", "item_words", "coverage")


def op9_decontaminate(spark, folder: str) -> DataFrame:
    ready(spark)
    return leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
