"""Vectorised byte, word and shingle work on Arrow batches, used inside Spark tasks.

A null text counts as empty everywhere. Batches are cut into slices of about ``SLICE_BYTES`` so that the arrays
derived from them (8 bytes for each byte of text) stay small; a longer single text is one slice of its own.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_U = np.uint64


def mix(x):
    """The 64-bit finaliser of splitmix64 (Steele, Lea, Flood 2014)."""
    x = np.asarray(x, dtype=_U).copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of about ``limit`` bytes, at least one row each."""
    rows, at = len(offsets) - 1, 0
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(rows, max(to, at + 1))
        yield at, to
        at = to


def text_slices(batch, column: str = "text", limit: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets) for each slice of a record batch."""
    data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    for a, b in slices(offsets, limit):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def of_this_worker(name: str) -> dict:
    """A dictionary of this process that stays for later tasks.

    Functions are shipped by value, and with them a new copy of this module's variables for each task, which Python frees
    late; so the place is a module of its own.
    """
    return sys.modules.setdefault("cardmill_worker", types.ModuleType("cardmill_worker")).__dict__.setdefault(name, {})


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, cache = 0x9E3779B97F4A7C15, of_this_worker("powers")
    if n > len(cache.get("up", ())):
        size = max(n, SLICE_BYTES + 1)
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(size, factor, dtype=_U)
            steps[0] = 1
            cache[name] = np.multiply.accumulate(steps)
    return cache["up"], cache["down"]


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
    if lower:
        values[65:91] = values[97:123]
    return values


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Start, end and row of every maximal run of ``inside`` bytes that stays in one row."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def short_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of short byte ranges, from a polynomial modulo 2^64.

    Some pairs of ranges of a thousand bytes and more collide here, whatever the base: not for whole words or texts.
    """
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_byte_values(False)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


# Primes below 2^31 with a base each. Two of them make a hash; the other two make one that is independent of it.
_FIELDS = (
    ((2147483647, 1198754321), (2147483629, 730284619)),
    ((2147483587, 1610612741), (2147483579, 402653189)),
)


def _field_powers(prime: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo the prime."""
    cache = of_this_worker("field-powers")
    if n > len(cache.get(prime, ((),))[0]):
        size, tables = max(n, SLICE_BYTES + 1), []
        for factor in (base, pow(base, -1, prime)):
            powers = np.ones(1, dtype=_U)
            while len(powers) < size:
                step = pow(factor, len(powers), prime)
                powers = np.concatenate([powers, powers[: size - len(powers)] * _U(step) % _U(prime)])
            tables.append(powers)
        cache[prime] = tables
    return cache[prime]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, kind: int = 0) -> np.ndarray:
    """62-bit hashes of byte ranges of any length, equal for equal bytes (A-Z lowered if asked); ``kind`` 0 and 1 are independent.

    Polynomials modulo two primes: two ranges of n bytes collide only if the base is a root of their difference in both
    fields, one case in (2^31 / n)^2.
    """
    values = np.arange(1, 257, dtype=_U)
    if lower:
        values[65:91] = values[97:123]
    values, found = values[data], mix((ends - starts).astype(_U))
    sums, hashes = np.zeros(len(data) + 1, dtype=_U), []
    for prime, base in _FIELDS[kind]:
        up, down = _field_powers(prime, base, len(data) + 1)
        terms = values * up[: len(data)]
        if len(data) >= 1 << 24:
            terms %= _U(prime)
        np.cumsum(terms, out=sums[1:])
        hashes.append((sums[ends] - sums[starts]) % _U(prime) * down[starts] % _U(prime) * _U(base) % _U(prime))
    return mix(((hashes[0] << _U(31)) | hashes[1]) ^ found)


def words(data: np.ndarray, offsets: np.ndarray):
    """Hash and row of every word: runs of bytes other than space, tab and line ends, A-Z lowered."""
    separator = np.zeros(256, dtype=bool)
    separator[list(SEPARATORS)] = True
    starts, ends, rows = bounds(data, offsets, ~separator[data])
    return span_hashes(data, starts, ends), rows, starts, ends


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int):
    """Hashes and rows of all k-word shingles; a row of 1 to k-1 words gives its whole sequence."""
    base, n = _U(0xD6E8FEB86659FD93), len(hashes)
    parts, owners = [], []
    if n >= k:
        acc = np.zeros(n - k + 1, dtype=_U)
        for j in range(k):
            acc = acc * base + hashes[j : n - k + 1 + j]
        whole = rows[k - 1 :] == rows[: n - k + 1]
        parts.append(mix(acc[whole] + _U(k)))
        owners.append(rows[: n - k + 1][whole])
    if n:
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        counts = np.diff(np.r_[first, n])
        for c in range(1, k):
            at = first[counts == c]
            if len(at):
                acc = np.zeros(len(at), dtype=_U)
                for j in range(c):
                    acc = acc * base + hashes[at + j]
                parts.append(mix(acc + _U(c)))
                owners.append(rows[at])
    if not parts:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(owners)


def distinct(values: np.ndarray, rows: np.ndarray):
    """Distinct values of each row, sorted by row and value."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[keep], rows[keep]


def groups(batches, keys: int):
    """(key values, table) for each run of rows with equal first ``keys`` columns; a run may span batches."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i) for i in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            values = c.to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a].as_py() for c in columns)
            if held and key != now:
                yield now, pa.Table.from_batches(held).combine_chunks()
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held).combine_chunks()
