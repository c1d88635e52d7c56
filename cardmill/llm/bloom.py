"""A Bloom filter of fixed size over 64-bit hashes.

It only saves shuffles: what passes by chance is removed by an exact join afterwards. Its size doesn't grow with the
data; a filter that is too full lets more pass, and the join then does the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm.text import mix

BITS = 1 << 25


def _places(hashes: np.ndarray) -> list[np.ndarray]:
    hashes = hashes.view(np.uint64)
    return [(mix(hashes + np.uint64(salt)) & np.uint64(BITS - 1)).astype(np.int64) for salt in (11, 23)]


def build(df: DataFrame) -> np.ndarray:
    """The filter of the first column (long), as 64-bit words; at most ``BITS / 64`` rows come to the driver."""

    def run(batches):
        for batch in batches:
            at = np.concatenate(_places(batch.column(0).to_numpy()))
            words, inverse = np.unique(at >> 6, return_inverse=True)
            masks = np.zeros(len(words), dtype=np.uint64)
            np.bitwise_or.at(masks, inverse, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(masks.view(np.int64))], ["word", "mask"])

    found = df.mapInArrow(run, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    words = np.zeros(BITS // 64, dtype=np.uint64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return words


def contains(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), dtype=bool)
    for at in _places(hashes):
        out &= ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return out
