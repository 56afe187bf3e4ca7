"""Bloom filters of hashes: what a small side lets through of a large one before it is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.functions.blocks import BLOCK, packed, tree_merge

BITS_A_ROW = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28  # a filter of more rows than fit lets more through
PROBES = 4
# Odd multipliers that spread a hash over the places of its probes.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def filter_bits(rows: int) -> int:
    """A power of two, bounded on both sides."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_ROW * max(rows, 1) - 1).bit_length()))


def _places(hashes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word and bit of each probe."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    for k in range(PROBES):
        at = (hashes * MULTIPLIERS[k]) >> shift
        yield (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def hash_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of the one column of 64-bit hashes: one block a task, brought together in a tree."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for word, bit in _places(batch.column(0).to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(words, word, bit)
        yield packed(words.view("<f8"))

    def both(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (one.view("<u8") | two.view("<u8")).view("<f8")

    found = tree_merge(hashes.mapInArrow(mark, BLOCK), both)
    return np.zeros(bits // 64, np.uint64) if found is None else found.view("<u8").astype(np.uint64)


def may_have(df: DataFrame, hashes: Column, words: np.ndarray) -> DataFrame:
    """The rows of ``df`` whose hash the filter has, and a few others."""
    shared = df.sparkSession.sparkContext.broadcast(words)  # MOST_BITS at most

    @F.arrow_udf("boolean")
    def has(values: pa.Array) -> pa.Array:
        out = np.ones(len(values), bool)
        for word, bit in _places(values.to_numpy(zero_copy_only=False).view(np.uint64), 64 * len(shared.value)):
            out &= (shared.value[word] & bit) != 0
        return pa.array(out)

    return df.filter(has(hashes))
