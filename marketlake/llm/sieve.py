"""A filter of bounded size for hashes that are frequent."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 26  # at most 8 MB


class Filter:
    """Which hashes may be frequent: one bit each, shared by all that fall on it."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        cell = hashes & self.mask
        return (self.words[cell >> np.uint64(6)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


def frequent_filter(frequent: DataFrame) -> Filter:
    """A filter of the hashes in ``frequent`` (one column of longs).

    32 bits a hash, but 8 MB at most whatever their number: a fuller filter lets more rare
    hashes pass to the next count, never a frequent one be lost. Bits are set in Spark; what is
    fetched are the words of the filter.
    """
    bits = min(max(12, (32 * frequent.count()).bit_length()), MOST_BITS)
    rows = (
        frequent.toDF("x")
        .select(
            F.expr(f"CAST(shiftrightunsigned(x & {(1 << bits) - 1}L, 6) AS INT)").alias("at"),
            F.expr("shiftleft(1L, CAST(x & 63L AS INT))").alias("bit"),
        )
        .groupBy("at")
        .agg(F.bit_or("bit").alias("word"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows.column("at").to_numpy()] = rows.column("word").to_numpy().view(np.uint64)
    return Filter(words)
