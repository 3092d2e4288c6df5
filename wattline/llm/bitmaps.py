"""Bit sets of fixed size, built by Spark and tested in numpy.

A set of up to 2^k positions is aggregated bucket by bucket (`bitmap_construct_agg`),
so what reaches the driver, and is broadcast, has the size of the bit set, whatever
the number of rows. A test can only err by answering yes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bucket of the bitmap functions.
BUCKET = 32_768


def bit_set(rows: DataFrame, position: Column, bits: int) -> np.ndarray:
    """The positions (from 0, below `bits`) of `rows` as packed bytes; `bits` is a multiple of 8."""
    at = rows.select((position + 1).cast("long").alias("at")).where("at is not null")
    made = (at.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())  # at most bits / BUCKET rows
    out = np.zeros(-(-bits // BUCKET) * BUCKET // 8, dtype=np.uint8)
    for r in made:
        first = (r["bucket"] - 1) * (BUCKET // 8)
        out[first:first + BUCKET // 8] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out[:-(-bits // 8)]


def holds(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each position is set."""
    at = at.astype(np.int64)
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x (uint64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
