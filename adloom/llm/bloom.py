"""Bloom filters of a fixed size: rows that surely have no partner are left out before a shuffle.

The filter has 2^log_bits bits however many keys there are, so it may go to
every task. What it lets through is always joined exactly afterwards; a filter
that is full costs shuffle, never results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BUCKET = 32768  # bits of one value of bitmap_construct_agg
LOG_BITS = 25
#: Bits of a key that choose its positions.
SHIFTS = (0, 21, 38)


def build(keys: DataFrame, key: str, log_bits: int = LOG_BITS) -> np.ndarray:
    """The bits, packed, of all values of the long column ``key``, whose bits must be well spread (a 64-bit hash)."""
    mask = (1 << log_bits) - 1
    places = F.array(*[F.shiftrightunsigned(F.col(key), s).bitwiseAND(F.lit(mask)) + 1 for s in SHIFTS])
    bits = keys.where(F.col(key).isNotNull()).select(F.explode(places).alias("p"))
    rows = (
        bits.groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        .collect()  # 2^log_bits / 8 bytes at most
    )
    packed = np.zeros((1 << log_bits) // 8, np.uint8)
    for row in rows:
        at = (row.bucket - 1) * BUCKET // 8
        packed[at : at + BUCKET // 8] = np.frombuffer(row.bits, np.uint8)
    return packed


def maybe(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter."""
    mask = np.uint64(len(packed) * 8 - 1)
    keys = keys.astype(np.uint64, copy=False)
    out = np.ones(len(keys), bool)
    for s in SHIFTS:
        place = (keys >> np.uint64(s)) & mask
        out &= (packed[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return out


def may_match(packed: np.ndarray, key: Column) -> Column:
    """Condition on a long column of well-spread keys; only this column goes to Python."""

    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        return pd.Series(maybe(packed, keys.to_numpy(np.int64).view(np.uint64)))

    return test(key)
