"""Fixed-size filters for ids or hashes, built by Spark, read in tasks.

A filter of 2^bits bits has the same size whatever the input; a fuller one
passes more rows, never fewer, so exact steps must follow.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB


def id_filter(df: DataFrame, key: Column, bits: int = BITS, spot: Column | None = None) -> np.ndarray:
    """Bitmap (uint8) of the hashed ``key`` of all rows, 2^bits bits. Spark
    builds it in blocks of 32,768 bits; the driver gets at most 2^bits bits."""
    spot = spot_of(key, bits) if spot is None else spot
    rows = (df.select((spot + 1).alias("spot"))  # the functions count from 1
            .groupBy(F.bitmap_bucket_number("spot").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect())
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        block = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["block"] - 1) * 4096:(r["block"] - 1) * 4096 + len(block)] = block
    return out


def spot_of(key: Column, bits: int = BITS) -> Column:
    """The bit of a key, to be sent along with the rows that are looked up."""
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def passes(bitmap: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (bitmap[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 == 1


def hash_filter(df: DataFrame, hashed: Column, bits: int = BITS) -> np.ndarray:
    """As ``id_filter``, for a bigint that is a mixed hash already: its low bits
    are the spot, which tasks take from their own hashes with ``low_spots``."""
    return id_filter(df, hashed, bits, hashed.bitwiseAND(F.lit((1 << bits) - 1)))


def low_spots(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)
