"""A set of keys as a bitmap of fixed size, to drop rows before a shuffle.

The bitmap may let a row pass that is not in the set, never the other way round,
so a join that follows decides. Its size does not depend on the data: a very large
set only makes it useless. It is built by grouped bitmap aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base-two logarithm of the number of bits: 8 MB.
BITS = 26

_BUCKET = 32768  # bits in one of Spark's bitmaps


def sieve_of(keys: DataFrame, column: str) -> Broadcast:
    """Bitmap over the low bits of the long ``column``; null is never a member."""
    place = F.pmod(F.col(column), F.lit(1 << BITS))
    parts = (
        keys.where(F.col(column).isNotNull())
        .select(F.floor(place / _BUCKET).cast("int").alias("part"), (place % _BUCKET).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()  # at most 2 ** BITS / _BUCKET bitmaps
    )
    whole = np.zeros(1 << (BITS - 3), np.uint8)
    for r in parts:
        low = r["part"] * (_BUCKET // 8)
        whole[low : low + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(whole)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``keys`` may be members."""
    place = keys.view(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def sifted(frame: DataFrame, column: str, sieve: Broadcast) -> DataFrame:
    """The rows of ``frame`` whose long ``column`` may be a member."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(column)
            found = passes(sieve.value, keys.fill_null(0).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(found & keys.is_valid().to_numpy(zero_copy_only=False)))

    return frame.mapInArrow(sift, frame.schema)
