"""A set of 64-bit keys as a bitmap of fixed size: tells most keys that are not in the set, and never loses one that is.

Tasks use it to drop rows before a shuffle; an exact join follows. Its size doesn't depend on the number of keys, so it
can be sent to every executor. With very many keys it lets more rows through, and only that.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
BUCKET_BITS = 1 << 15  # of one bitmap of Spark's bitmap functions


def key_bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """8 MB of bits, whatever the number of keys: at most ``BITS / BUCKET_BITS`` rows of 4 KB come to the driver."""
    bit = F.pmod(column, F.lit(BITS)) + 1
    parts = keys.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    bitmap = np.zeros(BITS // 8, np.uint8)
    for bucket, bits in parts.collect():
        piece = np.frombuffer(bytes(bits), np.uint8)
        start = (bucket - 1) * (BUCKET_BITS // 8)
        bitmap[start : start + len(piece)] |= piece
    return bitmap


def maybe_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys.view(np.uint64) & np.uint64(BITS - 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
