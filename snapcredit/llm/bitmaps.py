"""Membership bitmaps: which values of a distributed table were met, in a broadcast whose size follows their number."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per value, and the smallest size as a power of two (128 KB).
PER_VALUE, LEAST_BITS = 16, 20
#: The largest size, 64 MB. A bitmap of more values is fuller and lets more through; it never loses one.
MOST_BITS = 29
#: Cells of one bitmap of Spark's bitmap functions.
BITMAP = 32_768


class Bitmap:
    """Two bits for each value of `width` bits: one chosen by its high and one by its low bits."""

    def __init__(self, data: bytes, bits: int, width: int):
        self.data, self.bits, self.width = data, bits, width

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Whether both bits of each value are set."""
        data = np.frombuffer(self.data, np.uint8)
        found = np.ones(len(values), bool)
        for cell in (values >> (self.width - self.bits), values & ((1 << self.bits) - 1)):
            found &= (data[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return found


def bitmap_of(values: DataFrame, column: str, width: int, most_bits: int = MOST_BITS) -> Bitmap:
    """Bitmap of the distinct values of a column of longs below 2 ** width; at most 2 ** most_bits bits reach the driver."""
    bits = min(max(LEAST_BITS, (max(1, values.count() * PER_VALUE) - 1).bit_length()), most_bits, width)
    cells = F.array(F.shiftright(column, width - bits), F.col(column).bitwiseAND(F.lit((1 << bits) - 1)))
    cell = F.col("cell") + 1  # Spark's bitmap functions number values from 1
    maps = (
        values.select(F.explode(cells).alias("cell"))
        .groupBy(F.bitmap_bucket_number(cell).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"))
    )
    merged = bytearray((1 << bits) // 8 + BITMAP // 8)
    for row in maps.toLocalIterator():
        merged[(row["bucket"] - 1) * BITMAP // 8 : row["bucket"] * BITMAP // 8] = row["bits"]
    return Bitmap(bytes(merged), bits, width)
