"""A Bloom filter of 64-bit keys that is small enough to send to every task.

It never misses a key and lets a few others through, so whatever passes is joined exactly afterwards: the filter spares
shuffles, no result depends on it.  It has 16 bits a key and at most ``2 ** FILTER_BITS`` bits (16 MB); beyond that it lets
more through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.textkit import mix64

FILTER_BITS = 27
KEY_BITS = 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Bloom:
    """A set of keys with two bits a key."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data.view(np.uint64)

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        one = mix64(keys.view(np.uint64) + _STEP)
        mask = np.uint64((1 << bits) - 1)
        return one & mask, mix64(one) & mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for p in self.places(keys, self.bits):
            out &= (self.data[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def bloom_of(keys: DataFrame, column: str) -> Bloom:
    """The filter of a bigint column without nulls."""
    n = keys.count()
    bits = min(FILTER_BITS, max(13, (n * KEY_BITS - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = np.unique(np.concatenate(Bloom.places(b.column(0).to_numpy(), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((both >> np.uint64(6)).astype(np.int64)),
                                              pa.array((np.uint64(1) << (both & np.uint64(63))).view(np.int64))], names=["at", "bit"])

    table = keys.select(column).mapInArrow(places, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    data = np.zeros(1 << (bits - 6), dtype=np.int64)
    data[table.column("at").to_numpy()] = table.column("bit").to_numpy()
    return Bloom(bits, data)
