"""Bit tables: filled by a distributed aggregation, probed inside expressions from one binary literal.

A byte of the literal holds seven bits, so that a byte is a character below 128 and a probe needs no table and no join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one table: 19 MB of the plan at most.
MAX_BITS = 1 << 27
_CHUNK = 32768


@dataclass(frozen=True)
class BitTable:
    """A Bloom filter of ``size`` bits with ``hashes`` probes per key."""

    literal: bytes
    size: int
    hashes: int
    salt: int

    def hit(self, key: Column) -> Column:
        """Whether every probed bit of ``key`` is set; never false for a key that was put in."""
        test = F.lit(True)
        for i in range(self.hashes):
            at = _position(key, self.salt, i, self.size)
            byte = F.ascii(F.substring(F.lit(self.literal), F.call_function("div", at, F.lit(7)).cast("int") + 1, 1).cast("string"))
            test = test & (F.call_function("shiftright", byte, (at % 7).cast("int")).bitwiseAND(F.lit(1)) != 0)
        return test


def _position(key: Column, salt: int, i: int, size: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt), F.lit(i)), F.lit(size).cast("long"))


def fill(keys: DataFrame, bits: int, hashes: int, salt: int = 1, key: str = "key") -> BitTable:
    """The table of a column of keys.  Only its bits come to the driver, in pieces of 4 kB: at most ``MAX_BITS``, whatever the keys' number."""
    size = min(MAX_BITS, max(64, int(bits)))
    at = keys.select(F.explode(F.array(*[_position(F.col(key), salt, i, size) for i in range(hashes)])).alias("at"))
    pieces = at.groupBy(F.call_function("div", F.col("at"), F.lit(_CHUNK)).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits"))
    filled = np.zeros(-(-size // _CHUNK) * _CHUNK, np.uint8)
    for piece, found in pieces.collect():
        filled[piece * _CHUNK : (piece + 1) * _CHUNK] = np.unpackbits(np.frombuffer(bytes(found), np.uint8), bitorder="little")[:_CHUNK]
    filled = np.r_[filled, np.zeros(-len(filled) % 7, np.uint8)].reshape(-1, 7)
    return BitTable((filled << np.arange(7, dtype=np.uint8)).sum(1, dtype=np.uint8).tobytes(), size, hashes, salt)
