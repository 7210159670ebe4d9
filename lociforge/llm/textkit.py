"""Vectorised words and hashes over the raw bytes of an Arrow string column.

Words are runs of bytes outside a separator table, A-Z lower-cased; separators are ASCII, so UTF-8 text splits at the same places as
its characters would.  A word's 64-bit hash comes from prefix sums of a random byte table times powers of an odd base (modulo
2**64), so all words of a chunk, and all their prefixes, are hashed without a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
#: Odd multipliers for the words of a shingle, by place.
_PLACE = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of text worked on at once; a longer text is one chunk of its own.
CHUNK = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII characters that are neither letters nor digits.
PUNCT = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalises hashes: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@dataclass
class Words:
    """The words of some texts.  ``first``: of text i are the words first[i] up to first[i + 1]."""

    rows: slice
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """Of whole words, or of their first ``longest`` bytes (shorter words: as a whole)."""
        ends = self.ends if longest is None else np.minimum(self.ends, self.starts + longest)
        return mix((self.sums[ends] - self.sums[self.starts]) * self.inverse[self.starts] + (ends - self.starts).astype(np.uint64))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, at


def words(column: pa.Array, separators: np.ndarray = WHITE, chunk: int = CHUNK) -> Iterator[Words]:
    """The words of every text of ``column``, some texts at a time, in order."""
    data, at = texts(column)
    n, lo = len(at) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + chunk, "right")) - 1)
        part = data[at[lo] : at[hi]]
        offsets = at[lo : hi + 1] - at[lo]
        size = max(chunk, len(part) + 1)
        power, inverse = _powers(chunk + 1) if size <= chunk else (f[: size + 1] for f in _powers.__wrapped__(size + 1))
        inside = ~separators[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(part), bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(part), bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_LOWER[part] * power[: len(part)], out=sums[1:])
        yield Words(slice(lo, hi), part, starts, ends, np.searchsorted(starts, offsets), sums, inverse)
        lo = hi


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Of each ``width`` consecutive word hashes; the whole sequence as one where it is shorter; none of none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(width, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out += hashes[i : n - k + 1 + i] * _PLACE[i]
    return mix(out + np.uint64(k))
