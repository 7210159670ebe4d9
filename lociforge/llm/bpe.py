"""Byte-level BPE by a rank file: encoding as a tree reduction over a monoid of token sequences, and decoding.

A text's pieces (matches of the splitting pattern) are encoded separately.  Within a piece, sequences of tokens form a monoid:
``join`` of the encodings of two neighbours is the encoding of their bytes put together.  ``join`` re-encodes a window around
the seam and doubles it until the window's outer tokens come out unchanged: a sequence is an encoding exactly when each two
adjacent tokens are the encoding of their own bytes, and then every adjacent pair lies in one of the two old encodings or in the
window's.  Pieces are halved recursively down to ``LEAF`` bytes and joined up the tree; decoding puts byte strings together up such a tree.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.llm.worker import tidy_call

#: Bytes of a piece that are merged directly, and tokens that are decoded directly; all above goes through the tree.
LEAF = 16
#: Bytes of the pieces whose ids are kept.
SHORT = 48
#: Bytes of a rank file that may be sent to the executors.
MAX_FILE = 16 << 20
#: Pieces whose ids a Python worker keeps, twice: when a generation is full, the one before it goes.
CACHE = 200_000
#: The same where a worker has other stages' memory beside it.
SMALL_CACHE = 50_000
#: Texts of a batch that are Python strings at once.
SLICE = 256


class ByteBPE:
    """A vocabulary: ``ranks`` of byte strings, the lower the earlier merged; ``pattern`` splits texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = CACHE):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for b, i in ranks.items():
            self.token[i] = b
        self.single = [ranks.get(bytes([i]), -1) for i in range(256)]
        self.pairs: dict[int, int] = {}
        for b, i in ranks.items():
            for k in range(1, len(b)):
                left, right = ranks.get(b[:k]), ranks.get(b[k:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = i
        self.cache = cache
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def leaf(self, piece: bytes) -> list[int]:
        """Merges the adjacent pair of the lowest rank, the leftmost first, until none is in the vocabulary."""
        got = self.ranks.get(piece)
        if got is not None:
            return [got]
        ids = [self.single[b] for b in piece]
        pairs, none = self.pairs, 1 << 62
        rank = [pairs.get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while rank:
            best = min(rank)
            if best == none:
                break
            i = rank.index(best)
            ids[i : i + 2] = [best]
            del rank[i]
            if i:
                rank[i - 1] = pairs.get(ids[i - 1] << 32 | best, none)
            if i < len(rank):
                rank[i] = pairs.get(best << 32 | ids[i + 1], none)
        return ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the two encodings' bytes put together."""
        if not left or not right:
            return left or right
        a = b = 2
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = left[len(left) - a :] + right[:b]
            ids = self.leaf(b"".join([self.token[i] for i in window]))
            left_holds = a == len(left) or ids[0] == window[0]
            right_holds = b == len(right) or ids[-1] == window[-1]
            if left_holds and right_holds:
                return left[: len(left) - a] + ids + right[b:]
            a, b = (a if left_holds else 2 * a), (b if right_holds else 2 * b)

    def encode_piece(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.leaf(piece)
        if piece in self.ranks:
            return [self.ranks[piece]]
        half = len(piece) // 2
        return self.join(self.encode_piece(piece[:half]), self.encode_piece(piece[half:]))

    def _missed(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", self.encode_piece(piece.encode())).tobytes()
        if len(self.kept) >= self.cache:
            self.older, self.kept = self.kept, {}
        if len(piece) <= SHORT:
            self.kept[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        get, missed = self.kept.get, self._missed
        return b"".join([get(p) or missed(p) for p in self.split(text)])  # a piece has at least one id

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens: those of ``LEAF`` tokens at a time, then each two neighbours, up a tree."""
        token, all_ids = self.token, np.frombuffer(ids, "<u4").tolist()
        level = [b"".join([token[i] for i in all_ids[at : at + LEAF]]) for at in range(0, len(all_ids), LEAF)]
        while len(level) > 1:
            level = [b"".join(level[at : at + 2]) for at in range(0, len(level), 2)]
        return level[0] if level else b""


@lru_cache(maxsize=2)
def _parsed(content: bytes, pattern: str, cache: int) -> ByteBPE:
    return ByteBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}, pattern, cache)


class Tokenizer:
    """A rank file read once on the driver and sent to the executors as bytes (of a checked size), with the splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.content, self.pattern = f.read(MAX_FILE + 1), pattern
        if len(self.content) > MAX_FILE:
            raise ValueError(f"{path} has more than {MAX_FILE} bytes")

    def local(self, cache: int = CACHE) -> ByteBPE:
        return _parsed(self.content, self.pattern, cache)


def _strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def encode(tokenizer: Tokenizer, text: Column) -> Column:
    """Ids of each whole text (null: of the empty one, none) as binary: little-endian unsigned 32-bit integers."""

    def run(column: pa.Array) -> pa.Array:
        bpe = tokenizer.local()
        return pa.array([bpe.encode(x) for x in _strings(column)], pa.binary())

    return F.arrow_udf(run, "binary")(text)


def decode(tokenizer: Tokenizer, ids: Column) -> Column:
    """The bytes that ``encode`` saw, as binary; null ids have none."""

    def run(column: pa.Array) -> pa.Array:
        bpe = tokenizer.local()
        return pa.array([bpe.decode(x or b"") for x in column.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(ids)


def encode_digest(tokenizer: Tokenizer, text: Column) -> Column:
    """``struct<n_tokens, ids_sha256, decoded_sha256>`` of each text's round trip, without sending ids to the JVM."""

    def run(column: pa.Array) -> pa.Array:
        bpe, out = tokenizer.local(), []
        for x in _strings(column):
            ids = bpe.encode(x)
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
        n, a, b = zip(*out, strict=True) if out else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.arrow_udf(run, "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")(text)


def encode_documents(docs: DataFrame, tokenizer: Tokenizer, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (as ``encode`` gives them), ``n_tokens`` and ``lossless`` in place of columns of those names.

    ``lossless``: decoding the ids gives the text's bytes again.  Every row and other column stays; null texts have no ids.
    """

    def run(column: pa.Array) -> pa.Array:
        bpe, parts = tokenizer.local(SMALL_CACHE), [pa.array([], pa.binary())]
        same: list[bool] = []
        for at in range(0, len(column), SLICE):
            texts = _strings(column.slice(at, SLICE))
            ids = [bpe.encode(x) for x in texts]
            same += [bpe.decode(i) == x.encode() for i, x in zip(ids, texts, strict=True)]
            parts.append(pa.array(ids, pa.binary()))
        ids = pa.concat_arrays(parts)
        n = pc.divide(pc.binary_length(ids).cast(pa.int64()), 4)
        return pa.StructArray.from_arrays([ids, n, pa.array(same, pa.bool_())], ["ids", "n_tokens", "lossless"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("ids", "n_tokens", "lossless")]
    coded = F.arrow_udf(tidy_call(run), "struct<ids: binary, n_tokens: bigint, lossless: boolean>")(F.col(text))
    return docs.select(*kept, coded.alias("_coded")).select(*kept, "_coded.*")
