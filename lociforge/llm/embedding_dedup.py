"""Near-duplicate embeddings: Euclidean p-stable hashing of normalised vectors, then exact cosines.

A table takes ``m`` random projections of the unit vector, shifts and quantises them with width ``WIDTH``; vectors with equal codes (and equal
labels) share a bucket.  For unit vectors a cosine is a distance, so the chance that a pair at the threshold meets in one of the
tables is known: ``m`` grows with the logarithm of the rows, so that far vectors seldom meet, and the number of tables is what
keeps the chance of missing a pair at the very threshold below ``MISS`` (closer pairs: far below).

Equal vectors are one class.  A bucket's classes are compared by matrix products; a pair counts in the first table in which it
meets, so links are counted without being written out.  A large bucket is cut into parts and each two parts meet in their own task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociforge.llm import textkit
from lociforge.llm.components import connected_components
from lociforge.llm.storage import materialize

THRESHOLD = 0.93
WIDTH = 1.2
MISS = 0.003
#: Classes of one bucket that meet in a task, and of a tile of a matrix product.
PART, TILE = 2048, 256
#: Buckets up to this size are compared pair by offset, many buckets at once.
SMALL = 48


def collision(distance: float, width: float) -> float:
    """The chance that one quantised Gaussian projection agrees for two points at this distance."""
    c = width / distance
    return 1 - math.erfc(c / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


@dataclass(frozen=True)
class Tables:
    """``tables`` hash tables of ``m`` projections each; the same on every machine, for every vector length."""

    m: int
    tables: int
    seed: int = 7

    @staticmethod
    def planned(rows: int, threshold: float) -> Tables:
        """For so many vectors of one label."""
        far, near = collision(math.sqrt(2), WIDTH), collision(math.sqrt(2 - 2 * threshold), WIDTH)
        m = min(24, max(3, math.ceil(math.log(max(rows, 2)) / math.log(1 / far))))
        return Tables(m, math.ceil(math.log(MISS) / math.log(1 - near**m)))

    def keys(self, unit: np.ndarray, label: np.ndarray) -> np.ndarray:
        """A 64-bit bucket key of each vector in each table."""
        d = unit.shape[1]
        rng = np.random.default_rng((self.seed, d))
        planes = rng.standard_normal((d, self.tables * self.m))
        shift = rng.uniform(0, WIDTH, self.tables * self.m)
        odd = rng.integers(1, 2**62, self.tables * self.m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        out = np.zeros((len(unit), self.tables), np.uint64)
        for lo in range(0, len(unit), 4096):
            codes = np.floor((unit[lo : lo + 4096] @ planes + shift) / WIDTH).astype(np.int64).view(np.uint64)
            out[lo : lo + 4096] = (codes * odd).reshape(len(codes), self.tables, self.m).sum(2, dtype=np.uint64)
        out += textkit.mix(label.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d))[:, None]
        return textkit.mix(out + np.arange(self.tables, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).view(np.int64)


def _vectors(table, kind: str) -> np.ndarray:
    """Unit vectors of a binary column, as rows; all have one length."""
    raw = np.stack([np.frombuffer(x, kind) for x in table.column("vec").to_pylist()]).astype(np.float64)
    with np.errstate(over="ignore", under="ignore"):
        norm = np.linalg.norm(raw, axis=1, keepdims=True)
        odd = np.flatnonzero(~np.isfinite(norm[:, 0]) | (norm[:, 0] < 1e-150))  # squares out of range: scaled first
        if len(odd):
            raw[odd] /= np.abs(raw[odd]).max(1, keepdims=True)
            norm[odd] = np.linalg.norm(raw[odd], axis=1, keepdims=True)
    return raw / norm


def _checked(vectors: DataFrame, kind: str, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, dim, sig, vec); sig and vec are null for what links with nothing."""
    odd = np.random.default_rng(11).integers(1, 2**62, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, labels = batch.columns
            n = len(batch)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            first = np.r_[0, np.cumsum(size)]
            fits = ~labels.is_null().to_numpy(zero_copy_only=False)
            of = pc.fill_null(labels, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            sig, vec = np.zeros(n, np.int64), np.full(n, None, object)
            for d in np.unique(size):
                rows = np.flatnonzero((size == d) & fits)
                if d == 0:
                    fits[rows] = False
                    continue
                x = flat[first[rows][:, None] + np.arange(d)] + 0.0
                good = np.isfinite(x).all(1) & (x != 0).any(1)
                fits[rows[~good]] = False
                rows, x = rows[good], x[good]
                # the multipliers repeat for vectors beyond 65,536 components, with the place mixed in
                bits = textkit.mix(x.view(np.uint64) + np.arange(d, dtype=np.uint64)) * odd[np.arange(d) % len(odd)]
                mixed = bits.sum(1, dtype=np.uint64) + textkit.mix(of[rows].view(np.uint64) + np.uint64(d))
                sig[rows] = textkit.mix(mixed).view(np.int64)
                for r, v in zip(rows, x.astype(kind), strict=True):
                    vec[r] = v.tobytes()
            yield pa.RecordBatch.from_arrays([ids, labels.cast(pa.int64()), pa.array(size, pa.int32()), pa.array(sig, pa.int64(), mask=~fits), pa.array(vec, pa.binary())], ["vec_id", "label", "dim", "sig", "vec"])

    columns = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("long").alias("label"))
    return columns.mapInArrow(run, "vec_id long, label long, dim int, sig long, vec binary")


def _by_length(table: pa.Table) -> Iterator[pa.Table]:
    dims = table.column("dim").to_numpy()
    for d in np.unique(dims):
        yield table.filter(pa.array(dims == d)) if (dims != d).any() else table


def _bucket_rows(classes: DataFrame, tables: Tables, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(pa.Table.from_batches([batch])) if len(batch) else ():
                keys = tables.keys(_vectors(part, kind), part.column("label").to_numpy())
                sig = np.repeat(part.column("sig").to_numpy(), tables.tables)
                no = np.tile(np.arange(tables.tables, dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(no), pa.array(sig)], ["key", "table", "sig"])

    return classes.select("sig", "label", "dim", "vec").mapInArrow(run, "key long, table int, sig long")


class _Task:
    """Counts links and joins components among the classes of some buckets."""

    def __init__(self, table: pa.Table, tables: Tables, kind: str, threshold: float):
        self.sig, self.cnt, self.no = (table.column(c).to_numpy() for c in ("sig", "cnt", "table"))
        self.unit, self.label = _vectors(table, kind), table.column("label").to_numpy()
        self.tables, self.threshold = tables, threshold
        self.links = np.zeros(len(self.sig), np.int64)
        self.edges: list[np.ndarray] = []

    def found(self, i: np.ndarray, j: np.ndarray) -> None:
        """Takes the linked pairs of rows that meet here first."""
        if not len(i):
            return
        rows, at = np.unique(np.r_[i, j], return_inverse=True)
        keys = self.tables.keys(self.unit[rows], self.label[rows])
        a, b = keys[at[: len(i)]], keys[at[len(i) :]]
        first = np.argmax(a == b, axis=1) == self.no[i]
        i, j = i[first], j[first]
        np.add.at(self.links, i, self.cnt[j])
        np.add.at(self.links, j, self.cnt[i])
        if len(i):
            self.edges.append(self.spanning(i, j))

    def spanning(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Few edges that connect what these pairs connect: every node's smallest partner, until nothing changes."""
        kept = []
        a, b = np.minimum(i, j), np.maximum(i, j)
        while len(a):
            order = np.lexsort((a, b))
            a, b = a[order], b[order]
            head = np.r_[True, b[1:] != b[:-1]]
            kept.append(np.stack([a[head], b[head]], 1))
            to = a[head][np.cumsum(head) - 1]  # b's smallest partner now stands for b
            a, b = np.minimum(a, to), np.maximum(a, to)
            a, b = a[a != b], b[a != b]
            if len(a):
                pair = np.unique(np.stack([a, b], 1), axis=0)
                a, b = pair[:, 0], pair[:, 1]
        return np.concatenate(kept)

    def small(self, rows: np.ndarray, bucket: np.ndarray) -> None:
        """Rows sorted by bucket, all buckets small: compares each row with the ones after it."""
        for step in range(1, SMALL):
            i = np.flatnonzero(bucket[step:] == bucket[:-step])
            if not len(i):
                break
            for lo in range(0, len(i), 1 << 14):
                a, b = rows[i[lo : lo + (1 << 14)]], rows[i[lo : lo + (1 << 14)] + step]
                near = np.einsum("ij,ij->i", self.unit[a], self.unit[b]) >= self.threshold
                self.found(a[near], b[near])

    def large(self, rows: np.ndarray, side: np.ndarray | None) -> None:
        keys = self.tables.keys(self.unit[rows], self.label[rows])[:, : self.no[rows[0]]]
        for x in range(0, len(rows), TILE):
            for y in range(x, len(rows), TILE):
                a, b = slice(x, x + TILE), slice(y, y + TILE)
                both = np.r_[keys[a], keys[b]]
                if both.shape[1] and (both == both[0]).all(0).any():
                    continue  # all of them met in an earlier table
                near = self.unit[rows[a]] @ self.unit[rows[b]].T >= self.threshold
                if x == y:
                    near = np.triu(near, 1)
                if side is not None:
                    near &= side[a][:, None] != side[b][None, :]
                i, j = np.nonzero(near)
                self.found(rows[a][i], rows[b][j])


def _compare(rows: DataFrame, tables: Tables, kind: str, threshold: float) -> DataFrame:
    """(a, b, n): edges (n null) and counts of links (b null)."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for part in _by_length(table):
            task = _Task(part, tables, kind, threshold)
            bucket = part.column("bucket").to_numpy()
            side = part.column("side").to_numpy()
            order = np.lexsort((task.sig, bucket))
            sizes = np.diff(np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True]))
            size = np.repeat(sizes, sizes)
            low = order[size <= SMALL]
            low = low[side[low] < 0]
            task.small(low, bucket[low])
            high = order[(size > SMALL) | (side[order] >= 0)]
            for rows in np.split(high, np.flatnonzero(np.diff(bucket[high])) + 1):
                if len(rows) > 1:
                    task.large(rows, side[rows] if (side[rows] >= 0).any() else None)
            some = np.flatnonzero(task.links)
            out.append((task.sig[some], task.sig[some], task.links[some], True))
            for e in task.edges:
                out.append((task.sig[e[:, 0]], task.sig[e[:, 1]], np.zeros(len(e), np.int64), False))
        a, b, n = (np.concatenate([x[k] for x in out] or [np.zeros(0, np.int64)]) for k in range(3))
        counts = np.concatenate([np.full(len(x[0]), x[3]) for x in out] or [np.zeros(0, bool)])
        return pa.Table.from_arrays([pa.array(a), pa.array(b, mask=counts), pa.array(n, mask=~counts)], ["a", "b", "n"])

    return rows.groupBy("task").applyInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Two rows link when their labels are equal and not null and their vectors' cosine, in double precision, is at least ``threshold``.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of different
    lengths.  n_links counts the other rows linked directly (repeated rows included), component_id is the smallest vec_id reachable,
    kept marks the rows that have it.
    """
    item = vectors.schema[embedding].dataType.elementType
    kind = "<f4" if isinstance(item, T.FloatType) else "<f8"
    rows = materialize(_checked(vectors, kind, vec_id, embedding, label), "vec-rows")
    groups = rows.where("sig is not null").groupBy("sig").agg(F.min("vec_id").alias("rep"), F.count("*").alias("cnt"), F.min("label").alias("of"))
    most = groups.groupBy("of").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    tables = Tables.planned(most[0] or 1, threshold)
    one = rows.where("sig is not null").select("sig", F.col("vec_id").alias("rep"), "label", "dim", "vec")
    alone = groups.select(F.col("sig").alias("_sig"), F.col("rep").alias("_rep"), "cnt")
    classes = one.join(alone, (F.col("sig") == F.col("_sig")) & F.col("rep").eqNullSafe(F.col("_rep"))).select("sig", "rep", "cnt", "label", "dim", "vec")
    classes = materialize(classes.dropDuplicates(["sig"]), "vec-classes")
    buckets = _bucket_rows(classes, tables, kind)
    shared = buckets.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = buckets.join(shared, "key").join(classes.select("sig", "cnt", "label", "dim", "vec"), "sig")
    tasks = max(64, (most[1] or 0) * tables.tables // 32768)
    cuts = F.ceil(F.col("size") / PART).cast("int")
    whole = met.where(cuts == 1).select(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task"), F.col("key").alias("bucket"), "table", "sig", "cnt", "label", "dim", "vec", F.lit(-1).alias("side"))
    parted = met.where(cuts > 1).withColumn("own", F.pmod(F.xxhash64("sig", F.lit(5)), cuts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    parted = parted.select(pair.alias("task"), pair.alias("bucket"), "table", "sig", "cnt", "label", "dim", "vec", F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    found = materialize(_compare(whole.unionAll(parted), tables, kind, threshold), "vec-links")
    labels = connected_components(found.where("n is null"), "a", "b")
    counts = found.where("b is null").groupBy(F.col("a").alias("sig")).agg(F.sum("n").alias("n"))
    grouped = classes.select("sig", "rep", "cnt").join(labels.withColumnRenamed("node", "sig").withColumnRenamed("label", "to"), "sig", "left").join(counts, "sig", "left")
    grouped = grouped.select("sig", "rep", F.coalesce("to", "sig").alias("to"), (F.coalesce("n", F.lit(0)) + F.col("cnt") - 1).alias("n_links"))
    smallest = grouped.groupBy("to").agg(F.min("rep").alias("component_id"))
    by_class = grouped.join(smallest, "to").select("sig", "n_links", "component_id")
    out = rows.select("vec_id", "sig").join(by_class, "sig", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
