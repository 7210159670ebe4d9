"""N-gram Jaccard join: documents whose word-shingle sets overlap by 75 % or more, by count vectors in an R-tree.

1. Texts become sets of hashed shingles; documents with the same set are one class (its copies need no search).
2. Shingle hashes are dealt out by range, packed many to a row, and counted: those of one class only cannot be shared.
3. A class may lack at most a quarter of its shingles in any partner, so of its rarest ``quarter + 1`` shingles a partner holds one.
   Classes whose rarest are all their own have no partner; the others meet, per such shingle, the smallest class that has it.
   The components of these meetings are the blocks: every linked pair lies within one.
4. In a block the shingles are hashed into ``GROUPS`` groups; the counts are points of an R-tree.  The sum over groups of the smaller
   count bounds a pair's overlap, and with a node's upper corner that of all its points.  Nodes whose bound is too small, and nodes
   whose points are in the same component already, are cut; surviving pairs are verified exactly and united.
   A large block is cut into parts and each two parts meet in a task of their own, so a task's memory is bounded and no pair is missed.
5. Links found (a spanning set of each component) are contracted to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociforge.llm import textkit
from lociforge.llm.components import connected_components
from lociforge.llm.storage import materialize
from lociforge.llm.worker import tidy_batches, tidy_group

#: Percent of the union that linked sets share.
PERCENT = 75
WIDTH = 5
GROUPS = 32
LEAF = 32
#: Nodes below an inner node of the tree.
FAN = 4
#: Classes of one block that meet in a task.
PART = 512
#: Shingles held back by a mapper before it writes, and about as many in a range.
FLUSH, RANGE = 1 << 21, 1 << 21

SET_SCHEMA = "doc_id long, n_shingles long, sig long"


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for part in textkit.words(column):
        hashes = part.hashes()
        for a, b in zip(part.first[:-1], part.first[1:], strict=True):
            yield np.unique(textkit.shingles(hashes[a:b], WIDTH))


def _signature(found: np.ndarray) -> int:
    """64 bits that stand for the whole set."""
    mixed = textkit.mix(found ^ np.uint64(0xA5A5A5A55A5A5A5A))
    total = np.array([mixed.sum(dtype=np.uint64) + np.uint64(len(found))], np.uint64)
    return int(textkit.mix(total).view(np.int64)[0])


def _id_and_text(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))


def shingle_sets(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, sig) of each row; sig is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig = [], []
            for found in _sets(batch.column(1)):
                n.append(len(found))
                sig.append(_signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64())], ["doc_id", "n_shingles", "sig"])

    return _id_and_text(docs, doc, text).mapInArrow(tidy_batches(run), SET_SCHEMA)


def _pack(values: list[np.ndarray]) -> list[bytes]:
    return [v.tobytes() for v in values]


def _dealt(docs: DataFrame, ranges: int, doc: str, text: str) -> DataFrame:
    """Packed shingles by range: each mapper writes a row per range and flush, holding (class, its size, its shingles there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            token = np.concatenate(held)
            held.clear()
            sig = np.array([o[0] for o in owners], np.int64)
            n = np.array([o[1] for o in owners], np.int32)
            at = ((token >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            token, owner, at = token[order], np.repeat(np.arange(len(owners), dtype=np.int32), n)[order], at[order]
            del order
            cut = np.flatnonzero(np.diff(at)) + 1
            rows = []
            for t, o, a in zip(np.split(token, cut), np.split(owner, cut), at[np.r_[0, cut]], strict=True):
                own, count = np.unique(o, return_counts=True)
                rows.append((int(a), t.astype(np.uint32).tobytes(), (t >> np.uint64(32)).astype(np.uint16).tobytes(), sig[own].tobytes(), n[own].tobytes(), count.astype(np.int32).tobytes()))
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], ["part", "low", "high", "sig", "n", "count"])

        for batch in batches:
            for found in _sets(batch.column(1)):
                if not len(found) or (sig := _signature(found)) in seen:
                    continue
                if len(seen) < 4_000_000:  # copies in one partition go once; beyond, the reducer drops them
                    seen.add(sig)
                held.append(found)
                owners.append((sig, len(found)))
                size += len(found)
                if size >= FLUSH:
                    yield flush()
                    held, owners, size = [], [], 0
        if held:
            yield flush()

    return _id_and_text(docs, doc, text).mapInArrow(tidy_batches(run), "part int, low binary, high binary, sig binary, n binary, count binary")


def _unpacked(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared(dealt: DataFrame, parts: int) -> DataFrame:
    """Of each range, the shingles of two classes or more, packed by ``parts`` parts of the classes."""

    def run(table: pa.Table) -> pa.Table:
        token = _unpacked(table, "low", np.uint32).astype(np.uint64) | _unpacked(table, "high", np.uint16).astype(np.uint64) << np.uint64(32)
        sig, n, count = _unpacked(table, "sig", np.int64), _unpacked(table, "n", np.int32), _unpacked(table, "count", np.int32)
        range_no = table.column("part")[0].as_py()
        own = np.repeat(np.arange(len(sig)), count)
        order = np.lexsort((sig[own], token))
        token, own = token[order], own[order]
        same = np.zeros(len(token), bool)
        same[1:] = (token[1:] == token[:-1]) & (sig[own[1:]] == sig[own[:-1]])
        token, own = token[~same], own[~same]
        cut = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        df = np.repeat(np.diff(np.r_[cut, len(token)]), np.diff(np.r_[cut, len(token)]))
        keep = df > 1
        token, own, df = token[keep] | np.uint64(range_no) << np.uint64(48), own[keep], df[keep]
        owner = sig[own]
        part = textkit.mix(owner.view(np.uint64)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.diff(part[order])) + 1
        rows = [(int(part[i[0]]), token[i].tobytes(), owner[i].tobytes(), n[own[i]].tobytes(), np.minimum(df[i], 2**31 - 1).astype(np.int32).tobytes()) for i in np.split(order, cut) if len(i)]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], ["part", "token", "sig", "n", "df"])

    return dealt.groupBy("part").applyInArrow(tidy_group(run), "part int, token binary, sig binary, n binary, df binary")


def _survivors(shared: DataFrame) -> DataFrame:
    """Classes that may have a partner: their shared shingles (sorted) and the rare ones among which a partner must be."""

    def run(table: pa.Table) -> pa.Table:
        token, sig = _unpacked(table, "token", np.uint64), _unpacked(table, "sig", np.int64)
        n, df = _unpacked(table, "n", np.int32), _unpacked(table, "df", np.int32)
        order = np.lexsort((token, df, sig))
        token, sig, n = token[order], sig[order], n[order]
        cut = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        out: list[list] = [[], [], [], []]
        for a, b in zip(cut, np.r_[cut[1:], len(sig)], strict=True):
            size = int(n[a])
            # at most size * (100 - PERCENT) / 100 shingles are missing in a partner; the unshared ones come first in the order
            rare = size * (100 - PERCENT) // 100 + 1 - (size - (b - a))
            if rare > 0:
                out[0].append(int(sig[a]))
                out[1].append(size)
                out[2].append(token[a : a + rare].view(np.int64).tolist())
                out[3].append(np.sort(token[a:b]).tobytes())
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())], ["sig", "n", "rare", "shared"])

    return shared.groupBy("part").applyInArrow(tidy_group(run), "sig long, n int, rare array<long>, shared binary")


class _Block:
    """Classes of one block in an R-tree over their count vectors, with their exact sets and a union-find."""

    def __init__(self, sig: np.ndarray, n: np.ndarray, sets: list[np.ndarray], half: np.ndarray | None):
        points = np.zeros((len(sig), GROUPS), np.int32)
        for i, s in enumerate(sets):
            points[i] = np.bincount((textkit.mix(s) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
        # bulk load: by size, then within runs by the coordinate sums of half the groups
        run = np.argsort(np.argsort(n, kind="stable")) // (LEAF * 8)
        order = np.lexsort((points[:, : GROUPS // 2].sum(1), run))
        self.sig, self.n, self.points = sig[order], n[order].astype(np.int64), points[order]
        self.sets = [sets[i] for i in order]
        self.half = None if half is None else half[order]
        self.root = np.arange(len(sig))
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def verify(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return 100 * both >= PERCENT * (self.n[i] + self.n[j] - both)

    def join(self) -> list[tuple[int, int]]:
        """Links that connect whatever verified pairs connect."""
        size = len(self.sig)
        starts = np.arange(0, size, LEAF)
        # the tree, from the leaves up: of each node the upper corner of its points and its smallest set
        levels = [(np.maximum.reduceat(self.points, starts, axis=0), np.minimum.reduceat(self.n, starts))]
        while len(levels[-1][1]) > 1:
            high, small = levels[-1]
            cut = np.arange(0, len(small), FAN)
            levels.append((np.maximum.reduceat(high, cut, axis=0), np.minimum.reduceat(small, cut)))
        pairs = [(len(levels) - 1, 0, 0)]
        while pairs:
            level, x, y = pairs.pop()
            if level < 0:
                self._leaves(starts[x], min(size, starts[x] + LEAF), starts[y], min(size, starts[y] + LEAF))
                continue
            high, small = levels[level]
            # a pair shares PERCENT of the union: (100 + PERCENT) * overlap >= PERCENT * (sizes)
            if (100 + PERCENT) * np.minimum(high[x], high[y]).sum() < PERCENT * (small[x] + small[y]):
                continue
            if level == 0:
                pairs.append((-1, x, y))
                continue
            below = len(levels[level - 1][1])
            left, right = range(x * FAN, min(below, (x + 1) * FAN)), range(y * FAN, min(below, (y + 1) * FAN))
            pairs += [(level - 1, i, j) for i in reversed(left) for j in reversed(right) if x != y or i <= j]
        return [(int(self.sig[i]), int(self.sig[j])) for i, j in self.links]

    def _leaves(self, a: int, b: int, c: int, d: int) -> None:
        roots = np.array([self.find(i) for i in range(a, b)])
        others = roots if a == c else np.array([self.find(i) for i in range(c, d)])
        if (roots == roots[0]).all() and (others == roots[0]).all():
            return
        bound = np.minimum(self.points[a:b, None], self.points[None, c:d]).sum(2)
        fits = ((100 + PERCENT) * bound >= PERCENT * (self.n[a:b, None] + self.n[None, c:d])) & (roots[:, None] != others[None, :])
        if a == c:
            fits &= np.arange(a, b)[:, None] < np.arange(c, d)[None, :]
        if self.half is not None:
            fits &= self.half[a:b, None] != self.half[None, c:d]
        pairs = np.argwhere(fits)
        for i, j in pairs[np.argsort(-bound[fits], kind="stable")] if len(pairs) else ():
            i, j = int(a + i), int(c + j)
            p, q = self.find(i), self.find(j)
            if p != q and self.verify(i, j):
                self.root[max(p, q)] = min(p, q)
                self.links.append((i, j))


def _block_links(rows: DataFrame) -> DataFrame:
    """Links of each task's blocks.  ``side`` tells the two parts of a large block apart; null: all pairs of the block."""

    def run(table: pa.Table) -> pa.Table:
        task = np.array(table.column("block").to_pylist(), np.int64)
        sig, n = table.column("sig").to_numpy(), table.column("n").to_numpy()
        side = table.column("side").to_pylist()
        shared = table.column("shared")
        order = np.lexsort((sig, task))
        links: list[tuple[int, int]] = []
        for i in np.split(order, np.flatnonzero(np.diff(task[order])) + 1):
            if len(i) < 2:
                continue
            sets = [np.frombuffer(shared[int(k)].as_py(), np.uint64) for k in i]
            half = None if side[i[0]] is None else np.array([side[k] for k in i])
            links += _Block(sig[i], n[i], sets, half).join()
        return pa.Table.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["src", "dst"])

    return rows.groupBy("task").applyInArrow(tidy_group(run), "src long, dst long")


def set_links(docs: DataFrame, total: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(src, dst) of classes: pairs that reach the similarity, enough of them to connect all that do.

    ``total``: shingles of all documents, by which the ranges are sized.
    """
    ranges = max(64, -(-total // RANGE))
    parts = ranges
    survivors = materialize(_survivors(_shared(_dealt(docs, ranges, doc, text), parts)), "ngram-survivors")
    rare = survivors.select("sig", F.explode("rare").alias("key"))
    first = rare.groupBy("key").agg(F.min("sig").alias("to"))
    meet = connected_components(rare.join(first, "key").where("sig <> to").select("sig", "to"), "sig", "to")
    sizes = meet.groupBy("label").agg(F.count("*").alias("size"))
    placed = meet.join(sizes, "label").select(F.col("node").alias("sig"), "label", F.ceil(F.col("size") / PART).cast("int").alias("cuts"))
    rows = survivors.select("sig", "n", "shared").join(placed, "sig")
    part = F.pmod(F.xxhash64("sig", F.lit(5)), F.col("cuts")).cast("int")
    tasks = max(64, ranges)
    whole = rows.where("cuts = 1").select(F.col("label").alias("block"), F.pmod(F.xxhash64("label"), F.lit(tasks)).alias("task"), "sig", "n", "shared", F.lit(None).cast("int").alias("side"))
    cut = rows.where("cuts > 1").withColumn("own", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    pair = F.xxhash64("label", F.least("own", "other"), F.greatest("own", "other"))
    cut = cut.select(pair.alias("block"), pair.alias("task"), "sig", "n", "shared", F.when(F.col("own") != F.col("other"), F.when(F.col("own") < F.col("other"), 0).otherwise(1)).alias("side"))
    return _block_links(whole.unionAll(cut))


def jaccard_components(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id.

    Words are what lies between white space (space, tab to carriage return), A-Z lower-cased; the set holds the distinct shingles of five
    words, or the whole sequence of fewer.  Two documents link when 100 * intersection >= 75 * union; component_id is the
    smallest doc_id reachable.  Null, empty and wordless texts have an empty set and their own doc_id; rows with a null doc_id are kept, and never are
    a component's id unless alone.  Sets and shingles are compared by 64- and 54-bit hashes.
    """
    sets = materialize(shingle_sets(docs, doc, text), "ngram-sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    links = materialize(set_links(docs, total, doc, text), "ngram-links")
    labels = connected_components(links)
    classes = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"))
    label = F.coalesce("label", "sig")
    grouped = classes.join(labels.withColumnRenamed("node", "sig"), "sig", "left").select("sig", label.alias("label"), "rep")
    smallest = grouped.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_class = grouped.join(smallest, "label").select("sig", "component_id")
    return sets.join(by_class, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the smallest id.  Of rows that repeat both id and text one stays; empty texts and null ids all stay."""
    found = jaccard_components(docs, doc, text).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(found, docs[doc] == found["_gone"], "left_anti")
    repeated = docs.where(F.col(doc).isNotNull()).groupBy(doc).agg(F.count("*").alias("_n")).where("_n > 1")
    if repeated.isEmpty():
        return kept
    return kept.where(F.col(doc).isNotNull()).dropDuplicates([doc, text]).unionAll(kept.where(F.col(doc).isNull()))
