"""Counts by place without a row per base: records and places meet in tiles of the genome, which stream past numpy kernels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.functions import cigar
from lociforge.operators.intervals import bins

TILE = 16_384
#: Bases or reads of a unit that are placed at once; bounds a kernel's memory whatever the depth.
_AT_ONCE = 1 << 21
#: The letter of a base that a record does not have.
MISSING = 0


def sweep(rows: DataFrame, cell: Sequence[str], order: str, kernel: Callable[[], object], schema: str) -> DataFrame:
    """``rows`` of each cell, sorted by ``order``, through a kernel of its own: ``take(batch)`` for each piece of the cell's rows and ``end()``, which give batches.

    Only one batch and a kernel's state are in memory, whatever a cell holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in cell]
            edges = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                key = tuple(k[lo] for k in keys)
                if key != current:
                    if state is not None:
                        yield from state.end()
                    current, state = key, kernel()
                yield from state.take(batch.slice(lo, hi - lo))
        if state is not None:
            yield from state.end()

    return rows.repartition(*cell).sortWithinPartitions(*cell, order).mapInArrow(run, schema)


def dealt(df: DataFrame, start: Column, last: Column, width: int = TILE) -> DataFrame:
    """``df`` with ``_tile``: a row for each tile that the closed interval touches."""
    return df.withColumn("_tile", F.explode(bins(start, last, width)))


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An integer column without nulls."""
    return batch.column(name).to_numpy(zero_copy_only=False)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets (from 0) of a column of lists or bytes; a null is empty."""
    if isinstance(column, (pa.ListArray, pa.LargeListArray)):
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    else:
        column = column.fill_null(b"") if column.null_count else column
        kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
        values = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return values[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


_ON_REFERENCE, _ON_QUERY, _PAIRED = (np.zeros(256, bool) for _ in range(3))
for _flags, _ops in ((_ON_REFERENCE, cigar.REFERENCE), (_ON_QUERY, cigar.QUERY), (_PAIRED, cigar.PAIRED)):
    _flags[[ord(op) for op in _ops]] = True


def _operations(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each operation of records (``_start``, 1-based; ``_ops``, a letter each; ``_lens``): its letter, length, row, and its starts on reference and query."""
    ops, at = _lists(batch.column("_ops"))
    lens, _ = _lists(batch.column("_lens"))
    if len(ops) != len(lens):
        raise ValueError("CIGAR operations are single letters, each with a length")
    row, lens = np.repeat(np.arange(batch.num_rows), np.diff(at)), lens.astype(np.int64)

    def before(used: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(np.where(used, lens, 0))))
        return total[:-1] - total[at[row]]

    return ops, lens, row, numbers(batch, "_start").astype(np.int64)[row] + before(_ON_REFERENCE[ops]), before(_ON_QUERY[ops])


class Counts:
    """How often each letter stands at each place of a tile; a deletion is ``-`` (with ``gaps``; else it is left out), a base that is not there ``MISSING``."""

    def __init__(self, width: int = TILE, gaps: bool = True):
        self.width, self.gaps = width, gaps
        self.planes: dict[int, np.ndarray] = {}
        #: By the length of a repeated unit: changes of the count from a place to the next one a unit later.
        self.steps: dict[int, dict[int, np.ndarray]] = {}

    def _plane(self, letter: int) -> np.ndarray:
        if letter not in self.planes:
            self.planes[letter] = np.zeros(self.width, np.int64)
        return self.planes[letter]

    def _add(self, letters: np.ndarray, places: np.ndarray, weights: int = 1, planes: Callable[[int], np.ndarray] | None = None) -> None:
        known = np.flatnonzero(np.bincount(letters, minlength=256))
        mine = [(planes or self._plane)(letter) for letter in known.tolist()]
        if mine:
            size, number = len(mine[0]), np.zeros(256, np.int64)
            number[known] = np.arange(len(known)) * size
            found = np.bincount(number[letters] + places, minlength=len(known) * size).reshape(len(known), size)
            for plane, more in zip(mine, found, strict=True):
                plane += weights * more

    def add(self, first: int, batch: pa.RecordBatch) -> None:
        """Records (start, 1-based; CIGAR as letters and lengths; bases, repeated where they are shorter than the query) on the tile from ``first`` on."""
        ops, lens, row, t0, q0 = _operations(batch)
        t0, t1 = t0 - first, t0 - first + lens
        bases, unit_at = _lists(batch.column("_bases"))
        kept = (_PAIRED[ops] | ((ops == ord("D")) & self.gaps)) & (t1 > 0) & (t0 < self.width) & (lens > 0)
        gap = ops[kept] == ord("D")
        row, t0, t1, q0 = row[kept], t0[kept], t1[kept], q0[kept]
        cut = np.maximum(-t0, 0)
        t0, t1, q0 = t0 + cut, np.minimum(t1, self.width), q0 + cut
        unit = np.diff(unit_at)[row]
        plain = gap | (unit == 0)
        if plain.any():  # one letter all along: where it begins and where it is over
            letters = np.where(gap[plain], ord("-"), MISSING).astype(np.uint8)
            self._change(1, letters, t0[plain], t1[plain])
        start, t0, t1, q0, unit = unit_at[row[~plain]], t0[~plain], t1[~plain], q0[~plain], unit[~plain]
        for size in np.unique(unit[t1 - t0 > 2 * unit]).tolist():
            mine = (unit == size) & (t1 - t0 > 2 * unit)
            each = max(1, _AT_ONCE // size)
            for i in range(0, int(mine.sum()), each):
                s, a, b, q = (x[mine][i : i + each, None] for x in (start, t0, t1, q0))
                k = np.arange(size)
                letters = bases[s + (q + k) % size]
                begin = a + k
                over = begin + -(-(b - begin) // size) * size  # the first place of its kind that is not in the operation
                self._change(size, letters.ravel(), begin.ravel(), over.ravel())
        short = t1 - t0 <= 2 * unit
        s, a, q, u, n = (x[short] for x in (start, t0, q0, unit, t1 - t0))
        ends = np.cumsum(n)
        lo = 0
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE, "right")))
            part = slice(lo, hi)
            own = np.repeat(np.arange(hi - lo), n[part])
            k = np.arange(len(own)) - np.repeat(ends[part] - n[part] - (ends[lo - 1] if lo else 0), n[part])
            self._add(bases[s[part][own] + (q[part][own] + k) % u[part][own]], a[part][own] + k)
            lo = hi

    def _change(self, size: int, letters: np.ndarray, begin: np.ndarray, over: np.ndarray) -> None:
        mine = self.steps.setdefault(size, {})
        room = self.width + (-self.width) % size + size  # whole units and one more, where operations may be over
        plane = lambda letter: mine.setdefault(letter, np.zeros(room, np.int64))
        self._add(letters, begin, 1, plane)
        self._add(letters, over, -1, plane)

    def read(self) -> dict[int, np.ndarray]:
        """Counts by letter."""
        for size, planes in self.steps.items():
            for letter, plane in planes.items():
                self._plane(letter)[:] += np.cumsum(plane.reshape(-1, size), axis=0).ravel()[: self.width]
        self.steps = {}
        return self.planes


def count_letters(records: DataFrame, places: DataFrame, letters: Sequence[str] = (), by: Sequence[str] = (), gaps: bool = True, width: int = TILE) -> DataFrame:
    """``places`` (ref_id, ``lo`` to before ``hi``, and columns of their own) as a row per place ``t`` that a record covers, with its ``depth`` and counts ``n0``, ``n1``, ...

    Counts are those of the ``letters`` (each text a set of them) and of the letter in each column named in ``by``.  ``records``: ref_id, start (1-based), span, ops (a letter each), lens, bases
    (see ``Counts.add``).  A record goes to the tiles it touches that have places (their numbers, at most one per tile of the genome, are broadcast), and is counted there in arrays as long as the
    tile: no row per base, and nothing that grows with the depth.
    """
    own = [f for f in places.schema if f.name not in ("ref_id", "lo", "hi")]
    asked = dealt(places.where("lo < hi"), F.col("lo"), F.col("hi") - 1, width)
    used = asked.select("ref_id", "_tile").distinct()
    met = dealt(records.where("span > 0"), F.col("start"), F.col("start") + F.col("span") - 1, width).join(F.broadcast(used), ["ref_id", "_tile"], "left_semi")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in own]
    reads = met.select("ref_id", "_tile", F.lit(0).alias("_kind"), F.col("start").alias("_start"), F.encode("ops", "UTF-8").alias("_ops"), F.col("lens").alias("_lens"), F.encode("bases", "UTF-8").alias("_bases"), *none)
    void, to = F.lit(None).cast("binary"), F.least("hi", (F.col("_tile") + 1) * width).cast("int")
    wanted = asked.select("ref_id", "_tile", F.lit(1).alias("_kind"), F.greatest("lo", F.col("_tile") * width).cast("int").alias("_start"), void.alias("_ops"), F.array(to).alias("_lens"), void.alias("_bases"), *[f.name for f in own])

    class Kernel:
        def __init__(self):
            self.counts = Counts(width, gaps)

        def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            first = batch.column("_tile")[0].as_py() * width
            cut = int(np.searchsorted(numbers(batch, "_kind"), 1))
            if cut:
                self.counts.add(first, batch.slice(0, cut))
            each = max(1, _AT_ONCE // width)  # places of a piece are bounded too
            for i in range(cut, batch.num_rows, each):
                yield self._answer(first, batch.slice(i, each))

        def _answer(self, first: int, asked: pa.RecordBatch) -> pa.RecordBatch:
            planes, nothing = self.counts.read(), np.zeros(width, np.int64)
            lo = numbers(asked, "_start").astype(np.int64)
            n = _lists(asked.column("_lens"))[0] - lo
            row = np.repeat(np.arange(len(lo)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row] - first
            depth = sum(planes.values(), nothing)[at]
            covered = np.flatnonzero(depth)
            row, at, depth = row[covered], at[covered], depth[covered]
            counts = [sum((planes.get(ord(c), nothing)[at] for c in text), np.zeros(len(at), np.int64)) for text in letters]
            for name in by:
                text, offsets = _lists(asked.column(name).cast("binary"))
                single = np.diff(offsets) == 1
                code = np.full(len(single), -1)
                code[single] = text[offsets[:-1][single]]
                mine, found = code[row], np.zeros(len(at), np.int64)
                for letter, plane in planes.items():
                    if letter != MISSING:
                        found += np.where(mine == letter, plane[at], 0)
                counts.append(found)
            take = pa.array(row)
            columns = [asked.column("ref_id").take(take), pa.array((at + first).astype(np.int32)), pa.array(depth), *[pa.array(x) for x in counts], *[asked.column(f.name).take(take) for f in own]]
            return pa.RecordBatch.from_arrays(columns, ["ref_id", "t", "depth", *[f"n{i}" for i in range(len(counts))], *[f.name for f in own]])

        def end(self) -> Iterator[pa.RecordBatch]:
            return iter(())

    counted = [f"n{i} long" for i in range(len(letters) + len(by))]
    schema = ", ".join(["ref_id int, t int, depth long", *counted, *[f"`{f.name}` {f.dataType.simpleString()}" for f in own]])
    return sweep(reads.unionByName(wanted), ("ref_id", "_tile"), "_kind", Kernel, schema)


_FAR = 1 << 29


def indels(records: DataFrame, min_length: int | None = None, width: int = TILE) -> DataFrame:
    """(ref_id, pos, length, solid, padding, coverage, near): insertions (positive) and deletions (negative; skips too) per place and length, counted once whatever the depth.

    ``padding`` counts operations without reference bases.  With ``min_length``, an insertion of that length seen twice or more has ``near``, the other insertions within 1.1 lengths' distance and
    10 % of its length.  ``coverage`` is the number of records whose span holds the place.  ``records``: ref_id, start (1-based), span, ops, lens; a record also goes to tiles that its insertions
    reach, so what is near a place is whole in the place's tile.
    """
    halo = F.lit(0) if min_length is None else F.greatest(F.array_max(F.col("lens")), F.lit(0)) * F.col("ops").contains("I").cast("int")
    halo = F.ceil(halo * 1.25).cast("int") + 2
    dealt_ = dealt(records.where("span >= 0"), F.col("start") - halo, F.col("start") + F.col("span") + halo, width)
    rows = dealt_.select("ref_id", "_tile", F.col("start").alias("_start"), F.col("span").alias("_span"), F.encode("ops", "UTF-8").alias("_ops"), F.col("lens").alias("_lens"))

    class Kernel:
        def __init__(self):
            self.keys, self.numbers, self.depth, self.tile = [], [], np.zeros(width + 1, np.int64), None

        def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            self.tile = batch.column("_tile")[0].as_py(), batch.column("ref_id")[0].as_py()
            first = self.tile[0] * width
            start = numbers(batch, "_start").astype(np.int64) - first
            self.depth += np.bincount(np.clip(start, 0, width), minlength=width + 1) - np.bincount(np.clip(start + numbers(batch, "_span"), 0, width), minlength=width + 1)
            ops, lens, _, t, _ = _operations(batch)
            kept = np.isin(ops, [ord(c) for c in "IDNP"])
            length = np.where(ops[kept] == ord("I"), lens[kept], -lens[kept])
            key = ((t[kept] - first + _FAR) << 33) | ((length + (1 << 31)) << 1) | (ops[kept] == ord("P"))
            found, times = np.unique(key, return_counts=True)
            self.keys.append(found)
            self.numbers.append(times)
            if sum(map(len, self.keys)) > _AT_ONCE:
                self._fold()
            return iter(())

        def _fold(self) -> None:
            found, where = np.unique(np.concatenate(self.keys), return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, where, np.concatenate(self.numbers))
            self.keys, self.numbers = [found], [total]

        def end(self) -> Iterator[pa.RecordBatch]:
            self._fold()
            key, times = self.keys[0], self.numbers[0]
            self.keys, self.numbers = [], []
            at, padded, each = key >> 1, (key & 1).astype(bool), 1 << 16
            kind, begin = np.unique(at, return_index=True)
            if not len(kind):
                return
            solid, padding = (np.add.reduceat(np.where(mine, times, 0), begin) for mine in (~padded, padded))
            t, length = (kind >> 32) - _FAR, (kind & 0xFFFFFFFF) - (1 << 31)
            coverage = np.cumsum(self.depth)
            inserted = length > 0
            other = t[inserted], length[inserted], solid[inserted]
            mine = np.flatnonzero((t >= 0) & (t < width))
            for i in range(0, len(mine), each):
                part = mine[i : i + each]
                events = np.full(len(part), False) if min_length is None else (length[part] >= max(min_length, 1)) & (solid[part] > 1)
                number = np.zeros(len(part), np.int64)
                places, seen = [], []
                for lo, hi in _pieces(t[part], np.where(events, (length[part] * 1.1).astype(np.int64), 0), other[0]):
                    row, near = _beside(t[part], length[part], events, other, lo, hi)
                    number += np.bincount(row, minlength=len(part))
                    places.append(other[0][near])
                    seen.append(other[2][near])
                places, seen = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, seen))
                inner = pa.StructArray.from_arrays([pa.array((places + self.tile[0] * width).astype(np.int32)), pa.array(seen)], ["pos", "n"])
                offsets = pa.array(np.concatenate(([0], np.cumsum(number))).astype(np.int32), mask=np.append(~events, False))
                columns = [np.full(len(part), self.tile[1], np.int32), (t[part] + self.tile[0] * width).astype(np.int32), length[part].astype(np.int32), solid[part], padding[part], coverage[t[part]]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], pa.ListArray.from_arrays(offsets, inner)], ["ref_id", "pos", "length", "solid", "padding", "coverage", "near"])

    schema = "ref_id int, pos int, length int, solid long, padding long, coverage long, near array<struct<pos:int,n:long>>"
    return sweep(rows, ("ref_id", "_tile"), "_start", Kernel, schema)


def _pieces(t: np.ndarray, reach: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ranges of the sorted ``places`` closer than ``reach`` to each ``t``, in pieces of bounded size: (first, past) per row, empty outside the piece."""
    lo, hi = np.searchsorted(places, t - reach, "right"), np.searchsorted(places, t + reach, "left")
    hi = np.maximum(lo, hi)
    total = np.cumsum(hi - lo)
    i = 0
    while i < len(t):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _AT_ONCE, "right")))
        rows = np.arange(len(t))
        yield lo, np.where((rows >= i) & (rows < j), hi, lo)
        i = j


def _beside(t: np.ndarray, length: np.ndarray, events: np.ndarray, other: tuple[np.ndarray, np.ndarray, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index in ``other``) of the insertions in the ranges given whose length is within 10 % of the row's, but for itself."""
    n = np.where(events, hi - lo, 0)
    row = np.repeat(np.arange(len(t)), n)
    near = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]
    mine, its = length[row], other[1][near]
    similar = (its * 0.9 < mine) & (mine < its * 1.1) & ((other[0][near] != t[row]) | (its != mine))
    return row[similar], near[similar]


#: Records go to the tile they begin in, as wide as four to a power times this: the least one that their span fits.
_REACH, _CLASSES = 1 << 17, 8


def _with_targets(records: DataFrame, targets: DataFrame, *own: str) -> DataFrame:
    """Targets (``_kind`` 0; ref_id, g_st, g_en, half-open, and ``own``) and ``records`` (1; ref_id, ts, te and columns of their own) by cells; a record is in one cell, with all targets that it may meet."""
    span = F.col("te") - F.col("ts")
    size = F.expr(f"shiftleft(cast({_REACH} as bigint), 2 * _class)")
    steps = [(span > (_REACH << 2 * k)).cast("int") for k in range(_CLASSES - 1)]
    home = records.withColumn("_class", sum(steps[1:], steps[0])).withColumn("_tile", F.floor(F.col("ts") / size).cast("int"))
    wide = targets.where("g_st < g_en").select("ref_id", "g_st", "g_en", *own, F.explode(F.sequence(F.lit(0), F.lit(_CLASSES - 1))).alias("_class"))
    wide = wide.withColumn("_tile", F.explode(F.sequence(F.floor(F.col("g_st") / size).cast("int") - 1, F.floor((F.col("g_en") - 1) / size).cast("int"))))
    kinds = {f.name: f.dataType for f in (*records.schema, *wide.select("g_st", "g_en", *own).schema)}
    names = ["ref_id", "_class", "_tile", *[c for c in kinds if c != "ref_id"]]
    filled = lambda df, kind: df.select(F.lit(kind).alias("_kind"), *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])
    return filled(wide, 0).unionByName(filled(home, 1))


class _Walk:
    """Targets of a cell in their order; ``walk`` shows each of them the records that none before it took."""

    def __init__(self, min_anchor: int, order: Sequence[str]):
        self.parts, self.min_anchor, self.order, self.table = [], min_anchor, order, None

    def split(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """Takes up the targets of ``batch``; the records are left."""
        cut = int(np.searchsorted(numbers(batch, "_kind"), 1))
        if cut:
            self.parts.append(batch.slice(0, cut))
        return batch.slice(cut)

    def targets(self) -> pa.Table | None:
        if self.table is None and self.parts:
            self.table = pa.Table.from_batches(self.parts).sort_by([(c, "ascending") for c in self.order]).combine_chunks()
        return self.table

    def walk(self, ts: np.ndarray, te: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(target, records it meets, which of them it takes, ...): by ``order``; a record is taken by an overlap of more than the anchor, those of one ``ord`` take together."""
        table = self.targets()
        if table is None or not len(ts):
            return
        rows = np.argsort(ts, kind="stable")
        ts, te = ts[rows], te[rows]
        reach = int((te - ts).max())
        g_st, g_en, ord_ = (table.column(c).to_numpy() for c in ("g_st", "g_en", "ord"))
        same = np.append(ord_[1:] == ord_[:-1], False)
        gone = np.zeros(len(ts), bool)
        for k in range(len(g_st)):
            lo, hi = np.searchsorted(ts, g_st[k] - reach, "right"), np.searchsorted(ts, g_en[k], "left")
            if lo < hi:
                met = lo + np.flatnonzero(te[lo:hi] > g_st[k])
                anchor = np.minimum(g_en[k], te[met]) - np.maximum(g_st[k], ts[met])
                taken = anchor > self.min_anchor
                yield k, rows[met], taken
                gone[met[taken]] = True
            if not same[k] and gone.any():
                rows, ts, te = rows[~gone], ts[~gone], te[~gone]
                gone = np.zeros(len(ts), bool)


def first_targets(records: DataFrame, targets: DataFrame, min_anchor: int) -> DataFrame:
    """``records`` (ref_id, ts, te, ...) with ``_bin`` and ``_nm`` of the first target (ref_id, g_st, g_en, ord, bin, nm; by ord, bin, nm) they overlap by more than ``min_anchor``; null without one."""
    names = [f.name for f in records.schema]

    class Kernel:
        def __init__(self):
            self.walk = _Walk(max(min_anchor, 0), ("ord", "bin", "nm"))

        def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            mine = self.walk.split(batch)
            if not mine.num_rows:
                return
            first = np.full(mine.num_rows, -1)
            for k, met, taken in self.walk.walk(numbers(mine, "ts"), numbers(mine, "te")):
                met = met[taken]
                first[met] = np.where(first[met] < 0, k, first[met])
            at, table = pa.array(first, mask=first < 0), self.walk.targets()
            found = [pa.nulls(len(at), kind) if table is None else table.column(c).combine_chunks().take(at) for c, kind in (("bin", pa.int32()), ("nm", pa.string()))]
            yield pa.RecordBatch.from_arrays([*[mine.column(c) for c in names], *found], [*names, "_bin", "_nm"])

        def end(self) -> Iterator[pa.RecordBatch]:
            return iter(())

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema], "_bin int, _nm string"])
    return sweep(_with_targets(records, targets, "ord", "bin", "nm"), ("ref_id", "_class", "_tile"), "_kind", Kernel, schema)


def bases_up_to_first(records: DataFrame, targets: DataFrame, min_anchor: int) -> DataFrame:
    """(nm, bases): of each record (ref_id, ts, te) the bases inside (st, en) of its targets (as for ``first_targets``), up to and with the first that takes it; a row per cell and target."""

    class Kernel:
        def __init__(self):
            self.walk, self.bases = _Walk(min_anchor, ("ord", "nm")), None

        def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            mine = self.walk.split(batch)
            if not mine.num_rows or (table := self.walk.targets()) is None:
                return
            if self.bases is None:
                self.bases = np.zeros(len(table), np.int64)
                self.st, self.en = (table.column(c).to_numpy() for c in ("st", "en"))
            ts, te = numbers(mine, "ts"), numbers(mine, "te")
            for k, met, _ in self.walk.walk(ts, te):
                self.bases[k] += np.maximum(np.minimum(self.en[k], te[met]) - np.maximum(self.st[k], ts[met]), 0).sum(dtype=np.int64)
            return
            yield

        def end(self) -> Iterator[pa.RecordBatch]:
            if self.bases is not None:
                kept = np.flatnonzero(self.bases)
                yield pa.RecordBatch.from_arrays([self.walk.targets().column("nm").combine_chunks().take(pa.array(kept)), pa.array(self.bases[kept])], ["nm", "bases"])

    return sweep(_with_targets(records, targets, "ord", "nm", "st", "en"), ("ref_id", "_class", "_tile"), "_kind", Kernel, "nm string, bases long")


_OPPOSITE = np.arange(256, dtype=np.uint8)
_OPPOSITE[[ord(c) for c in "ACGT"]] = [ord(c) for c in "TGCA"]


def letters_of_reads(records: DataFrame, places: DataFrame, near: DataFrame, width: int = TILE) -> DataFrame:
    """(gene, read_name, aln_no, pos, letters): what each record shows at the ``places`` (ref_id, t, gene, pos, minus) of a gene, a row per record, gene and tile; a base that is not there is ``N``.

    ``records`` as for ``count_letters``, with read_name and aln_no; only those in the tiles of ``near`` (ref_id, lo, hi: all that places can lie in) are asked.
    """
    used = dealt(near.where("lo < hi"), F.col("lo"), F.col("hi") - 1, width).select("ref_id", "_tile").distinct()
    met = dealt(records.where("span > 0"), F.col("start"), F.col("start") + F.col("span") - 1, width).join(F.broadcast(used), ["ref_id", "_tile"], "left_semi")
    void = lambda kind: F.lit(None).cast(kind)
    reads = met.select("ref_id", "_tile", F.lit(1).alias("_kind"), F.col("start").alias("_start"), F.encode("ops", "UTF-8").alias("_ops"), F.col("lens").alias("_lens"), F.encode("bases", "UTF-8").alias("_bases"), "read_name", "aln_no", void("string").alias("gene"), void("int").alias("pos"), void("int").alias("minus"))
    asked = places.select("ref_id", F.floor(F.col("t") / width).cast("int").alias("_tile"), F.lit(0).alias("_kind"), F.col("t").alias("_start"), void("binary").alias("_ops"), F.array().cast("array<int>").alias("_lens"), void("binary").alias("_bases"), void("string").alias("read_name"), void("int").alias("aln_no"), "gene", F.col("pos").cast("int").alias("pos"), F.col("minus").cast("int").alias("minus"))

    class Kernel:
        def __init__(self):
            self.parts, self.table = [], None

        def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            cut = int(np.searchsorted(numbers(batch, "_kind"), 1))
            if cut:
                self.parts.append(batch.slice(0, cut).select(["_start", "gene", "pos", "minus"]))
            if cut == batch.num_rows or not self.parts:
                return
            if self.table is None:
                self.table = pa.Table.from_batches(self.parts).sort_by([("_start", "ascending"), ("gene", "ascending")]).combine_chunks()
                self.t, self.pos, self.minus = (self.table.column(c).to_numpy() for c in ("_start", "pos", "minus"))
                names = self.table.column("gene").combine_chunks().dictionary_encode()
                self.genes, self.gene = names.dictionary, names.indices.to_numpy()
            for i in range(cut, batch.num_rows, 1024):
                yield self._shown(batch.slice(i, 1024))

        def _shown(self, mine: pa.RecordBatch) -> pa.RecordBatch:
            ops, lens, row, t0, q0 = _operations(mine)
            bases, unit_at = _lists(mine.column("_bases"))
            kept = (_PAIRED[ops] | (ops == ord("D"))) & (lens > 0)
            ops, row, t0, q0, t1 = ops[kept], row[kept], t0[kept], q0[kept], (t0 + lens)[kept]
            lo, hi = np.searchsorted(self.t, t0, "left"), np.searchsorted(self.t, t1, "left")
            n = hi - lo
            op = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(op)) - np.repeat(np.cumsum(n) - n, n) + lo[op]
            unit = np.diff(unit_at)[row[op]]
            letter = np.full(len(op), ord("N"), np.uint8)
            there = unit > 0
            letter[there] = bases[(unit_at[row[op]] + (q0[op] + self.t[place] - t0[op]) % np.maximum(unit, 1))[there]]
            letter[ops[op] == ord("D")] = ord("-")
            letter = np.where(self.minus[place] > 0, _OPPOSITE[letter], letter)
            order = np.lexsort((place, self.gene[place], row[op]))
            place, letter, its = place[order], letter[order], row[op][order]
            gene = self.gene[place]
            begin = np.flatnonzero(np.append(True, (its[1:] != its[:-1]) | (gene[1:] != gene[:-1]))) if len(its) else np.zeros(0, int)
            ends = pa.array(np.append(begin, len(its)).astype(np.int32))
            texts = pa.Array.from_buffers(pa.binary(), len(begin), [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(letter))])
            who = pa.array(its[begin])
            columns = [self.genes.take(pa.array(gene[begin])), mine.column("read_name").take(who), mine.column("aln_no").take(who), pa.ListArray.from_arrays(ends, pa.array(self.pos[place].astype(np.int32))), texts]
            return pa.RecordBatch.from_arrays(columns, ["gene", "read_name", "aln_no", "pos", "letters"])

        def end(self) -> Iterator[pa.RecordBatch]:
            return iter(())

    return sweep(reads.unionByName(asked), ("ref_id", "_tile"), "_kind", Kernel, "gene string, read_name string, aln_no int, pos array<int>, letters binary")


def pairs_of_calls(shown: DataFrame, calls: DataFrame) -> DataFrame:
    """(gene, p1, p2, cis, trans) of each two ``calls`` (gene, pos, ref, alt) of a gene that a read of ``shown`` (see ``letters_of_reads``) covers: products of reads by calls, a gene at a time.

    A read's letter is that of its last record there.
    """
    rows = shown.select("gene", F.col("aln_no").alias("_at"), "read_name", "pos", "letters")
    known = calls.select("gene", F.lit(-(1 << 31)).alias("_at"), F.lit(None).cast("string").alias("read_name"), F.array(F.col("pos").cast("int")).alias("pos"), F.encode(F.concat("ref", "alt"), "UTF-8").alias("letters"))

    class Kernel:
        def __init__(self):
            self.parts = []

        def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            self.parts.append(batch)
            return iter(())

        def end(self) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(self.parts).combine_chunks()
            column = lambda c: table.column(c).combine_chunks() if isinstance(table.column(c), pa.ChunkedArray) else table.column(c)
            names = column("read_name")
            called = np.asarray(names.is_null())
            (places, at), (letters, text_at) = _lists(column("pos")), _lists(column("letters"))
            n = int(called.sum())  # calls sort first
            if n < 2 or n == len(called):
                return
            pos = places[:n]
            rank = np.argsort(pos)
            pos, ref, alt = pos[rank], letters[text_at[:n]][rank], letters[text_at[:n] + 1][rank]
            who = names.slice(n).dictionary_encode()
            reads, wide = who.indices.to_numpy(), np.diff(at[n:])
            table_of = np.zeros((len(who.dictionary), n), np.uint8)
            table_of[np.repeat(reads, wide), np.searchsorted(pos, places[at[n] :])] = letters[text_at[n] :]  # in the order of records: the last one stays
            both, cis, trans = (np.zeros((n, n), np.int64) for _ in range(3))
            for i in range(0, len(table_of), 1 << 14):
                part = table_of[i : i + (1 << 14)]
                c, r, a = ((part > 0).astype(np.float32), (part == ref).astype(np.float32), (part == alt).astype(np.float32))
                x = r.T @ a
                both, cis, trans = both + (c.T @ c).astype(np.int64), cis + (r.T @ r + a.T @ a).astype(np.int64), trans + (x + x.T).astype(np.int64)
            one, two = np.nonzero(np.triu(both, 1))
            gene = pa.array(np.zeros(len(one), np.int32))
            columns = [column("gene").slice(0, 1).take(gene), pa.array(pos[one].astype(np.int32)), pa.array(pos[two].astype(np.int32)), pa.array(cis[one, two]), pa.array(trans[one, two])]
            yield pa.RecordBatch.from_arrays(columns, ["gene", "p1", "p2", "cis", "trans"])

    return sweep(known.unionByName(rows), ("gene",), "_at", Kernel, "gene string, p1 int, p2 int, cis long, trans long")
