"""Arm-level karyotypes from coverage bins: segments, levels, copy numbers, GC correction.

Per-bin work is DataFrame code; finding levels, resolving states and adjusting copy numbers walk a few hundred values in order and run
as one grouped pandas kernel per sample.  ``sample`` columns are the group keys throughout.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociforge.functions.contig import CHROMOSOMES
from lociforge.functions.stats import quantile, slope_intercept, upper_median

GC_REFERENCE = 0.41
LOESS_SHARE = 0.3
TOLERANCE = 0.3
SAME_LEVEL = 0.095
MAF_DIPLOID = 0.4

Regions = Mapping[str, tuple[int, int]]


def arm(chrom: Column, start: Column, end: Column, centromeres: Regions, par1: Regions | None = None, par2: Regions | None = None) -> Column:
    """The segment of a bin: arm, whole chromosome, PAR1, or null.

    Bins across a centromere have none; a bin that only touches its edge keeps the bare chromosome.  A chromosome
    with a centromere never reaches the PAR tests, nor one with a PAR1 that of PAR2.
    """
    number = F.regexp_replace(chrom, "^(chr)+", "")
    out = F.when(chrom.startswith("chr") & number.isin(*CHROMOSOMES), number)
    bare = out
    for name, (a, b) in (par2 or {}).items():
        if name not in (par1 or {}):
            out = F.when((chrom == name) & (end > a) & (start < b), F.lit(None)).otherwise(out)
    for name, (a, b) in (par1 or {}).items():
        inside = F.when((start < a) | (end > b), F.lit(None)).otherwise("PAR1")
        out = F.when((chrom == name) & (start < b) & (end > a), inside).otherwise(out)
    if centromeres:  # one map instead of a branch per chromosome
        known = F.create_map(*[y for c, (a, b) in centromeres.items() for y in (F.lit(c), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))])
        cen = F.try_element_at(known, chrom)
        side = F.when(end < cen["a"], F.concat(number, F.lit("p"))).when(start > cen["b"], F.concat(number, F.lit("q"))).when((start < cen["b"]) & (end > cen["a"]), F.lit(None)).otherwise(bare)
        out = F.when(cen.isNotNull(), side).otherwise(out)
    return F.when(chrom.startswith("chr"), out)


def arm_medians(segments: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(segment, n, median): upper medians of coverage; bins without a segment are left out."""
    return segments.where("segment is not null").groupBy(*by, "segment").agg(F.count("*").alias("n"), upper_median(F.col("coverage")).alias("median"))


def arm_order(segment: Column) -> Column:
    """Sort key of segments in natural order: numbers, then X, Y, then the rest; p before q."""
    number = F.regexp_extract(segment, r"^(\d+)", 1)
    place = F.when(number != "", number.cast("int")).when(segment.startswith("X"), 100).when(segment.startswith("Y"), 101).otherwise(999)
    return F.struct(place.alias("place"), segment.alias("name"))


def within_segment_spread(segments: DataFrame) -> DataFrame:
    """Interquartile range of the arms' interquartile ranges, and their median; the arm that is last in natural order is left out."""
    per = segments.where("segment is not null").groupBy("segment").agg((quantile(F.col("coverage"), 0.75) - quantile(F.col("coverage"), 0.25)).alias("iqr"))
    last = per.agg(F.max(arm_order(F.col("segment"))).alias("x")).select(F.col("x.name").alias("_last"))
    kept = per.join(F.broadcast(last), F.col("segment") != F.col("_last"))  # one row; at most 46 arms
    spread = quantile(F.col("iqr"), 0.75) - quantile(F.col("iqr"), 0.25)
    return kept.agg(spread.alias("iqr_of_iqrs"), F.percentile("iqr", F.lit(0.5)).alias("median_iqr"))


def bin_width(values: DataFrame, value: str = "coverage") -> DataFrame:
    """One row: the histogram's bin width, whole and at least 1."""
    x = F.col(value)
    iqr, top = quantile(x, 0.85) - quantile(x, 0.15), quantile(x, 0.95)
    raw = (0.88 * iqr + 0.12 * top / 2) * 2 * F.pow(F.count("*"), F.lit(-1 / 3))
    return values.agg(F.greatest(F.round(F.when(raw <= 0, 0.01).otherwise(raw)), F.lit(1.0)).alias("width"))


def histogram(segments: DataFrame) -> DataFrame:
    """(bin, n) from 0 to past the highest arm's 95th percentile, empty bins included."""
    known = segments.where("segment is not null")
    top = known.groupBy("segment").agg(quantile(F.col("coverage"), 0.95).alias("q")).agg(F.max("q").alias("top"))
    frame = F.broadcast(bin_width(known).join(F.broadcast(top)))  # single rows
    dense = frame.select("width", F.explode(F.sequence(F.lit(0), F.floor((F.col("top") + 2 * F.col("width")) / F.col("width")).cast("int"))).alias("bin"))
    counts = known.join(frame).groupBy(F.floor(F.col("coverage") / F.col("width")).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return dense.join(counts, "bin", "left").select("bin", "width", F.coalesce("n", F.lit(0)).alias("n"))


def histogram_peaks(hist: DataFrame) -> DataFrame:
    """Local maxima: runs of equal counts higher than both neighbours, at the run's middle; the first and last bins start none."""
    order = Window.orderBy("bin")
    change = F.when(F.lag("n").over(order).isNull() | (F.lag("n").over(order) != F.col("n")), 1).otherwise(0)
    runs = hist.withColumn("run", F.sum(change).over(order)).groupBy("run").agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"), F.first("n").alias("n"), F.first("width").alias("width"))
    around = Window.orderBy("run")
    low_left = F.lag("n").over(around) < F.col("n")
    last = F.max("hi").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    right = F.lead("n").over(around)
    marked = runs.withColumn("peak", low_left & (right.isNull() | (right < F.col("n"))) & (F.col("lo") < last))
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    return marked.where("peak").select(middle.alias("bin"), "n", ((middle + 0.5) * F.col("width")).alias("center"))


def majority_cn(karyotype: DataFrame) -> DataFrame:
    """The copy number of most autosomal arms; the lowest on ties."""
    counted = karyotype.where(~F.col("segment").rlike("X|Y|M|PAR")).groupBy("cn").agg(F.count("*").alias("n"))
    return counted.agg(F.max_by("cn", F.struct(F.col("n"), -F.col("cn"))).alias("majority_cn"))


def gc_correct_linear(bins: DataFrame, fit: DataFrame) -> DataFrame:
    """Coverage times the line at the reference GC over the line at the bin's; ``fit`` holds the bins to fit on.

    Fewer than three bins, no GC, no coverage, or a line that is not positive there: unchanged.
    """
    m, b = slope_intercept(F.col("coverage"), F.col("gc"))
    line = fit.where("gc is not null").agg(m.alias("m"), b.alias("b"), F.count("*").alias("points"))
    at = lambda x: F.col("m") * x + F.col("b")
    use = (F.col("points") >= 3) & F.col("gc").isNotNull() & (F.col("coverage") > 0) & (at(F.col("gc")) > 0)
    corrected = F.when(use, F.greatest(F.col("coverage") * at(F.lit(GC_REFERENCE)) / at(F.col("gc")), F.lit(0.0))).otherwise(F.col("coverage"))
    return bins.join(F.broadcast(line)).withColumn("corrected", corrected).select(*bins.columns, "corrected")


def loess(x: np.ndarray, y: np.ndarray, at: np.ndarray, share: float = LOESS_SHARE) -> np.ndarray:
    """Local lines through the nearest ``share`` of the points with tricube weights, evaluated at each of ``at``."""
    k = min(len(x), max(3, int(np.ceil(len(x) * share))))
    out = np.empty(len(at))
    for i, q in enumerate(at):
        d = np.abs(x - q)
        near = np.argsort(d, kind="stable")[:k]
        reach = d[near[-1]]
        if reach < 1e-12:
            out[i] = y[near].mean()
            continue
        w = (1 - (d[near] / reach) ** 3) ** 3
        sw, swx, swy = w.sum(), (w * x[near]).sum(), (w * y[near]).sum()
        det = sw * (w * x[near] ** 2).sum() - swx**2
        if abs(det) < 1e-12:
            out[i] = swy / sw
        else:
            slope = (sw * (w * x[near] * y[near]).sum() - swx * swy) / det
            out[i] = slope * q + (swy - slope * swx) / sw
    return out


def gc_correct_loess(bins: DataFrame, group: str = "sample") -> DataFrame:
    """Like ``gc_correct_linear`` with local lines, fitted on the bins marked ``fit``, per sample."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        known = frame[frame.fit & frame.gc.notna()]
        frame = frame.assign(corrected=frame.coverage)
        if len(known) >= 3:
            x, y = known.gc.to_numpy(float), known.coverage.to_numpy(float)
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            rows = frame.gc.notna() & (frame.coverage > 0)
            predicted = loess(x, y, frame.gc[rows].to_numpy(float))
            fixed = frame.coverage[rows].to_numpy(float) * loess(x, y, np.array([GC_REFERENCE]))[0] / np.where(predicted > 0, predicted, 1)
            frame.loc[rows, "corrected"] = np.where(predicted > 0, np.maximum(fixed, 0), frame.coverage[rows])
        return frame

    return bins.groupBy(group).applyInPandas(run, bins.schema.simpleString()[7:-1].replace(":", " ") + ", corrected double")


def suppress_close(bins: list[int], distance: int = 3) -> list[int]:
    """Of bins in order of falling height, those at least ``distance`` from every one kept before."""
    kept: list[int] = []
    for b in bins:
        if all(abs(b - k) >= distance for k in kept):
            kept.append(b)
    return kept


def suppressed_peaks(peaks: DataFrame, distance: int = 3) -> DataFrame:
    """(bin, n) of ``histogram_peaks`` after ``suppress_close``, tallest first and lower bins first on ties."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        kept = suppress_close([int(b) for b in frame.sort_values(["n", "bin"], ascending=[False, True]).bin], distance)
        return frame[frame.bin.isin(kept)][["bin", "n"]]

    return peaks.select("bin", F.col("n").cast("long").alias("n")).groupBy().applyInPandas(run, "bin int, n long")


def coverage_levels(segments: DataFrame, group: str = "sample") -> DataFrame:
    """(sample, rank, level, n) of ``find_levels``; a sample's few thousand bins are one task."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        levels = find_levels({name: part.coverage.to_numpy(float) for name, part in frame.groupby("segment")})
        return pd.DataFrame({group: [frame[group].iloc[0]] * len(levels), "rank": range(1, len(levels) + 1), "level": [float(v) for v, _ in levels], "n": [int(n) for _, n in levels]})

    known = segments.where("segment is not null").select(group, "segment", "coverage")
    return known.groupBy(group).applyInPandas(run, f"{group} string, rank int, level double, n long")


def _upper(values: np.ndarray) -> float:
    return float(np.sort(values)[len(values) // 2])


def _width(values: np.ndarray) -> float:
    q = lambda p: float(np.quantile(values, p))
    raw = (0.88 * (q(0.85) - q(0.15)) + 0.12 * q(0.95) / 2) * 2 * len(values) ** (-1 / 3)
    return raw if raw > 0 else 0.01


def _peaks(hist: np.ndarray) -> list[tuple[int, int]]:
    out, i = [], 1
    while i < len(hist) - 1:
        j = i
        while j + 1 < len(hist) and hist[j + 1] == hist[i]:
            j += 1
        if hist[i - 1] < hist[i] and (j + 1 >= len(hist) or hist[j + 1] < hist[i]):
            out.append(((i + j) // 2, int(hist[i])))
        i = j + 1
    return out


def find_levels(arms: Mapping[str, np.ndarray]) -> list[tuple[float, int]]:
    """Coverage levels (value, bins near it), in the order of the histogram's heights."""
    everything = np.sort(np.concatenate(list(arms.values()))) if arms else np.zeros(0)
    if not len(everything):
        return []
    width = max(1.0, float(np.floor(_width(everything) + 0.5)))
    top = max(0.0, *(float(np.quantile(v, 0.95)) for v in arms.values() if len(v)))
    size = int((top + 2 * width) // width) + 1
    at = (everything // width).astype(int)
    hist = np.bincount(at[(at >= 0) & (at < size)], minlength=size)
    peaks = sorted(_peaks(hist), key=lambda p: -p[1])
    levels = []
    for b in suppress_close([p[0] for p in peaks]):
        center = (b + 0.5) * width
        near = everything[(everything > center - 1.5 * width) & (everything < center + 1.5 * width)]
        if len(near):
            value = _upper(near)
            levels.append((value, int(((everything > value - width) & (everything < value + width)).sum())))
    if not levels:
        return []
    tallest = max(n for _, n in levels)
    levels = [x for x in levels if x[1] > 0.05 * tallest]
    used = set()
    for name, values in arms.items():
        if len(values) and name not in ("X", "Y"):
            apart = [abs(v / m - 1) if (m := _upper(values)) else np.inf for v, _ in levels]
            if min(apart) < TOLERANCE:
                used.add(int(np.argmin(apart)))
    out: list[tuple[float, int]] = []
    for i, x in enumerate(levels):
        if i in used and not any(abs(x[0] - k[0]) <= SAME_LEVEL * k[0] for k in out):
            out.append(x)
    return out


def maf_peaks(levels: list[tuple[float, int]], medians: Mapping[str, float], mafs: Mapping[str, np.ndarray]) -> dict[int, float]:
    """Of the first three levels, the highest minor-allele-frequency peak of more than half the tallest one's height."""
    top = [v for v, _ in levels[:3]]
    arms: dict[int, list[str]] = {}
    for name in sorted(medians):
        apart = [abs(medians[name] / v - 1) for v in top]
        if apart and min(apart) < TOLERANCE:
            arms.setdefault(int(np.argmin(apart)), []).append(name)
    out = {}
    for level, names in arms.items():
        values = np.concatenate([mafs[n] for n in names if n in mafs] or [np.zeros(0)])
        if len(values) < 50:
            continue
        width = min(_width(values), 0.05)
        size = int(np.ceil(0.6 / width))
        inside = values[(values >= 0) & (values <= 0.6)]
        hist = np.bincount((inside // width).astype(int), minlength=size + 1)[: size + 1]
        found = [(i, int(hist[i])) for i in range(2, size - 2) if all(hist[i] > hist[i + d] for d in (-2, -1, 1, 2))]
        if found:
            tallest = max(n for _, n in found)
            out[level] = (max(i for i, n in found if n > 0.5 * tallest) + 0.5) * width
    return out


def resolve_states(levels: list[tuple[float, int]], peaks: Mapping[int, float] | None = None) -> tuple[float, float, float]:
    """Coverage of one, two and three copies, from the two tallest levels, their ratio, and their allele-frequency peaks."""
    if not levels:
        return 1.0, 2.0, 3.0
    pair = sorted(v for v, _ in levels[:2])
    low, high = pair[0], pair[-1]
    if len(pair) < 2 or high - low < 0.05:
        return low * 0.5, low, low * 1.5
    as_two_three, as_one_two = (2 * low - high, low, high), (low, high, 2 * high - low)
    by_ratio = as_two_three if high < 1.51 * low else as_one_two
    if peaks is None:
        return by_ratio
    at = lambda v: peaks.get(next((i for i, x in enumerate(levels) if abs(x[0] - v) < 0.001), 0), 0.0)
    p, q = at(low), at(high)
    if p > MAF_DIPLOID:  # whether the other's is high too or not, the ratio decides
        return as_one_two if high / low >= 1.6 else as_two_three
    if q > MAF_DIPLOID:
        return as_one_two
    return by_ratio


def copy_number(median: Column, one: Column, two: Column, three: Column) -> Column:
    """Copies by the interval that a median lies in, tested in the order 2, 1, 3, more, 0; between them the nearer of 1 and 2."""
    half = (two - one) / 2
    near = lambda c: (median > c - half) & (median < c + half)
    return (
        F.when(near(two), 2).when(near(one), 1).when(near(three), 3)
        .when(median > three + half, F.round((median - two) / (2 * half) + 2).cast("int"))
        .when(median < half, 0).when(F.abs(median - two) < F.abs(median - one), 2).otherwise(1)
    )


def blast_ratio(karyotype: DataFrame) -> DataFrame:
    """Share of tumour cells from autosomal arms' mean medians at one, two and three copies; null where only two copies are there."""
    auto = karyotype.where(~F.col("segment").rlike("X|Y|M|PAR"))
    at = lambda k: F.avg(F.when(F.col("cn") == k, F.col("median")))
    n = lambda k: F.count_if(F.col("cn") == k)
    one, three = (1 - at(1) / at(2)) * 2, at(3) / at(2) * 2 - 2
    both = at(1).isNotNull() & at(3).isNotNull()
    return auto.agg(F.when(both, F.when(n(1) >= n(3), one).otherwise(three)).otherwise(F.coalesce(one, three)).alias("blast_ratio"))


def _blast(cn: Mapping[str, int], medians: Mapping[str, float]) -> float | None:
    by: dict[int, list[float]] = {}
    for name, c in cn.items():
        if not any(x in name for x in ("X", "Y", "M", "PAR")):
            by.setdefault(c, []).append(medians[name])
    mean = {c: sum(v) / len(v) for c, v in by.items()}
    if 2 not in mean or not (1 in mean or 3 in mean):
        return None
    if 1 in mean and (3 not in mean or len(by[1]) >= len(by[3])):
        return (1 - mean[1] / mean[2]) * 2
    return mean[3] / mean[2] * 2 - 2


def assign(medians: Mapping[str, float], states: tuple[float, float, float], peaks: Mapping[int, float] | None = None) -> dict[str, int]:
    """Copy numbers of all arms, with the adjustments for sex chromosomes, hypodiploidy and a shifted scale."""
    one, two, three = states
    delta = two - one
    cn = {}
    for name, m in medians.items():
        near = lambda c, m=m: c - delta / 2 < m < c + delta / 2
        if near(two):
            cn[name] = 2
        elif near(one):
            cn[name] = 1
        elif near(three):
            cn[name] = 3
        elif m > three + delta / 2:
            cn[name] = int(np.floor((m - two) / delta + 2.5))
        elif m < delta / 2:
            cn[name] = 0
        else:
            cn[name] = 2 if abs(m - two) < abs(m - one) else 1
    diploid = [medians[n] for n, c in cn.items() if c == 2 and not any(x in n for x in ("X", "Y", "PAR"))]
    if "Y" in cn and diploid:
        mean = sum(diploid) / len(diploid)
        y = medians["Y"]
        if 0.45 * mean < y < 0.55 * mean:
            cn["Y"] = 1
            if cn.get("X") in (1, 2):
                x, ratio = medians["X"], _blast(cn, medians)
                if ratio is not None:
                    expected = 2 * y * ratio + (1 - ratio) * y
                    cn["X"] = 2 if 0.9 * expected < x < 1.1 * expected else 1
                else:
                    cn["X"] = 1 if abs(mean - x) > abs(x - mean / 2) else 2
    mean_of = lambda c: float(np.mean([medians[n] for n, k in cn.items() if k == c] or [0.0]))
    lonely = cn.get("Y", 0) == 1 and not any(c == 1 and "X" not in n and "Y" not in n for n, c in cn.items())
    if lonely and one - delta / 2 < medians.get("Y", 0.0) < one + delta / 2 and not (peaks or {}).get(0, 0) > MAF_DIPLOID:
        low, high = mean_of(1), mean_of(3)
        if low > 0 and high > 0 and 0.9 * low < high / 2 < 1.1 * low:
            cn = {n: c - 1 if c in (2, 3) else c for n, c in cn.items()}
    if 1 not in cn.values() and sum(c == 3 for c in cn.values()) > 25:
        cn = {n: max(0, c - 1) for n, c in cn.items()}
    return cn


METACENTRIC = tuple(str(c) for c in range(1, 23) if c not in (13, 14, 15, 21, 22))


def _changes(name: str, copies: int, expected: int) -> list[str]:
    return [("-" if copies < expected else "+") + name] * abs(copies - expected)


def karyotype_string(cn: Mapping[str, int]) -> str:
    """Chromosomes, sex chromosomes and gains and losses against the baseline of two copies, or of one in a near-haploid sample.

    A chromosome counts two if any part is diploid, else one if any part is single, else its own or its arms' smaller number.
    """
    total = 0
    for c in CHROMOSOMES[:22]:
        parts = [cn[a] for a in (c, f"{c}p", f"{c}q") if a in cn]
        total += 2 if 2 in parts else 1 if 1 in parts else cn[c] if c in cn else min(cn.get(f"{c}p", 2), cn.get(f"{c}q", 2))
    base = 1 if total <= 30 else 2
    changes: list[str] = []
    for c in CHROMOSOMES[:22]:
        p, q = cn.get(f"{c}p", base), cn.get(f"{c}q", base)
        if c in cn or p == q:
            changes += _changes(c, cn.get(c, p), base)
        else:
            changes += _changes(f"{c}p", p, base) + _changes(f"{c}q", q, base)
    x, y = cn.get("X", 0), cn.get("Y", 0)
    sex = "XY" if y else "XX" if x > 1 else "X" if x else "??"
    changes += _changes("X", x, sex.count("X")) + _changes("Y", y, sex.count("Y"))
    return f"{total + x + y}{sex}; {'(1n) ' if base == 1 else ''}{', '.join(changes)}"


def _natural(name: str) -> tuple[int, str]:
    digits = name.rstrip("pq")
    return (int(digits) if digits.isdigit() else {"X": 100, "Y": 101}.get(name[:1], 999), name)


def iscn_string(cn: Mapping[str, int]) -> str:
    """Segments by copy number: losses, the diploid sex chromosomes and autosomes, then gains; equal arms of a metacentric chromosome as one."""
    by: dict[int, list[str]] = {}
    for name, n in cn.items():
        other = name[:-1] + {"p": "q", "q": "p"}.get(name[-1:], "")
        whole = name[:-1] in METACENTRIC and name[-1:] in ("p", "q") and cn.get(other) == n
        merged = name[:-1] if whole else name
        if merged not in by.setdefault(n, []):
            by[n].append(merged)
    groups = [f"({', '.join(sorted(by[1], key=_natural))})x1"] if by.get(1) else []
    two = by.get(2, [])
    all_two = all(c in two for c in CHROMOSOMES[:22])
    shown = [c for c in ("X", "Y") if c in two] + (["1-22"] if all_two else [])
    if shown:
        groups.append(f"({', '.join(shown)})x2")
    groups += [f"({', '.join(sorted(by[n], key=_natural))})x{n}" for n in sorted(by) if n > 2]
    return f"seq {', '.join(groups)}"


def call_karyotypes(segments: DataFrame, group: str = "sample", maf: DataFrame | None = None) -> DataFrame:
    """Per sample and arm: median, cn and the sample's levels, blast ratio and karyotype string.

    ``segments``: sample, segment, coverage; ``maf``: sample, segment, maf (minor allele frequency), which decides between states that
    coverage alone leaves open.  A sample has a few thousand bins and a panel's sites, so its kernel is one task; samples run in parallel.
    """

    def run(frame: pd.DataFrame, sites: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["sample", "segment", "median", "cn", "levels", "blast_ratio", "karyotype", "iscn"])
        arms = {n: g.to_numpy(float) for n, g in frame.groupby("segment").coverage}
        medians = {n: _upper(v) for n, v in arms.items()}
        levels = find_levels(arms)
        peaks = maf_peaks(levels, medians, {n: g.to_numpy(float) for n, g in sites.groupby("segment").maf}) if len(sites) else None
        cn = assign(medians, resolve_states(levels, peaks), peaks)
        names = sorted(arms)
        return pd.DataFrame({"sample": frame["sample"].iloc[0], "segment": names, "median": [medians[n] for n in names], "cn": [cn[n] for n in names], "levels": [[v for v, _ in levels]] * len(names), "blast_ratio": _blast(cn, medians), "karyotype": karyotype_string(cn), "iscn": iscn_string(cn)})

    known = segments.where("segment is not null").select(F.col(group).alias("sample"), "segment", "coverage")
    if maf is None:
        sites = segments.sparkSession.createDataFrame([], "sample string, segment string, maf double")
    else:
        sites = maf.where("segment is not null and maf is not null").select(F.col(group).alias("sample"), "segment", "maf")
    return known.groupBy("sample").cogroup(sites.groupBy("sample")).applyInPandas(run, "sample string, segment string, median double, cn int, levels array<double>, blast_ratio double, karyotype string, iscn string")


def call_corrected(segments: DataFrame, maf: DataFrame | None = None, linear: bool = False) -> tuple[DataFrame, DataFrame]:
    """Karyotypes in two passes, and the corrected bins: the first pass's autosomal arms with the majority's copies are what GC is fitted on.

    ``segments``: sample, segment, coverage, gc.  The linear fit is one line over all given samples, the local one per sample.
    """
    first = call_karyotypes(segments, maf=maf)
    arms = first.select("sample", "segment", "cn").where(~F.col("segment").rlike("X|Y|M|PAR"))
    counted = arms.groupBy("sample", "cn").agg(F.count("*").alias("n"))
    majority = counted.groupBy("sample").agg(F.max_by("cn", F.struct(F.col("n"), -F.col("cn"))).alias("cn"))
    fitted = arms.join(majority, ["sample", "cn"]).select("sample", "segment", F.lit(True).alias("fit"))
    marked = segments.join(fitted, ["sample", "segment"], "left").withColumn("fit", F.coalesce("fit", F.lit(False)))
    corrected = gc_correct_linear(marked, marked.where("fit")) if linear else gc_correct_loess(marked)
    bins = corrected.drop("fit").withColumn("coverage", F.col("corrected")).drop("corrected")
    return call_karyotypes(bins, maf=maf), bins


def baf_layout(maf: DataFrame, width: float = 1.0, by: str = "ref_id") -> DataFrame:
    """Allele frequencies spread evenly over their arm: the i-th of n at i / (n - 1) of its width."""
    order = Window.partitionBy(by).orderBy("pos", "al0", "al1")
    n = F.count("*").over(Window.partitionBy(by))
    x = F.when(n > 1, (F.row_number().over(order) - 1) / (n - 1) * width).otherwise(F.lit(0.0))
    return maf.select(by, "pos", "al0", "al1", x.alias("x"), (F.col("alt") / (F.col("ref") + F.col("alt"))).alias("baf"))


def pixel_density(points: DataFrame, x: str = "x", y: str = "baf", width: int = 100, height: int = 50, most: int = 5) -> DataFrame:
    """Points by pixel, their number limited to ``most`` shades."""
    px, py = F.floor(F.col(x) * width).cast("int"), F.floor(F.col(y) * height).cast("int")
    return points.groupBy(px.alias("px"), py.alias("py")).agg(F.least(F.count("*"), F.lit(most)).cast("int").alias("shade"))
