"""Interval operators: union, binned joins, first match.  Intervals are half-open unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_intervals(df: DataFrame, key: str = "ref_id", start: str = "st", end: str = "en") -> DataFrame:
    """Overlapping and touching intervals of a key as one."""
    order = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)).over(order)
    return df.withColumn("_island", island).groupBy(key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def bins(start: Column, last: Column, width: int) -> Column:
    """All bins of ``width`` that the closed interval touches, as an array to explode."""
    first, to = F.floor(start / width).cast("int"), F.floor(last / width).cast("int")
    return F.when(to >= first, F.sequence(first, to)).otherwise(F.array().cast("array<int>"))


def overlap_join(left: DataFrame, right: DataFrame, key: str, l_start: str, l_end: str, r_start: str, r_end: str, width: int) -> DataFrame:
    """Pairs of half-open intervals that overlap, each once.

    Both sides are dealt out by (key, bin), so the join is an equi-join that can be hashed, sorted, skew-split or broadcast; a pair is kept only in the bin in which
    the later one starts, so no distinct is needed.  ``left`` and ``right`` share no column but ``key``.
    """
    a = left.withColumn("_bin", F.explode(bins(F.col(l_start), F.col(l_end) - 1, width)))
    b = right.withColumn("_bin", F.explode(bins(F.col(r_start), F.col(r_end) - 1, width)))
    first = F.floor(F.greatest(l_start, r_start) / width).cast("int")
    return a.join(b, [key, "_bin"]).where((F.col(l_start) < F.col(r_end)) & (F.col(r_start) < F.col(l_end)) & (F.col("_bin") == first)).drop("_bin")


def point_join(points: DataFrame, intervals: DataFrame, key: str, point: str, start: str, end: str, width: int, closed: bool = False) -> DataFrame:
    """Points with the intervals they lie in, by an equi-join on (key, bin); ``closed`` counts the interval's end."""
    a = points.withColumn("_bin", F.floor(F.col(point) / width).cast("int"))
    b = intervals.withColumn("_bin", F.explode(bins(F.col(start), F.col(end) - (0 if closed else 1), width)))
    below = F.col(point) <= F.col(end) if closed else F.col(point) < F.col(end)
    return a.join(b, [key, "_bin"]).where((F.col(point) >= F.col(start)) & below).drop("_bin")


def covered_by_bin(df: DataFrame, width: int, key: str = "ref_id", start: str = "st", end: str = "en") -> DataFrame:
    """Bases of disjoint intervals in each bin: (key, bin, covered)."""
    rows = df.withColumn("bin", F.explode(bins(F.col(start), F.col(end) - 1, width)))
    part = F.least(F.col(end), (F.col("bin") + 1) * width) - F.greatest(F.col(start), F.col("bin") * width)
    return rows.groupBy(key, "bin").agg(F.sum(part).alias("covered"))
