"""Statistics with the engine's definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_median(x: Column) -> Column:
    """Aggregate: the value at place n // 2 of the sorted values; not the mean of the middle two."""
    values = F.sort_array(F.collect_list(x))
    return F.get(values, F.floor(F.size(values) / 2).cast("int"))


def quantile(x: Column, q: float) -> Column:
    """Aggregate: linear interpolation between order statistics."""
    return F.percentile(x, F.lit(q))


def slope_intercept(y: Column, x: Column) -> tuple[Column, Column]:
    """Aggregates of the least-squares line; a constant x gives slope 0 and the mean."""
    return F.coalesce(F.regr_slope(y, x), F.lit(0.0)), F.coalesce(F.regr_intercept(y, x), F.avg(y))
