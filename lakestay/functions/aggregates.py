"""Aggregate builders for groupBy(...).agg(...); all of them combine map-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def sum_if(x: Column, cond: Column) -> Column:
    """NULL when no row matches."""
    return F.sum(F.when(cond, x))


def avg_if(x: Column, cond: Column) -> Column:
    return F.avg(F.when(cond, x))


def count_distinct_if(x: Column, cond: Column) -> Column:
    return F.count_distinct(F.when(cond, x))


def arg_min(x: Column, *order: Column) -> Column:
    """x of the smallest row by order; order has to be total for a stable result."""
    return F.min_by(x, F.struct(*order))


def first_non_null(x: Column, *order: Column) -> Column:
    return F.min_by(x, F.when(x.isNotNull(), F.struct(*order)))


def any_true(cond: Column) -> Column:
    return F.coalesce(F.bool_or(cond), F.lit(False))


def duration_sec(ts: Column) -> Column:
    """Whole seconds between the first and the last second seen."""
    second = F.unix_seconds(ts.cast("timestamp"))
    return F.max(second) - F.min(second)


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """Percentage as double, NULL for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), scale)
