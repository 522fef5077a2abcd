"""Numeric Column helpers (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """NaN and +/-inf become null."""
    d = c.cast("double")
    bad = F.isnan(d) | (d == F.lit(float("inf"))) | (d == F.lit(float("-inf")))
    return F.when(bad, F.lit(None).cast("double")).otherwise(d)


def pearson(x: Column, y: Column) -> Column:
    """Population Pearson r that is null (not an error) on zero variance.

    ANSI ``corr`` raises DIVIDE_BY_ZERO when a side is constant, so r is
    built from ``covar_pop`` and ``stddev_pop`` with ``nullif``; pairs with a
    null on either side are dropped from both moments.
    """
    both = x.isNotNull() & y.isNotNull()
    xm = F.when(both, x.cast("double"))
    ym = F.when(both, y.cast("double"))
    denom = F.nullif(F.stddev_pop(xm) * F.stddev_pop(ym), F.lit(0.0))
    return F.covar_pop(xm, ym) / denom


def scale_ceiling(max_value: Column, step: int, default: int) -> Column:
    """Round a maximum up to a multiple of ``step``; ``default`` when empty or 0."""
    ceil = F.floor((max_value.cast("bigint") + F.lit(step - 1)) / F.lit(step)) * F.lit(step)
    return F.when(max_value.isNull() | (ceil == 0), F.lit(default)).otherwise(ceil).cast("bigint")

