"""Ratios, limit tests and correlation that hold under ANSI mode."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL where there is nothing to divide by."""
    return F.try_divide(F.lit(100.0) * part, whole)


def over_limit(value: Column, limit) -> Column:
    """Strictly above the limit; a missing value is not above it."""
    return F.coalesce(value > limit, F.lit(False))


def pearson(a: Column, b: Column) -> Column:
    """Pearson r over rows where both are present.

    The built-in aggregate raises on a constant column under ANSI mode, so the
    quotient is written out with a guarded division: NULL when either is constant.
    """
    spread = (F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b)))
    return F.try_divide(F.covar_pop(a, b), spread)


def when_metric(name: str, value: str = "reading") -> Column:
    """The reading on rows of one metric, NULL elsewhere: the building block of one-pass pivots."""
    return F.when(F.col("parameter_name") == name, F.col(value))
