"""Aggregates whose small-sample form differs from the built-in one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(c: str) -> Column:
    """Bias-corrected skewness; NULL below three values."""
    n = F.count(c).cast("double")
    corrected = F.skewness(c) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n >= 3, corrected)


def sample_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis; NULL below four values."""
    n = F.count(c).cast("double")
    corrected = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)
    return F.when(n >= 4, corrected)


def normal_interval(c: str, z: float = 1.96) -> tuple[Column, Column]:
    """Normal 95 % interval of a mean."""
    half = F.lit(z) * F.try_divide(F.stddev(c), F.sqrt(F.count(c).cast("double")))
    return F.avg(c) - half, F.avg(c) + half
