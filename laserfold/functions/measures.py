"""Aggregates and ratios used by several levels of the grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accuracy of percentile sketches; the rank error is at most rows / PERCENTILE_ACCURACY.
PERCENTILE_ACCURACY = 10_000


def class_count(code: int) -> Column:
    return F.count_if(F.col("classification") == code)


def share(part: str, whole: str) -> Column:
    """part / whole, and 0 where whole is not positive."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def quantile(value: str | Column, p: float) -> Column:
    return F.percentile_approx(value, p, PERCENTILE_ACCURACY)


def quantiles(value: str | Column, ps: Sequence[float]) -> Column:
    """Several quantiles out of one sketch, as an array in the order of `ps`."""
    return F.percentile_approx(value, list(ps), PERCENTILE_ACCURACY)
