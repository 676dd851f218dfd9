"""Zero-guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, 0.0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(safe_ratio(part * 100.0, whole), digits)


def harmonic_mean(a: Column, b: Column) -> Column:
    return safe_ratio(2.0 * a * b, a + b)
