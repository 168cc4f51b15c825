"""Exact aggregates: sums stay decimal and become double once, so every plan gives the same digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: Column | str) -> Column:
    return F.sum(c).cast("double")


def mean(c: Column | str) -> Column:
    """Mean of a decimal column; null for no rows."""
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)


def sample_variance(c: Column) -> Column:
    """Sample variance of a decimal column from its exact sums; null for fewer than two rows."""
    n, s, q = F.count(c), F.sum(c).cast("double"), F.sum((c * c).cast("decimal(38,4)")).cast("double")
    return F.when(n > 1, (q - s * s / n) / (n - 1))


def rounded(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the decimal form (8 places), so that binary fractions just below a half do not fall."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("decimal(38,8)"), digits).cast("double")


def ratio(a: Column, b: Column, digits: int) -> Column:
    """Rounded quotient; null where the divisor is 0 or null."""
    return rounded(a / F.nullif(b, F.lit(0.0)), digits)
