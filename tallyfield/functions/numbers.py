"""Arithmetic helpers: money, guarded ratios, rounding, NULL-as-zero sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column | str, digits: int) -> Column:
    """Round half to even on the scaled double, as numeric frames do.

    ``round`` and ``bround`` build a decimal object per row; this is two multiplications.
    """
    scale = float(10**digits)
    return F.rint(_col(value) * F.lit(scale)) / F.lit(scale)


def cents(amount: Column | str) -> Column:
    """Whole cents as a 64-bit integer: sums are exact and stay in generated code."""
    return F.rint(_col(amount) * 100).cast("bigint")


def money_sum(amount: Column | str) -> Column:
    """Exact sum of an amount with two decimals, as a double."""
    return F.sum(cents(amount)) / F.lit(100.0)


def money_mean(amount: Column | str, digits: int = 4) -> Column:
    """Mean of an amount with two decimals, rounded."""
    return rounded(F.sum(cents(amount)) / F.lit(100.0) / F.count(_col(amount)), digits)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Quotient that is NULL when the divisor is zero or NULL."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def share(top: Column | str, bottom: Column | str, digits: int = 6) -> Column:
    return rounded(ratio(top, bottom), digits)


def floored_divisor(value: Column | str, least: float) -> Column:
    """``max(value, least)`` that keeps NULL (``greatest`` alone would skip it)."""
    return F.when(_col(value).isNotNull(), F.greatest(_col(value), F.lit(least)))


def mean_gap(span: Column | str, count: Column | str) -> Column:
    """Span over (count - 1) when there is more than one event, else NULL."""
    return F.when(_col(count) > 1, _col(span) / (_col(count) - 1))


def null_as_zero_sum(columns: Sequence[str]) -> Column:
    total = F.coalesce(F.col(columns[0]), F.lit(0))
    for name in columns[1:]:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total


def weighted_flags(weights: Mapping[str, int]) -> Column:
    """Weighted sum of 0/1 flags; a missing flag counts as 0."""
    total = F.lit(0)
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name), F.lit(0)) * F.lit(weight)
    return total.cast("int")


def bmi(weight_kg: Column | str, height_cm: Column | str) -> Column:
    metres = _col(height_cm) / 100
    return F.try_divide(_col(weight_kg), metres * metres)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
