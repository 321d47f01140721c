"""Binning: right-closed cuts, left-closed thresholds, rank bins, equal-width bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bin edges and labels of the reports.
AGE_GROUP = ([0, 25, 35, 45, 55, 100], ["18-25", "26-35", "36-45", "46-55", "55+"])
CLINICAL_AGE = ([0, 30, 50, 65, 80, 100], ["18-30", "31-50", "51-65", "66-80", "80+"])
STAY = (
    [0, 2, 5, 10, float("inf")],
    ["Short (1-2)", "Medium (3-5)", "Long (6-10)", "Extended (10+)"],
)
BMI_CLASS = ([0, 18.5, 25, 30, float("inf")], ["Underweight", "Normal", "Overweight", "Obese"])
GENERATION = ([25, 40, 55], ["Gen Z", "Millennial", "Gen X", "Baby Boomer"])


def cut(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``(a, b]``; at or below the first edge, above the last, or NULL gives NULL."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.when(v <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        hit = v.isNotNull() if upper == float("inf") else v <= upper
        out = out.when(hit, label)
    return out


def below(value: Column | str, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose limit exceeds the value; the last label takes the rest and NULL."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.when(v < limits[0], labels[0])
    for limit, label in zip(limits[1:], labels[1:]):
        out = out.when(v < limit, label)
    return out.otherwise(labels[-1])


def at_least(value: Column | str, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose descending limit is reached; the last label takes the rest."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.when(v >= F.lit(limits[0]), labels[0])
    for limit, label in zip(limits[1:], labels[1:]):
        out = out.when(v >= F.lit(limit), label)
    return out.otherwise(labels[-1])


def rank_bin(rank: Column | str, size: Column | str, bins: int = 5) -> Column:
    """Equal-width quantile bin of rank r among n: ceil((r-1)*bins/(n-1)), at least 1.

    This is the bin a quantile cut of the ranks gives; ``ntile`` differs for most n.
    """
    r = F.col(rank) if isinstance(rank, str) else rank
    n = F.col(size) if isinstance(size, str) else size
    steps = F.greatest(n - 1, F.lit(1))
    top = (r - 1) * bins + steps - 1
    return F.greatest(F.floor((top - top % steps) / steps), F.lit(1)).cast("int")


def last_rank_of_bin(size: int, index: int, bins: int = 5) -> int:
    """Largest rank that still falls in bin ``index``: the inverse of ``rank_bin``."""
    return 1 + index * (size - 1) // bins
