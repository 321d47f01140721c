"""Calendar expressions. Differences count crossed boundaries, not elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "month")


def months_crossed(start: Column | str, end: Column | str) -> Column:
    """Month boundaries between two dates: Jan-31 to Feb-1 is 1."""
    a, b = _col(start), _col(end)
    return ((F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))).cast("int")


def years_crossed(start: Column | str, end: Column | str) -> Column:
    """Year boundaries between two dates: Dec-31 to Jan-1 is 1."""
    return (F.year(_col(end)) - F.year(_col(start))).cast("int")


def age_in_365_day_years(birth: Column | str, as_of: Column | str) -> Column:
    """Whole blocks of 365 days, which drifts from the calendar age by leap days."""
    return F.floor(F.datediff(_col(as_of), _col(birth)) / 365).cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def calendar_parts(day: Column | str, prefix: str = "order") -> dict[str, Column]:
    """Year, month, quarter and English day name."""
    d = _col(day)
    return {
        f"{prefix}_year": F.year(d),
        f"{prefix}_month": F.month(d),
        f"{prefix}_quarter": F.quarter(d),
        f"{prefix}_day_of_week": F.date_format(d, "EEEE"),
    }


def clock_parts(ts: Column | str) -> dict[str, Column]:
    """Hour, day of week (Sunday = 1) and weekend flag."""
    t = _col(ts)
    return {
        "hour": F.hour(t),
        "day_of_week": F.dayofweek(t),
        "is_weekend": F.when(F.dayofweek(t).isin(1, 7), 1).otherwise(0),
    }


def whole_day(ts: Column | str, day: str) -> Column:
    """Rows of one calendar day as a half-open range on the raw column.

    Unlike ``date(ts) = day`` this reaches the parquet scan as a pushed filter.
    """
    t = _col(ts)
    start = F.lit(day).cast("date")
    return (t >= start) & (t < F.date_add(start, 1))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
