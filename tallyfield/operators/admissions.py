"""Admission histories: extract filters, next and trailing events, census, adherence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.numbers import cents, ratio, rounded, share
from tallyfield.operators.timeline import neighbour


def eligible(admissions: DataFrame, start: str, end: str, age: str | None = None) -> DataFrame:
    """Discharged in the closed range, not planned surgery, at least a day, adult.

    A NULL admission type is dropped, as ``!=`` does in the reference's extract.
    """
    rows = admissions.where(
        F.col("discharge_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & (F.col("admission_type") != "Elective Surgery")
        & (F.col("length_of_stay") >= 1)
    )
    return rows.where(F.col(age) >= 18) if age else rows


def next_event_gap(admissions: DataFrame, key: str = "patient_id", day: str = "admission_date",
                   event_id: str = "admission_id") -> DataFrame:
    """Next admission date of the same patient and the days until it.

    Rows are spread over even pieces, so one patient's history does not meet in one task.
    """
    out = neighbour(admissions, [key], [day, event_id], {"readmission_date": day})
    return out.withColumn("days_to_readmission", F.datediff("readmission_date", day))


def trailing_counts(events: DataFrame, days: Sequence[int], key: str, day: str) -> DataFrame:
    """Per (key, day): events in the days before it and ever before, same day excluded.

    Events shrink to one row per (key, day) first. A key then has at most one row per
    calendar day, however many events it holds.
    """
    daily = events.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"))
    timeline = Window.partitionBy(key).orderBy(F.unix_date(F.col(day)))
    columns = {
        f"previous_{n}d": F.coalesce(F.sum("_n").over(timeline.rangeBetween(-n, -1)), F.lit(0)) for n in days
    }
    columns["total_previous"] = F.coalesce(
        F.sum("_n").over(timeline.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return daily.withColumns(columns).drop("_n")


def census(stays: DataFrame, start: str, end: str, capacity: Column | None = None) -> DataFrame:
    """Patients present per change day: +1 at admission, -1 at discharge.

    The running sum is over distinct days only.
    """
    change = stays.select(
        F.explode(
            F.array(
                F.struct(F.col(start).alias("day"), F.lit(1).alias("step")),
                F.struct(F.col(end).alias("day"), F.lit(-1).alias("step")),
            )
        ).alias("c")
    ).select("c.day", "c.step")
    daily = change.groupBy("day").agg(F.sum("step").alias("_net"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    out = daily.select("day", F.sum("_net").over(upto).alias("occupied"))
    return out if capacity is None else out.withColumn("occupancy_rate", share("occupied", capacity))


def kpis(stays: DataFrame, keys: Sequence[str], readmitted: str, died: str, cost: str, mix: str) -> DataFrame:
    """Readmission and death rate, mean stay, case mix and cost per case."""
    return stays.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cases"),
        rounded(F.avg(readmitted), 6).alias("readmission_rate"),
        rounded(F.avg("length_of_stay"), 6).alias("mean_stay"),
        rounded(F.avg(mix), 6).alias("case_mix_index"),
        rounded(F.avg(died), 6).alias("mortality_rate"),
        rounded(F.sum(cents(cost)) / F.lit(100.0) / F.count(cost), 4).alias("cost_per_case"),
    )


def rate_ratio(rows: DataFrame, group: str, outcome: str, reference: str) -> DataFrame:
    """Outcome rate per group and its ratio to the reference group."""
    rates = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(outcome).cast("bigint")).alias("events"))
    base = F.max(F.when(F.col(group) == reference, ratio("events", "n"))).over(Window.partitionBy())  # one row per group
    return rates.select(
        group, "n", "events", share("events", "n").alias("rate"),
        rounded(ratio(ratio("events", "n"), base), 6).alias("rate_ratio"),
    )


def outbreak_flags(events: DataFrame, key: str, day: str, history: int = 28, limit: float = 3.0) -> DataFrame:
    """Days whose count exceeds the trailing mean by ``limit`` standard deviations.

    Runs on one row per (key, day); the history is the rows of earlier days with events.
    """
    daily = events.groupBy(key, day).agg(F.count(F.lit(1)).alias("n"))
    past = Window.partitionBy(key).orderBy(F.unix_date(F.col(day))).rangeBetween(-history, -1)
    mean, spread = F.avg("n").over(past), F.stddev_samp("n").over(past)
    return daily.select(
        key, day, "n",
        rounded(mean, 6).alias("trailing_mean"),
        rounded(spread, 6).alias("trailing_sd"),
        F.coalesce(F.col("n") > rounded(mean, 6) + F.lit(limit) * rounded(spread, 6), F.lit(False)).cast("int").alias("outbreak"),
    )


def proportion_covered(fills: DataFrame, keys: Sequence[str], day: str, supply: str) -> DataFrame:
    """Days covered by dispensed supply over the span from first fill to last covered day.

    Overlaps count once: each fill adds only what lies beyond the furthest end so far.
    Fills of one day shrink to the longest one, so a key has at most one row per day.
    """
    daily = fills.groupBy(*keys, day).agg(F.max(F.date_add(day, F.col(supply).cast("int"))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    reached = daily.withColumn("_reach", F.max("_end").over(before))
    begin = F.greatest(F.col(day), F.col("_reach"))  # skips the NULL of the first fill
    fresh = F.greatest(F.datediff("_end", begin), F.lit(0))
    return (
        reached.withColumn("_fresh", fresh)
        .groupBy(*keys)
        .agg(
            F.sum("_fresh").alias("days_covered"),
            F.datediff(F.max("_end"), F.min(day)).cast("bigint").alias("days_in_period"),
        )
        .withColumn("pdc", share("days_covered", "days_in_period"))
    )

