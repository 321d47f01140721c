"""Per-key time windows that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(ts)`` sorts all rows of a key in one task. These
operators window inside ``(key, bucket)`` and carry one summary row per bucket across the
buckets of the key.

Without ``bucket`` the rows are range-partitioned on (key, order) and a bucket is one of
the even pieces: a key with a third of all rows, even at one hour, is spread over a third
of the tasks, and a usual key lies in one piece. The placement is written once, so the
input is computed once. With ``bucket`` - a stretch of time that must not decrease along
the first order column - nothing is written; it suits keys that are spread over time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.operators.ordering import PIECE, SPOT, place

BUCKET = "_bucket"


def _bucketed(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | None) -> DataFrame:
    if bucket is None:
        return place(df, keys, order).withColumnRenamed(PIECE, BUCKET).drop(SPOT)
    return df.withColumn(BUCKET, bucket)


def _attach(df: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    match = F.col(BUCKET) == F.col("_at")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return df.join(edges, match, "left")


def _edge_keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_key_{k}") for k in keys] + [F.col(BUCKET).alias("_at")]


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Mapping[str, str],
    forward: bool = True,
    bucket: Column | None = None,
) -> DataFrame:
    """Columns of the next (or previous) row of the same key: lead and lag."""
    rows = _bucketed(df, keys, order, bucket)
    record = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(n) for n, c in take.items()])
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    pick, shift = (F.min, F.lead) if forward else (F.max, F.lag)
    edges = rows.groupBy(*_edge_keys(keys)).agg(pick(record).alias("_edge"))
    across = Window.partitionBy(*[f"_key_{k}" for k in keys]).orderBy("_at")
    edges = edges.withColumn("_edge", shift("_edge").over(across))
    local = rows.withColumn("_local", shift(record).over(inside))
    found = F.coalesce(F.col("_local"), F.col("_edge"))
    return _attach(local, edges, keys).select(*df.columns, *[found.getField(n).alias(n) for n in take])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    bucket: Column | None = None,
) -> DataFrame:
    """Running totals per key, the current row included."""
    rows = _bucketed(df, keys, order, bucket)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = (
        Window.partitionBy(*[f"_key_{k}" for k in keys])
        .orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = rows.groupBy(*_edge_keys(keys)).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    edges = edges.select(
        *[f"_key_{k}" for k in keys],
        "_at",
        *[F.coalesce(F.sum(f"_t_{n}").over(across), F.lit(0)).alias(f"_off_{n}") for n in sums],
    )
    local = rows.select("*", *[F.sum(c).over(inside).alias(f"_in_{n}") for n, c in sums.items()])
    return _attach(local, edges, keys).select(
        *df.columns, *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in sums]
    )


def carry(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Mapping[str, Column],
    forward: bool = True,
    bucket: Column | None = None,
) -> DataFrame:
    """Last non-NULL value at or before each row (or, backward, first at or after it).

    With readings and markers in one frame this is an as-of join without pairing rows.
    """
    rows = _bucketed(df, keys, order, bucket)
    spread = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    keep = Window.partitionBy(*[f"_key_{k}" for k in keys]).orderBy("_at")
    when = F.struct(*[F.col(c) for c in order])
    edge_values, local_values, out = [], [], []
    for name, value in take.items():
        held = F.when(value.isNotNull(), F.struct(value.alias("v")))
        if forward:
            pick = F.max_by(held, F.when(value.isNotNull(), when))
            edge = F.last(f"_e_{name}", ignorenulls=True).over(keep.rowsBetween(Window.unboundedPreceding, -1))
            local = F.last(held, ignorenulls=True).over(spread.rowsBetween(Window.unboundedPreceding, 0))
        else:
            pick = F.min_by(held, F.when(value.isNotNull(), when))
            edge = F.first(f"_e_{name}", ignorenulls=True).over(keep.rowsBetween(1, Window.unboundedFollowing))
            local = F.first(held, ignorenulls=True).over(spread.rowsBetween(0, Window.unboundedFollowing))
        edge_values.append((pick.alias(f"_e_{name}"), edge.alias(f"_c_{name}")))
        local_values.append(local.alias(f"_l_{name}"))
        out.append(F.coalesce(F.col(f"_l_{name}"), F.col(f"_c_{name}")).getField("v").alias(name))
    edges = rows.groupBy(*_edge_keys(keys)).agg(*[e for e, _ in edge_values])
    edges = edges.select(*[f"_key_{k}" for k in keys], "_at", *[c for _, c in edge_values])
    local = rows.select("*", *local_values)
    return _attach(local, edges, keys).select(*df.columns, *out)


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap_seconds: int, session: str = "session_start",
    bucket: Column | None = None,
) -> DataFrame:
    """Add the start time of the session each event belongs to.

    A session ends after ``gap_seconds`` without an event. Batch twin of
    ``session_window``: breaks are found inside a bucket, and one summary row per bucket
    tells whether its first events go on with a session of an earlier one.
    """

    def silent(before: Column, now: Column) -> Column:
        return F.unix_micros(now.cast("timestamp")) - F.unix_micros(before.cast("timestamp")) >= gap_seconds * 1_000_000

    inside = Window.partitionBy(*keys, BUCKET).orderBy(ts, tie)
    rows = _bucketed(df, keys, [ts, tie], bucket)
    local = rows.withColumn("_break", F.when(silent(F.lag(ts).over(inside), F.col(ts)), F.col(ts))).withColumn(
        "_local", F.last("_break", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    across = Window.partitionBy(*[f"_key_{k}" for k in keys]).orderBy("_at")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = local.groupBy(*_edge_keys(keys)).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("_break").alias("_break")
    )
    before = F.lag("_last").over(across)
    edges = edges.withColumn("_fresh", F.when(before.isNull() | silent(before, F.col("_first")), F.col("_first")))
    edges = edges.withColumn("_tail", F.coalesce("_break", "_fresh"))
    edges = edges.select(
        *[f"_key_{k}" for k in keys], "_at",
        F.coalesce("_fresh", F.last("_tail", ignorenulls=True).over(earlier)).alias("_head"),
    )
    return _attach(local, edges, keys).select(*df.columns, F.coalesce("_local", "_head").alias(session))


def interval_totals(
    readings: DataFrame,
    intervals: DataFrame,
    key: str,
    ts: str,
    start: str,
    end: str,
    interval_id: str,
    sums: Mapping[str, Column],
    grain: str | None = None,
) -> DataFrame:
    """Totals over the readings of the same key within each closed interval.

    Running totals are read off at both ends of the interval, so the work is linear in
    readings plus intervals, however many readings an interval covers.
    """
    points = readings.select(
        key, F.col(ts).alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(intervals.schema[interval_id].dataType).alias(interval_id),
        *[c.cast("bigint").alias(f"_v_{n}") for n, c in sums.items()],
    )
    ends = F.array(
        F.struct(F.col(start).alias("_t"), F.lit(0).alias("_kind")), F.struct(F.col(end).alias("_t"), F.lit(2).alias("_kind"))
    )
    marks = intervals.select(key, interval_id, F.explode(ends).alias("_e")).select(
        key, "_e._t", "_e._kind", interval_id, *[F.lit(0).cast("bigint").alias(f"_v_{n}") for n in sums]
    )
    line = points.unionByName(marks)
    summed = running(
        line, [key], ["_t", "_kind"], {n: F.col(f"_v_{n}") for n in sums},
        F.date_trunc(grain, F.col("_t")) if grain else None,
    )
    sign = F.when(F.col("_kind") == 2, 1).otherwise(-1)
    return (
        summed.where(F.col("_kind") != 1)
        .groupBy(key, interval_id)
        .agg(*[F.sum(sign * F.col(n)).alias(n) for n in sums])
    )
