"""Stream transformations: enrichment, windows, duplicates, diversions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.numbers import cents, rounded
from tallyfield.functions.traffic import INCIDENT_SCHEMA, TRAFFIC_SCHEMA
from tallyfield.operators.joins import incident_impact
from tallyfield.operators.traffic import enrich
from tallyfield.sources.messages import parse_json
from tallyfield.streaming.jobs import WATERMARK


def traffic_flow(raw: DataFrame, now: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """JSON messages to enriched readings with arrival time and watermark."""
    arrived = F.current_timestamp() if now is None else now
    parsed = parse_json(raw, TRAFFIC_SCHEMA, keep=keep).withColumn("processing_time", arrived)
    return enrich(parsed).withWatermark("timestamp", WATERMARK)


def incident_flow(raw: DataFrame) -> DataFrame:
    return parse_json(raw, INCIDENT_SCHEMA)


def timed(df: DataFrame, ts: str, delay: str = WATERMARK) -> DataFrame:
    """Event-time watermark. The column must be a plain timestamp, so it is cast."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def window_metrics(df: DataFrame, ts: str, size: str, keys: Sequence[str], slide: str | None = None,
                   speed: str = "average_speed", count: str = "vehicle_count", occupancy: str = "occupancy") -> DataFrame:
    """Mean speed, vehicles and occupancy per key and window, fixed or sliding.

    Rows are combined before the shuffle, so a busy road costs one row per task and window.
    """
    frame = F.window(ts, size, slide) if slide else F.window(ts, size)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return df.groupBy(frame.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("readings"),
        rounded(F.sum(cents(zero(speed))) / F.lit(100.0) / F.count(F.lit(1)), 6).alias("avg_speed"),
        F.sum(zero(count).cast("bigint")).alias("total_vehicles"),
        rounded(F.sum(cents(zero(occupancy))) / F.lit(100.0) / F.count(F.lit(1)), 6).alias("avg_occupancy"),
    ).select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "readings", "avg_speed", "total_vehicles", "avg_occupancy",
    )


def session_metrics(df: DataFrame, ts: str, user: str, gap: str = "30 minutes", kind: str = "event_type",
                    converted: str = "purchase") -> DataFrame:
    """Web sessions of a stream, given out when the watermark has passed their end."""
    return df.groupBy(F.session_window(ts, gap).alias("w"), user).agg(
        F.count(F.lit(1)).alias("pages_viewed"),
        F.max((F.col(kind) == converted).cast("int")).alias("conversion_flag"),
    ).select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "pages_viewed", "conversion_flag")


def without_repeats(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Drop repeated deliveries that arrive within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(ids))


def within_intervals(readings: DataFrame, intervals: DataFrame, key: str, ts: str, started: str, ended: str, longest: str) -> DataFrame:
    """Readings of a stream joined with the intervals of another stream that they fall in, ends included.

    Both sides need a watermark, on ``ts`` and ``started``. No interval may last longer than ``longest``: with that bound an
    interval leaves the state when readings can no longer fall in it, and a reading when no interval can begin before it.
    """
    own = intervals.withColumnRenamed(key, "_key")
    inside = (F.col(ts) >= F.col(started)) & (F.col(ts) <= F.col(ended)) & (F.col(ts) <= F.col(started) + F.expr(f"INTERVAL {longest}"))
    return readings.join(own, (F.col(key) == F.col("_key")) & inside).drop("_key")


def latest_per_key(df: DataFrame, key: str, ts: str, tie: str, fields: Sequence[str], ttl: str = "1 day") -> DataFrame:
    """Newest record per key and ``ttl`` of event time, for update mode.

    The watermark of ``df`` drops the state of times that have passed, so a key that falls silent is
    forgotten. Partial results are combined before the shuffle, so a hot road does not land
    in one task row by row. The reader takes the newest of a key's rows.
    """
    newest = F.max_by(F.struct(ts, *fields), F.struct(ts, tie)).alias("r")
    return df.groupBy(key, F.window(ts, ttl).alias("w")).agg(newest).select(
        key, F.col("w.start").alias("window_start"), F.col(f"r.{ts}").alias("updated_at"), *[F.col(f"r.{f}").alias(f) for f in fields]
    )


def diversions(incidents: DataFrame, routes: DataFrame, cell: str) -> DataFrame:
    """Route alerts of an incident stream against the static segment table."""
    return incident_impact(incidents, routes, cell)
