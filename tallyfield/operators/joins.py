"""Join shapes of the extracts: star joins with key checks, as-of joins, route impact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.operators.quality import QualityError, duplicate_rows
from tallyfield.operators.timeline import carry


def star_join(fact: DataFrame, satellites: Sequence[tuple[str, DataFrame, str]], verify: bool = False) -> DataFrame:
    """Left-join (name, frame, key) satellites to a fact.

    A repeated key on the right would multiply fact rows silently. ``verify`` counts such
    keys first; leave it off for satellites that are aggregated by their key.
    """
    out = fact
    for name, satellite, key in satellites:
        if verify:
            failed = duplicate_rows(satellite, [key]).first()["failed"]
            if failed:
                raise QualityError(f"{name}: {failed} rows repeat {key}")
        out = out.join(satellite, key, "left")
    return out


def with_own_base(small: DataFrame, key: str, period: str, measure: str, base: str) -> DataFrame:
    """The measure of period 0 of the same key on every row; NULL when there is none.

    ``small`` has one row per (key, period), so a window replaces a self-join that would
    compute the frame twice.
    """
    origin = F.max(F.when(F.col(period) == 0, F.col(measure))).over(Window.partitionBy(key))
    return small.withColumn(base, origin)


def latest_before(readings: DataFrame, markers: DataFrame, key: str, ts: str, tie: str, at: str,
                  marker_id: str, values: Mapping[str, str]) -> DataFrame:
    """For each marker the last reading of the same key at or before it.

    Readings and markers are merged into one time line and the reading is carried forward,
    so no pairs are formed and a hot key is split over many tasks.
    """
    shape = readings.schema
    line = readings.select(
        key, F.col(ts).alias("_t"), F.lit(0).alias("_kind"), F.col(tie).cast("bigint").alias("_tie"),
        F.lit(None).cast("bigint").alias(marker_id), F.struct(*[F.col(c).alias(n) for n, c in values.items()]).alias("_v"),
    ).unionByName(
        markers.select(
            key, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.col(marker_id).cast("bigint").alias("_tie"),
            F.col(marker_id).cast("bigint").alias(marker_id),
            F.lit(None).cast("struct<" + ",".join(f"{n}:{shape[c].dataType.simpleString()}" for n, c in values.items()) + ">").alias("_v"),
        )
    )
    seen = carry(line, [key], ["_t", "_kind", "_tie"], {"_seen": F.col("_v")})
    return seen.where(F.col("_kind") == 1).select(
        key, marker_id, F.col("_t").alias(at), *[F.col("_seen").getField(n).alias(n) for n in values]
    )


def next_after(events: DataFrame, responses: DataFrame, key: str, ts: str, event_id: str, out: str) -> DataFrame:
    """Time of the first response of the same key strictly after each event."""
    line = responses.select(
        key, F.col(ts).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias(event_id),
        F.col(ts).alias("_v"),
    ).unionByName(
        events.select(
            key, F.col(ts).alias("_t"), F.lit(1).alias("_kind"), F.col(event_id).cast("bigint").alias(event_id),
            F.lit(None).cast(responses.schema[ts].dataType).alias("_v"),
        )
    )
    seen = carry(line, [key], ["_t", "_kind"], {out: F.col("_v")}, forward=False)
    return seen.where(F.col("_kind") == 1).select(key, event_id, F.col("_t").alias(ts), out)


def incident_impact(incidents: DataFrame, routes: DataFrame, cell: str, extra: Sequence[str] = ()) -> DataFrame:
    """One diversion record per (incident, affected route) sharing a road or grid cell.

    An incident whose cell has no route gives one record of type ``no_route``, so none is lost.
    Works with a streaming left side; ``routes`` is a static segment table.
    """
    return incidents.join(routes, cell, "left").select(
        F.when(F.col("route_id").isNull(), "no_route").otherwise("route_diversion").alias("type"),
        "incident_id",
        F.col("route_id").alias("affected_route"),
        "alternative_routes",
        F.col("estimated_duration").alias("estimated_delay"),
        *extra,
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, for a distance test behind the grid-cell join."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(a))
