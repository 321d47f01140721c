"""Sensor metrics, alerts and traffic reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions import traffic as R
from tallyfield.functions.dates import clock_parts
from tallyfield.functions.numbers import ratio, rounded, share
from tallyfield.operators.joins import next_after
from tallyfield.operators.ordering import global_percentiles, grouped_percentiles


def enrich(df: DataFrame, speed: str = "measurements.average_speed", count: str = "measurements.vehicle_count",
           occupancy: str = "measurements.occupancy", ts: str = "timestamp") -> DataFrame:
    """Density, congestion level and clock parts; the same for batch and stream."""
    return df.withColumns(
        {
            "traffic_density": R.density(count, occupancy),
            "congestion_level": R.congestion_level(speed),
            **clock_parts(ts),
        }
    )


def road_metrics(df: DataFrame, keys: Sequence[str], speed: str = "average_speed", count: str = "vehicle_count",
                 occupancy: str = "occupancy") -> DataFrame:
    """Mean speed, vehicles and mean occupancy per road; a missing value counts as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return df.groupBy(*keys).agg(
        rounded(F.avg(zero(speed)), 6).alias("avg_speed"),
        F.sum(zero(count).cast("bigint")).alias("total_vehicles"),
        rounded(F.avg(zero(occupancy)), 6).alias("avg_occupancy"),
    )


def city_metrics(df: DataFrame, speed: str = "average_speed", level: str = "congestion_level") -> DataFrame:
    """City-wide row. ``total_sensors`` counts rows, as the reference does."""
    return df.agg(
        F.count(F.lit(1)).alias("total_sensors"),
        rounded(F.avg(R.speed_or_zero(speed)), 6).alias("avg_city_speed"),
        F.count_if(F.col(level) == "Heavy").alias("congestion_areas"),
    )


def batch_summary(df: DataFrame, speed: str = "average_speed", probability: str = "congestion_probability",
                  anomaly: str = "anomaly_score") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_sensors"),
        rounded(F.avg(R.speed_or_zero(speed)), 6).alias("avg_speed"),
        F.count_if(F.col(probability) > R.CONGESTION_SUMMARY).alias("high_congestion_areas"),
        F.count_if(F.col(anomaly) < R.ANOMALY_LIMIT).alias("anomalies"),
    )


def speed_anomalies(df: DataFrame, keep: Sequence[str], speed: str = "average_speed") -> DataFrame:
    """Readings outside 5..120; a missing speed counts as 0 and fires."""
    s = R.speed_or_zero(speed)
    low, high = R.SPEED_RANGE
    return df.where((s < low) | (s > high)).select(F.lit("speed_anomaly").alias("type"), *keep, s.alias("speed"))


def sensor_anomalies(df: DataFrame, keep: Sequence[str], anomaly: str = "anomaly_score") -> DataFrame:
    return df.where(F.col(anomaly) < R.ANOMALY_LIMIT).select(
        F.lit("sensor_anomaly").alias("type"), *keep, F.col(anomaly).alias("anomaly_score")
    )


def high_congestion(df: DataFrame, keep: Sequence[str], probability: str = "congestion_probability",
                    speed: str = "average_speed") -> DataFrame:
    return df.where(F.col(probability) > R.CONGESTION_ALERT).select(
        F.lit("high_congestion").alias("type"),
        *keep,
        F.col(probability).alias("congestion_probability"),
        R.speed_or_zero(speed).alias("current_speed"),
        F.lit("Consider alternative routes").alias("recommendation"),
    )


def potential_incidents(df: DataFrame, keep: Sequence[str], predicted: str = "predicted_traffic",
                        speed: str = "average_speed") -> DataFrame:
    """Speed below 30 % of the prediction; severe below 5."""
    s = R.speed_or_zero(speed)
    return df.where(s < F.col(predicted) * R.SPEED_DROP).select(
        F.lit("potential_incident").alias("type"),
        *keep,
        s.alias("current_speed"),
        F.col(predicted).alias("predicted_speed"),
        F.when(s < R.SPEED_RANGE[0], "high").otherwise("medium").alias("severity"),
    )


def all_alerts(parts: Sequence[DataFrame]) -> DataFrame:
    """Alerts of different shape in one frame; duplicates stay, absent fields are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def robust_zscores(df: DataFrame, key: str, value: str, row_id: str) -> DataFrame:
    """0.6745 (x - median) / MAD per key, with exact medians."""
    present = df.where(F.col(value).isNotNull()).select(key, value, row_id)
    medians = grouped_percentiles(present, [key], value, {"median": 0.5}, row_id)
    spread = present.join(medians, key).withColumn("deviation", F.abs(F.col(value) - F.col("median")))
    mads = grouped_percentiles(spread, [key], "deviation", {"mad": 0.5}, row_id)
    score = F.try_divide(F.lit(0.6745) * (F.col(value) - F.col("median")), F.col("mad"))
    return spread.join(mads, key).select(
        row_id, key, rounded(score, 6).alias("score"), (F.abs(rounded(score, 6)) > 3.5).cast("int").alias("is_anomaly")
    )


def traffic_kpis(df: DataFrame, road: str, ts: str, row_id: str, speed: str = "average_speed",
                 count: str = "vehicle_count") -> DataFrame:
    """Hourly volume, congestion index and travel-time index against the 85th percentile."""
    free_flow = grouped_percentiles(df, [road], speed, {"free_flow": 0.85}, row_id)
    hourly = df.groupBy(road, F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.sum(F.col(count).cast("bigint")).alias("volume"), F.avg(speed).alias("_speed")
    )
    return hourly.join(free_flow, road, "left").select(
        road, "hour", "volume",
        rounded("_speed", 6).alias("mean_speed"),
        rounded(1 - ratio("_speed", "free_flow"), 6).alias("congestion_index"),
        rounded(ratio("free_flow", "_speed"), 6).alias("travel_time_index"),
    )


def speed_variance(df: DataFrame, road: str, ts: str, hours: int = 3, speed: str = "average_speed") -> DataFrame:
    """Deviation of speed over the trailing hours, from hourly counts and sums of squares.

    Speeds are hundredths in 64-bit integers, so the sums are exact and a road has one
    row per hour in the window.
    """
    unit = F.rint(F.col(speed) * 100).cast("bigint")
    hourly = df.groupBy(road, F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count(unit).alias("_n"), F.sum(unit).alias("_s"), F.sum(unit * unit).alias("_q")
    )
    index = F.unix_seconds(F.col("hour").cast("timestamp")) / 3600
    trail = Window.partitionBy(road).orderBy(index.cast("bigint")).rangeBetween(-(hours - 1), 0)
    n, s, q = (F.sum(c).over(trail) for c in ("_n", "_s", "_q"))
    return hourly.select(road, "hour", n.alias("n"), s.alias("_s"), q.alias("_q")).select(
        road, "hour", "n",
        rounded(ratio("_s", "n") / 100, 6).alias("mean_speed"),
        rounded(F.sqrt(F.try_divide(F.col("n") * F.col("_q") - F.col("_s") * F.col("_s"),
                                    F.col("n") * (F.col("n") - 1)).cast("double")) / 100, 6).alias("sd_speed"),
    )


def emissions(df: DataFrame, keys: Sequence[str], classes: str, factors: dict[str, float]) -> DataFrame:
    """Vehicles per class times a factor; the factor table is a literal map."""
    factor = F.create_map(*[F.lit(x) for item in factors.items() for x in item])
    per_class = df.select(*keys, F.explode(classes).alias("vehicle_class", "vehicles")).groupBy(
        *keys, "vehicle_class"
    ).agg(F.sum(F.col("vehicles").cast("bigint")).alias("vehicles"))
    grams = F.col("vehicles") * F.try_element_at(factor, F.col("vehicle_class"))
    return per_class.withColumn("emission", rounded(grams, 4))


def response_times(incidents: DataFrame, responses: DataFrame, key: str, ts: str, incident_id: str) -> DataFrame:
    """Mean and 90th percentile of the seconds until the first later response."""
    found = next_after(incidents, responses, key, ts, incident_id, "_response")
    micros = F.unix_micros(F.col("_response").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    waits = found.select(incident_id, micros.alias("_wait"))
    p90 = global_percentiles(waits, {"wait": F.col("_wait")}, [0.9], incident_id)["wait"][0]
    return waits.agg(
        F.count(F.lit(1)).alias("incidents"),
        F.count("_wait").alias("answered"),
        rounded(F.sum("_wait") / F.count("_wait") / F.lit(1e6), 3).alias("mean_seconds"),
    ).withColumn("p90_seconds", rounded(F.lit(p90) / F.lit(1e6), 3))


def hotspots(df: DataFrame, road: str, ts: str, level: str, top: int = 5) -> DataFrame:
    """Roads with the largest share of heavy readings for each hour of the day.

    A top-k report: the rank limit is applied before the shuffle as well.
    """
    shares = df.groupBy(F.hour(ts).alias("hour"), road).agg(
        F.count(F.lit(1)).alias("n"), share(F.count_if(F.col(level) == "Heavy"), F.count(F.lit(1))).alias("heavy_share")
    )
    place = F.row_number().over(Window.partitionBy("hour").orderBy(F.desc("heavy_share"), F.desc("n"), road))
    return shares.withColumn("place", place).where(F.col("place") <= top)


def volume_correlation(df: DataFrame, ts: str, volume: str, measure: Column) -> DataFrame:
    """Correlation of hourly volume with an hourly mean."""
    hourly = df.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.sum(F.col(volume).cast("bigint")).alias("v"), F.avg(measure).alias("m")
    )
    return hourly.agg(F.count(F.lit(1)).alias("hours"), rounded(F.corr("v", "m"), 6).alias("correlation"))
