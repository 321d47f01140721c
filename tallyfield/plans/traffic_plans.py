"""Sensor metric and traffic report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import traffic as R
from tallyfield.operators import traffic as T
from tallyfield.plans.bindings import SENSORS_SQL, messages, readings
from tallyfield.plans.feature_plans import LEVEL_SQL
from tallyfield.plans.quality_plans import SCORED_SQL, scored_readings
from tallyfield.plans.registry import Tables, query
from tallyfield.sources.messages import parse_json


@query(
    "road_metrics",
    f"""WITH {SENSORS_SQL} SELECT road_id, lane_id, round_even(AVG(COALESCE(average_speed, 0)), 6) AS avg_speed,
    CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles, round_even(AVG(occupancy), 6) AS avg_occupancy FROM readings GROUP BY 1, 2""",
)
def road_metrics(t: Tables) -> DataFrame:
    return T.road_metrics(readings(t), ["road_id", "lane_id"])


@query(
    "city_metrics",
    f"""WITH {SENSORS_SQL} SELECT COUNT(*) AS total_sensors, round_even(AVG(COALESCE(average_speed, 0)), 6) AS avg_city_speed,
    COUNT(*) FILTER (average_speed < 15) AS congestion_areas FROM readings""",
)
def city_metrics(t: Tables) -> DataFrame:
    return T.city_metrics(readings(t).withColumn("congestion_level", R.congestion_level("average_speed")))


@query(
    "batch_summary",
    f"""WITH {SCORED_SQL} SELECT COUNT(*) AS total_sensors, round_even(AVG(COALESCE(average_speed, 0)), 6) AS avg_speed,
    COUNT(*) FILTER (congestion_probability > 0.7) AS high_congestion_areas, COUNT(*) FILTER (anomaly_score < -0.5) AS anomalies FROM scored""",
)
def batch_summary(t: Tables) -> DataFrame:
    return T.batch_summary(scored_readings(t))


@query(
    "robust_zscore_anomaly",
    f"""WITH {SENSORS_SQL}, p AS (SELECT event_id, sensor_id, average_speed FROM readings WHERE average_speed IS NOT NULL),
    m AS (SELECT sensor_id, quantile_cont(average_speed, 0.5) AS med FROM p GROUP BY 1),
    d AS (SELECT p.*, med, abs(average_speed - med) AS dev FROM p JOIN m USING (sensor_id)),
    a AS (SELECT sensor_id, quantile_cont(dev, 0.5) AS mad FROM d GROUP BY 1)
    SELECT event_id, d.sensor_id, round_even(0.6745 * (average_speed - med) / nullif(mad, 0), 6) AS score,
    CAST(abs(round_even(0.6745 * (average_speed - med) / nullif(mad, 0), 6)) > 3.5 AS INTEGER) AS is_anomaly FROM d JOIN a ON d.sensor_id = a.sensor_id""",
)
def robust_zscore_anomaly(t: Tables) -> DataFrame:
    return T.robust_zscores(readings(t), "sensor_id", "average_speed", "event_id")


@query(
    "traffic_kpis",
    f"""WITH {SENSORS_SQL}, f AS (SELECT road_id, quantile_cont(average_speed, 0.85) AS free FROM readings GROUP BY 1),
    h AS (SELECT road_id, date_trunc('hour', ts) AS hour, CAST(SUM(vehicle_count) AS BIGINT) AS volume, AVG(average_speed) AS s FROM readings GROUP BY 1, 2)
    SELECT h.road_id, hour, volume, round_even(s, 6) AS mean_speed, round_even(1 - s / free, 6) AS congestion_index,
    round_even(free / nullif(s, 0), 6) AS travel_time_index FROM h JOIN f ON h.road_id = f.road_id""",
)
def traffic_kpis(t: Tables) -> DataFrame:
    return T.traffic_kpis(readings(t), "road_id", "ts", "event_id")


@query(
    "correlation",
    f"""WITH {SENSORS_SQL}, h AS (SELECT date_trunc('hour', ts) AS hour, CAST(SUM(vehicle_count) AS BIGINT) AS v, AVG(queue_length) AS m FROM readings GROUP BY 1)
    SELECT COUNT(*) AS hours, round_even(corr(v, m), 6) AS correlation FROM h""",
)
def correlation(t: Tables) -> DataFrame:
    return T.volume_correlation(readings(t), "ts", "vehicle_count", F.col("queue_length"))


@query(
    "speed_variance_features",
    f"""WITH {SENSORS_SQL}, u AS (SELECT road_id, date_trunc('hour', ts) AS hour, CAST(round_even(average_speed * 100, 0) AS BIGINT) AS x FROM readings),
    h AS (SELECT DISTINCT road_id, hour FROM u)
    SELECT h.road_id, h.hour, COUNT(x) AS n, round_even(CAST(SUM(x) AS DOUBLE) / nullif(COUNT(x), 0) / 100, 6) AS mean_speed,
    round_even(sqrt(CAST(COUNT(x) * SUM(x * x) - SUM(x) * SUM(x) AS DOUBLE) / nullif(COUNT(x) * (COUNT(x) - 1), 0)) / 100, 6) AS sd_speed
    FROM h JOIN u ON h.road_id = u.road_id AND u.hour BETWEEN h.hour - INTERVAL 2 HOUR AND h.hour GROUP BY 1, 2""",
)
def speed_variance_features(t: Tables) -> DataFrame:
    return T.speed_variance(readings(t), "road_id", "ts", 3)


# Our own factors; the reference names the measure only.
FACTORS = {"car": 0.12, "truck": 0.9}


@query(
    "emission_estimate",
    f"""WITH {SENSORS_SQL}, ok AS (SELECT * FROM readings WHERE NOT (road_id = 'error' AND vehicle_count % 5 = 0)),
    c AS (SELECT road_id, 'car' AS vehicle_class, CAST(SUM(vehicle_count) AS BIGINT) AS vehicles FROM ok GROUP BY 1
      UNION ALL SELECT road_id, 'truck', CAST(SUM(vehicle_count % 7) AS BIGINT) FROM ok GROUP BY 1)
    SELECT road_id, vehicle_class, vehicles, round_even(vehicles * CASE vehicle_class WHEN 'car' THEN CAST(0.12 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END, 4) AS emission FROM c""",
)
def emission_estimate(t: Tables) -> DataFrame:
    parsed = parse_json(messages(t), R.TRAFFIC_SCHEMA).where(F.col("sensor_id").isNotNull())
    return T.emissions(
        parsed.select("location.road_id", "vehicle_classification"), ["road_id"], "vehicle_classification", FACTORS
    )


@query(
    "response_time",
    f"""WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), r AS (SELECT user_id, ts FROM events WHERE event_type = 'click'),
    w AS (SELECT e.event_id, e.ts, MIN(r.ts) AS answer FROM e LEFT JOIN r ON r.user_id = e.user_id AND r.ts > e.ts GROUP BY 1, 2),
    s AS (SELECT epoch_us(answer) - epoch_us(ts) AS wait FROM w)
    SELECT COUNT(*) AS incidents, COUNT(wait) AS answered, round_even(CAST(SUM(wait) AS DOUBLE) / COUNT(wait) / 1e6, 3) AS mean_seconds,
    round_even(quantile_cont(CAST(wait AS DOUBLE), 0.9) / 1e6, 3) AS p90_seconds FROM s""",
)
def response_time(t: Tables) -> DataFrame:
    incidents = t.events.where(F.col("event_type") == "error").select("user_id", "ts", "event_id")
    responses = t.events.where(F.col("event_type") == "click").select("user_id", "ts")
    return T.response_times(incidents, responses, "user_id", "ts", "event_id")


@query(
    "hotspots",
    f"""WITH {SENSORS_SQL}, g AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, sensor_id, COUNT(*) AS n,
      round_even(COUNT(*) FILTER ({LEVEL_SQL} = 'Heavy') / CAST(COUNT(*) AS DOUBLE), 6) AS heavy_share FROM readings GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY hour ORDER BY heavy_share DESC, n DESC, sensor_id) AS INTEGER) AS place FROM g)
    SELECT * FROM r WHERE place <= 5""",
)
def hotspots(t: Tables) -> DataFrame:
    rows = readings(t).withColumn("congestion_level", R.congestion_level("average_speed"))
    return T.hotspots(rows, "sensor_id", "ts", "congestion_level")
