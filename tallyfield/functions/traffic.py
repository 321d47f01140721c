"""Sensor expressions: message schemas, density, congestion level, feature defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAFFIC_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "location",
            T.StructType()
            .add("latitude", T.DoubleType())
            .add("longitude", T.DoubleType())
            .add("road_id", T.StringType())
            .add("lane_id", T.StringType()),
        ),
        T.StructField(
            "measurements",
            T.StructType()
            .add("vehicle_count", T.IntegerType())
            .add("average_speed", T.DoubleType())
            .add("occupancy", T.DoubleType())
            .add("queue_length", T.DoubleType()),
        ),
        T.StructField("vehicle_classification", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField(
            "weather_conditions",
            T.StructType()
            .add("temperature", T.DoubleType())
            .add("humidity", T.DoubleType())
            .add("visibility", T.DoubleType())
            .add("precipitation", T.DoubleType()),
        ),
    ]
)

INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("incident_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "location",
            T.StructType().add("latitude", T.DoubleType()).add("longitude", T.DoubleType()),
        ),
        T.StructField("incident_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("lanes_affected", T.IntegerType()),
        T.StructField("estimated_duration", T.IntegerType()),
    ]
)

# Speed limits of the congestion levels.
CONGESTION = ([15, 30, 50], ["Heavy", "Moderate", "Light", "Free Flow"])

# Scoring features in model order with the value a missing field takes.
FEATURE_DEFAULTS = {
    "vehicle_count": 0.0,
    "average_speed": 0.0,
    "occupancy": 0.0,
    "queue_length": 0.0,
    "hour": 0.0,
    "day_of_week": 0.0,
    "is_weekend": 0.0,
    "temperature": 20.0,
    "humidity": 50.0,
    "precipitation": 0.0,
}

ANOMALY_LIMIT = -0.5
CONGESTION_ALERT = 0.8
CONGESTION_SUMMARY = 0.7
SPEED_DROP = 0.3
SPEED_RANGE = (5, 120)


def density(count: Column | str, occupancy: Column | str) -> Column:
    """Vehicles per unit of occupancy; NULL when nothing occupies the road."""
    return F.try_divide(_col(count), _col(occupancy))


def congestion_level(speed: Column | str, unknown: bool = False) -> Column:
    """Level by speed. A missing speed reads as free flow, or as Unknown on request."""
    limits, labels = CONGESTION
    s = _col(speed)
    out = F.when(s.isNull(), "Unknown") if unknown else F.when(s < limits[0], labels[0])
    for limit, label in zip(limits, labels):
        out = out.when(s < limit, label)
    return out.otherwise(labels[-1])


def speed_or_zero(speed: Column | str) -> Column:
    return F.coalesce(_col(speed), F.lit(0.0))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
