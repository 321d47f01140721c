"""Message topics: reading JSON streams, writing JSON records, latest state with expiry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topic names.
TRAFFIC_TOPIC, INCIDENT_TOPIC = "traffic-sensors", "traffic-incidents"
TRAFFIC_ALERTS, INCIDENT_ALERTS, ROUTE_ALERTS = "traffic-alerts", "incident-alerts", "route-alerts"

# Key patterns and lifetimes of the cached metrics.
ROAD_KEY, ROAD_TTL = "traffic:real_time:", "INTERVAL 10 MINUTES"
CITY_KEY, CITY_TTL = "traffic:city_metrics", "INTERVAL 5 MINUTES"
SUMMARY_KEY, SUMMARY_TTL = "traffic:summary:", "INTERVAL 24 HOURS"


def kafka_options(servers: str, topic: str, per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest"}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """Messages of a topic with a string ``value``; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, per_trigger)).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*",
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def parse_json(raw: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Message text to columns; malformed text gives NULL in every field."""
    return raw.select(*keep, F.from_json(F.col(value), schema).alias("data")).select(*keep, "data.*")


def parse_checked(raw: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """As ``parse_json``, with the text of a message that does not fit the schema in ``rejected``.

    One parse gives both: NULL in ``rejected`` marks the good rows. Text that is no JSON, JSON of another
    shape and fields of another type are all rejected, as is a NULL message (as the empty text).
    """
    checked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    data = F.from_json(F.col(value), checked, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = raw.select(*keep, F.col(value).alias("_raw"), data.alias("data"))
    bad = F.when(F.col("data").isNull() | F.col("data._corrupt").isNotNull(), F.coalesce("data._corrupt", "_raw", F.lit("")))
    return parsed.select(*keep, *[F.col(f"data.{f.name}") for f in schema.fields], bad.alias("rejected"))


def rejected(raw: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The messages that do not fit the schema, for a side output."""
    return parse_checked(raw, schema, value, keep).where(F.col("rejected").isNotNull()).select(*keep, "rejected")


def as_messages(alerts: DataFrame, topic: str, key: str) -> DataFrame:
    """Records as (topic, key, JSON value). NULL fields are left out of the JSON."""
    return alerts.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*alerts.columns)).alias("value"),
    )


def write_topics(messages: DataFrame, servers: str, checkpoint: str):
    """Stream records to the topic each row names."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def latest_state(updates: DataFrame, key: Column, ts: str, tie: str, fields: Sequence[str], ttl: str,
                 as_of: Column) -> DataFrame:
    """Newest record per key that has not expired at ``as_of``."""
    newest = updates.groupBy(key.alias("key")).agg(
        F.max_by(F.struct(ts, *fields), F.struct(ts, tie)).alias("record")
    )
    return (
        newest.select("key", *[F.col(f"record.{f}").alias(f) for f in fields], F.col(f"record.{ts}").alias("updated_at"))
        .withColumn("expires_at", F.col("updated_at") + F.expr(ttl))
        .where(F.col("expires_at") > as_of)
    )
