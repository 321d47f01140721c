"""Streaming queries: the event table is read as a file stream until it is used up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators import traffic as T
from tallyfield.plans.bindings import SENSORS_SQL, messages, readings
from tallyfield.plans.feature_plans import LEVEL_SQL
from tallyfield.plans.history_plans import ALL_IMPACT_SQL, IMPACT_SQL, STAY_SQL, incidents, route_segments, route_table, stays
from tallyfield.plans.mart_plans import SESSION_SQL
from tallyfield.plans.quality_plans import KEEP, SCORED_SQL, scored_readings
from tallyfield.plans.registry import Tables, query
from tallyfield.session import load, work_folder
from tallyfield.sources.messages import as_messages, file_stream
from tallyfield.streaming import flows as S
from tallyfield.streaming import jobs as J
from tallyfield.streaming import state


class Live(Tables):
    """The tables with ``events`` as a stream."""

    def __getattr__(self, name: str) -> DataFrame:
        if name == "events":
            schema = load(self.spark, self.base, name).schema
            return file_stream(self.spark, self.base, schema, f"{name}.parquet")
        return super().__getattr__(name)


def live(t: Tables) -> Live:
    return Live(t.spark, t.base)


def drain(t: Tables, stream: DataFrame) -> DataFrame:
    """Append-mode output of all available data."""
    root = work_folder(t.spark, "stream")
    J.finish(J.start(stream, f"{root}/checkpoint", None, folder=f"{root}/out"))
    return t.spark.read.schema(stream.schema).parquet(f"{root}/out")


def drain_updates(t: Tables, stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-mode output, newest version per key."""
    root = work_folder(t.spark, "stream")
    J.finish(J.start(stream, f"{root}/checkpoint", None, "update", each=J.append_batches(f"{root}/out")))
    return J.latest_rows(t.spark, f"{root}/out", keys)


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "stream_enrich",
    f"""WITH {SENSORS_SQL} SELECT event_id, sensor_id, CASE WHEN occupancy = 0 THEN NULL ELSE vehicle_count / occupancy END AS traffic_density,
    {LEVEL_SQL} AS congestion_level, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM readings WHERE NOT (road_id = 'error' AND vehicle_count % 5 = 0)""",
)
def stream_enrich(t: Tables) -> DataFrame:
    flow = S.traffic_flow(messages(live(t)), keep=["event_id"]).where(F.col("sensor_id").isNotNull())
    return drain(
        t, flow.select("event_id", "sensor_id", "traffic_density", "congestion_level", "hour", "day_of_week", "is_weekend")
    )


@query("stream_source", "SELECT event_type, COUNT(*) AS n, MAX(ts) AS last_ts FROM events GROUP BY 1")
def stream_source(t: Tables) -> DataFrame:
    """The file source; topics use ``kafka_stream`` with the same flows behind it."""
    return drain(t, live(t).events.select("event_id", "event_type", "ts")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")
    )


def window_sql(size: int, slide: int) -> str:
    shifts = " UNION ALL ".join(
        f"SELECT *, time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL {k * slide} MINUTE AS window_start FROM readings"
        for k in range(size // slide)
    )
    return f"""WITH {SENSORS_SQL}, w AS ({shifts})
    SELECT road_id, window_start, window_start + INTERVAL {size} MINUTE AS window_end, COUNT(*) AS readings,
    round_even(CAST(SUM(CAST(round_even(COALESCE(average_speed, 0) * 100, 0) AS BIGINT)) AS DOUBLE) / 100 / COUNT(*), 6) AS avg_speed,
    CAST(SUM(vehicle_count) AS BIGINT) AS total_vehicles,
    round_even(CAST(SUM(CAST(round_even(occupancy * 100, 0) AS BIGINT)) AS DOUBLE) / 100 / COUNT(*), 6) AS avg_occupancy FROM w GROUP BY 1, 2"""


@query("tumbling_window", window_sql(5, 5))
def tumbling_window(t: Tables) -> DataFrame:
    metrics = S.window_metrics(S.timed(readings(live(t)), "ts"), "ts", "5 minutes", ["road_id"])
    out = drain_updates(t, metrics, ["road_id", "window_start", "window_end"])
    return plain_time(out, "window_start", "window_end")


@query("sliding_window", window_sql(10, 5))
def sliding_window(t: Tables) -> DataFrame:
    metrics = S.window_metrics(S.timed(readings(live(t)), "ts"), "ts", "10 minutes", ["road_id"], "5 minutes")
    out = drain_updates(t, metrics, ["road_id", "window_start", "window_end"])
    return plain_time(out, "window_start", "window_end")


@query(
    "session_window",
    f"WITH {SESSION_SQL} SELECT user_id, session_start, session_end + INTERVAL 30 MINUTE AS session_end, pages_viewed, conversion_flag FROM sess",
)
def session_window(t: Tables) -> DataFrame:
    """All sessions: append mode gives a session out once, when the watermark has passed its end, and a closing event at the end of
    the input moves the watermark past those still open."""
    sessions = lambda events: S.session_metrics(S.timed(events, "ts"), "ts", "user_id")
    events = live(t).events.select("user_id", "ts", "event_type")
    return plain_time(J.drain_closed(events, "ts", sessions, "1 HOUR", work_folder(t.spark, "sessions")), "session_start", "session_end")


@query(
    "stream_interval_join",
    f"""WITH {STAY_SQL} SELECT s.sensor_id, s.incident_id, COUNT(r.event_id) AS readings_count, CAST(SUM(r.vehicle_count) AS BIGINT) AS vehicles
    FROM stay s JOIN readings r ON r.sensor_id = s.sensor_id AND r.ts BETWEEN s.started AND s.ended GROUP BY 1, 2""",
)
def stream_interval_join(t: Tables) -> DataFrame:
    """The readings stream joined with the incident stream; what falls in an incident is counted when both have drained."""
    seen = S.timed(readings(live(t)).select("event_id", "sensor_id", "ts", "vehicle_count"), "ts")
    lasting = S.timed(stays(live(t)), "started").withColumn("ended", F.col("ended").cast("timestamp"))
    found = drain(t, S.within_intervals(seen, lasting, "sensor_id", "ts", "started", "ended", "12 HOURS"))
    return found.groupBy("sensor_id", "incident_id").agg(F.count("event_id").alias("readings_count"), F.sum(F.col("vehicle_count").cast("bigint")).alias("vehicles"))


@query(
    "watermark_late_drop",
    """WITH late AS (SELECT event_type, ts FROM events WHERE event_id % 3 = 0),
    closed AS (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL 5 MINUTE AS edge FROM events)
    SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (is_late) AS late FROM (SELECT event_type, FALSE AS is_late FROM events
      UNION ALL SELECT event_type, TRUE FROM late WHERE ts > (SELECT edge FROM closed)) GROUP BY 1""",
)
def watermark_late_drop(t: Tables) -> DataFrame:
    """All events arrive, then a third of them again under new ids, most of them far behind the watermark.

    The second delivery is another run on the same checkpoint; the watermark that the first run left drops
    what is older than it and lets the rest through.
    """
    root = work_folder(t.spark, "late")
    events = t.events.select("event_id", "event_type", "ts", F.lit(False).alias("is_late"))
    late = events.where("event_id % 3 = 0").withColumns({"event_id": -F.col("event_id") - 1, "is_late": F.lit(True)})
    for delivery in (events, late):
        delivery.write.mode("append").parquet(f"{root}/in")
        flow = S.without_repeats(S.timed(file_stream(t.spark, f"{root}/in", events.schema), "ts"), ["event_id"])
        J.finish(J.start(flow, f"{root}/checkpoint", None, folder=f"{root}/out"))
    return t.spark.read.parquet(f"{root}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_late")).alias("late")
    )


@query("stream_dedup", "SELECT event_id, event_type, value FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """Every event is delivered twice and kept once."""
    doubled = S.timed(live(t).events, "ts").withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return drain(t, S.without_repeats(doubled, ["event_id"]).select("event_id", "event_type", "value"))


@query(
    "route_diversion",
    f"""WITH {IMPACT_SQL} SELECT 'route-alerts' AS topic, CAST(incident_id AS VARCHAR) AS key, type, incident_id, affected_route, estimated_delay FROM impact""",
)
def route_diversion(t: Tables) -> DataFrame:
    """Diversions on the stream; incidents without a route come out as such."""
    return diversion_alerts(t, route_table(t))


@query(
    "route_diversion_all_routes",
    f"""WITH {ALL_IMPACT_SQL} SELECT 'route-alerts' AS topic, CAST(incident_id AS VARCHAR) AS key, type, incident_id, affected_route, estimated_delay FROM impact""",
)
def route_diversion_all_routes(t: Tables) -> DataFrame:
    """As ``route_diversion``, with every supplier as a route."""
    return diversion_alerts(t, route_segments(t.supplier))


def diversion_alerts(t: Tables, routes: DataFrame) -> DataFrame:
    found = S.diversions(incidents(live(t).events), routes, "cell")
    alerts = drain(t, as_messages(found, "route-alerts", "incident_id"))
    fields = F.from_json("value", "type string, incident_id bigint, affected_route string, estimated_delay int")
    return alerts.select("topic", "key", fields.alias("f")).select("topic", "key", "f.*")


@query(
    "stream_latest_state",
    f"""WITH {SENSORS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS r FROM readings)
    SELECT sensor_id, ts AS updated_at, average_speed, vehicle_count FROM n WHERE r = 1""",
)
def stream_latest_state(t: Tables) -> DataFrame:
    flow = S.latest_per_key(S.timed(readings(live(t)), "ts"), "sensor_id", "ts", "event_id", ["average_speed", "vehicle_count"])
    rows = drain_updates(t, flow, ["sensor_id", "window_start"])
    newest = rows.groupBy("sensor_id").agg(F.max_by(F.struct("updated_at", "average_speed", "vehicle_count"), "updated_at").alias("r"))
    return plain_time(newest.select("sensor_id", "r.*"), "updated_at")


@query(
    "stream_expiring_state",
    f"""WITH {SENSORS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS r FROM readings)
    SELECT sensor_id, ts AS updated_at, average_speed, vehicle_count,
      date_trunc('milliseconds', ts) + INTERVAL 10 MINUTE <= (SELECT date_trunc('milliseconds', MAX(ts)) FROM readings) - INTERVAL 5 MINUTE AS is_expired FROM n WHERE r = 1""",
)
def stream_expiring_state(t: Tables) -> DataFrame:
    """The newest reading of each sensor from state that ends ten minutes after it."""
    flow = state.expiring_latest(readings(live(t)), "sensor_id", "ts", "event_id", ["average_speed", "vehicle_count"], J.WATERMARK)
    with state.timers(t.spark):
        rows = drain_updates(t, flow, ["sensor_id"])
    return plain_time(rows.withColumnRenamed("ts", "updated_at"), "updated_at")


@query(
    "history_append",
    f"""WITH {SCORED_SQL} SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS n,
    CAST(SUM(CAST(round_even(congestion_probability * 10000, 0) AS BIGINT)) AS BIGINT) AS probability_sum FROM scored GROUP BY 1""",
)
def history_append(t: Tables) -> DataFrame:
    root = work_folder(t.spark, "history")
    J.finish(J.start(scored_readings(live(t)), f"{root}/checkpoint", None, each=J.history_append(f"{root}/out", "ts")))
    return t.spark.read.parquet(f"{root}/out").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.rint(F.col("congestion_probability") * 10000).cast("bigint")).alias("probability_sum"),
    )


@query(
    "foreach_batch",
    f"""WITH {SCORED_SQL} SELECT 'alerts' AS output, COUNT(*) AS n FROM scored WHERE congestion_probability > 0.8
    UNION ALL SELECT 'history', COUNT(*) FROM scored""",
)
def foreach_batch(t: Tables) -> DataFrame:
    """One batch feeds the history and the alert topic; it is computed once."""
    root = work_folder(t.spark, "fan")
    keep_history = J.append_batches(f"{root}/history")
    keep_alerts = J.append_batches(f"{root}/alerts")

    def alerts(batch: DataFrame, batch_id: int) -> None:
        keep_alerts(as_messages(T.high_congestion(batch, KEEP), "traffic-alerts", "sensor_id"), batch_id)

    each = J.fan_out({"history": keep_history, "alerts": alerts})
    J.finish(J.start(scored_readings(live(t)), f"{root}/checkpoint", None, each=each))
    counts = [
        t.spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n"))
        for name in ("alerts", "history")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "micro_batch_triggers",
    "SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY 1",
)
def micro_batch_triggers(t: Tables) -> DataFrame:
    """The same job under a processing-time trigger; it is stopped when the input is used up."""
    root = work_folder(t.spark, "trigger")
    stream = live(t).events.select("event_id", "event_type", "value")
    running = J.start(stream, f"{root}/checkpoint", "1 second", folder=f"{root}/out")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.parquet(f"{root}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.rint(F.col("value") * 100).cast("bigint")) / F.lit(100.0)).alias("value")
    )


@query(
    "progress_metrics",
    "SELECT COUNT(*) AS processed_messages, TRUE AS has_batches, TRUE AS has_batch_time, TRUE AS has_uptime, TRUE AS has_rate FROM events",
)
def progress_metrics(t: Tables) -> DataFrame:
    """The messages are exact; the times are measured, so only their signs can be compared."""
    root = work_folder(t.spark, "progress")
    with J.progress_totals(t.spark) as totals:
        done = J.finish(J.start(live(t).events, f"{root}/checkpoint", None, folder=f"{root}/out", name=None))
        report = totals.report(t.spark, done)
    return report.select(
        "processed_messages", (F.col("batches") > 0).alias("has_batches"), (F.col("average_processing_millis") > 0).alias("has_batch_time"),
        (F.col("uptime_seconds") >= 0).alias("has_uptime"), (F.col("messages_per_second") > 0).alias("has_rate"),
    )


@query(
    "multi_query_lifecycle",
    "SELECT 'incidents' AS stream, COUNT(*) AS n FROM events WHERE event_type = 'error' UNION ALL SELECT 'traffic', COUNT(*) FROM events",
)
def multi_query_lifecycle(t: Tables) -> DataFrame:
    """Two queries run side by side and are stopped together."""
    root = work_folder(t.spark, "two")
    flows = {"traffic": live(t).events, "incidents": live(t).events.where(F.col("event_type") == "error")}
    started = [
        J.start(flow, f"{root}/{name}-checkpoint", "1 second", folder=f"{root}/{name}") for name, flow in flows.items()
    ]
    try:
        for one in started:
            one.processAllAvailable()
    finally:
        J.run_until_any_stops(t.spark, started, timeout=0.1)
    counts = [
        t.spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("stream"), F.count(F.lit(1)).alias("n"))
        for name in flows
    ]
    return counts[0].unionByName(counts[1])
