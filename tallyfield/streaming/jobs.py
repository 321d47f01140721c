"""Running streams: triggers, idempotent sinks, fan-out, progress and shutdown."""

from __future__ import annotations

import contextlib
import datetime as dt
import threading
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Micro-batch intervals and the watermark of the two streams.
TRAFFIC_TRIGGER, INCIDENT_TRIGGER = "10 seconds", "5 seconds"
WATERMARK = "5 minutes"

BATCH = "batch_id"


def start(stream: DataFrame, checkpoint: str, interval: str | None, mode: str = "append",
          each: Callable[[DataFrame, int], None] | None = None, folder: str | None = None,
          name: str | None = None) -> StreamingQuery:
    """Start a stream into a folder or a per-batch function.

    ``interval`` of None takes all available data and stops. The checkpoint is a folder on
    shared storage, so a restarted job goes on where it stopped.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    if each is not None:
        return writer.foreachBatch(each).start()
    return writer.format("parquet").option("path", folder).start()


def finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def last_watermark(query: StreamingQuery) -> dt.datetime | None:
    """How far event time has come behind the delay, or None if nothing has arrived."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in (p["eventTime"] or {})]
    latest = max((dt.datetime.fromisoformat(m.replace("Z", "+00:00")) for m in marks), default=None)
    return latest if latest and latest.timestamp() > 0 else None


def drain_closed(events: DataFrame, ts: str, flow: Callable[[DataFrame], DataFrame], ahead: str, root: str) -> DataFrame:
    """All that ``flow`` gives in append mode for a stream of events, with what is still open when the input ends.

    The stream runs over its input, then once more with an event that moves its watermark past everything open. That event is
    empty but for its time, which lies ``ahead`` of the watermark; its own window stays open. ``ahead`` must
    exceed twice the delay and the longest gap.
    """
    spark, schema = events.sparkSession, events.schema
    spark.createDataFrame([], schema).write.parquet(f"{root}/closing")
    out = flow(events.union(spark.readStream.schema(schema).parquet(f"{root}/closing")))
    run = lambda: finish(start(out, f"{root}/checkpoint", None, folder=f"{root}/out"))
    mark = last_watermark(run())
    if mark is not None:
        time_ = (F.lit(mark).cast("timestamp") + F.expr(f"INTERVAL {ahead}")).cast(schema[ts].dataType)
        event = spark.range(1).select(*[(time_ if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
        event.write.mode("append").parquet(f"{root}/closing")
        run()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def append_batches(folder: str, partitions: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A batch function that can run twice: a batch replaces only its own partitions."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn(BATCH, F.lit(batch_id))
            .write.partitionBy(*partitions, BATCH)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(folder)
        )

    return write


def history_append(folder: str, ts: str) -> Callable[[DataFrame, int], None]:
    """Keep every scored record by event date and batch."""
    write = append_batches(folder, ["event_date"])

    def keep(batch: DataFrame, batch_id: int) -> None:
        write(batch.withColumn("event_date", F.to_date(ts)), batch_id)

    return keep


def latest_rows(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """Update-mode output: the newest version of each key."""
    rows = spark.read.parquet(folder)
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def fan_out(writers: Mapping[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """Give one batch to several writers. It is computed once, and an error fails the batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers.values():
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return each


class ProgressTotals(StreamingQueryListener):
    """Adds up the progress of every query from its first batch on.

    A query itself keeps only its last hundred batches; a listener sees them all and holds a few numbers
    per query.
    """

    def __init__(self) -> None:
        self.totals: dict[str, dict] = {}
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def _of(self, run: str) -> dict:
        self.ended.setdefault(run, threading.Event())
        return self.totals.setdefault(run, {"batches": 0, "messages": 0, "millis": 0, "began": time.time(), "until": time.time()})

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self.lock:
            self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self.lock:
            mine = self._of(str(p.runId))
            mine["batches"] += 1
            mine["messages"] += p.numInputRows
            mine["millis"] += p.durationMs.get("triggerExecution", 0)
            mine["until"] = time.time()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.lock:
            self._of(str(event.runId))
            self.ended[str(event.runId)].set()

    def report(self, spark: SparkSession, query: StreamingQuery, wait: float = 30.0) -> DataFrame:
        """Messages, batches, mean batch time, uptime and rate of one query, as one row."""
        run = str(query.runId)
        with self.lock:
            self._of(run)
        if not query.isActive:
            self.ended[run].wait(wait)  # events arrive a little later than the query ends
        with self.lock:
            t = dict(self.totals[run])
        uptime = t["until"] - t["began"]
        row = (query.name or str(query.id), t["messages"], t["batches"], t["millis"] / max(t["batches"], 1), uptime, t["messages"] / max(uptime, 1e-3))
        return spark.createDataFrame(
            [row],
            "name string, processed_messages long, batches long, average_processing_millis double, uptime_seconds double, messages_per_second double",
        )


@contextlib.contextmanager
def progress_totals(spark: SparkSession):
    """A listener on the session's queries for the time of the block."""
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    try:
        yield totals
    finally:
        spark.streams.removeListener(totals)


def run_until_any_stops(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until one query ends or fails, then stop all of them."""
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
        spark.streams.resetTerminated()
