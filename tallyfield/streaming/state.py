"""Per-key state that expires by itself."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Keys that a task holds before their records are sent on.
HELD = 20_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state where timers and expiry are known; a running stream keeps its setting."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class Newest(StatefulProcessor):
    """The newest record of a key, and a timer that forgets it ``ttl_ms`` after its event time."""

    def __init__(self, columns: Sequence[str], schema: str, ttl_ms: int):
        self.columns, self.schema, self.ttl_ms = list(columns), schema, ttl_ms

    def init(self, handle) -> None:
        self.handle, self.held = handle, handle.getValueState("newest", self.schema)

    def _out(self, record: tuple, is_expired: bool) -> pd.DataFrame:
        frame = pd.DataFrame([record], columns=self.columns, dtype=object)
        return frame.assign(is_expired=is_expired)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = tuple(self.held.get()) if self.held.exists() else None
        before = best
        for frame in rows:
            for record in frame[self.columns].astype(object).where(frame[self.columns].notna(), None).itertuples(index=False, name=None):
                # the key stands first, then time and tie
                if best is None or record[1:3] >= best[1:3]:
                    best = record
        if best != before:
            if before is not None:
                self.handle.deleteTimer(before[1] // 1000 + self.ttl_ms)
            self.held.update(best)
            self.handle.registerTimer(best[1] // 1000 + self.ttl_ms)
            yield self._out(best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.held.exists():
            last = tuple(self.held.get())
            self.held.clear()
            yield self._out(last, True)

    def close(self) -> None:
        pass


def combined(stream: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The newest record of each key in each task: a hot key sends a row from a task, not all it has.

    What is held between batches of Arrow rows is sent on when it has more than ``HELD`` keys.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in filter(len, batches):
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            order = pd.DataFrame({c: rows.column(c).to_pandas() for c in (key, ts, tie)})
            last = order.sort_values([ts, tie], kind="stable").drop_duplicates(key, keep="last").index
            held = rows.take(pa.array(np.sort(last.to_numpy()))).combine_chunks().to_batches()[0]
            if len(held) > HELD:
                yield held
                held = None
        if held is not None:
            yield held

    return stream.mapInArrow(each, stream.schema)


def expiring_latest(stream: DataFrame, key: str, ts: str, tie: str, fields: Sequence[str], delay: str, ttl_ms: int = 600_000) -> DataFrame:
    """Stream of the newest record per key; a key without news for ``ttl_ms`` of event time is forgotten.

    Each change gives a row with ``is_expired`` false, and the end of a key one with its last record and ``is_expired`` true. Time is event
    time behind a watermark of ``delay``, so a replay expires the same keys. Records are combined before the shuffle; what is
    late beyond the watermark is dropped. Start the stream inside ``timers``.
    """
    kind = {f.name: f.dataType.simpleString() for f in stream.schema}
    columns = [key, "updated_micros", "updated_tie", *fields]
    schema = f"`{key}` {kind[key]}, updated_micros long, updated_tie long, " + ", ".join(f"`{c}` {kind[c]}" for c in fields)
    ready = combined(stream.select(key, F.col(ts).cast("timestamp").alias("updated_at"), F.col(tie).cast("long").alias("updated_tie"), *fields), key, "updated_at", "updated_tie")
    timed = ready.withWatermark("updated_at", delay).select("*", F.unix_micros("updated_at").alias("updated_micros"))
    found = timed.groupBy(key).transformWithStateInPandas(Newest(columns, schema, ttl_ms), f"{schema}, is_expired boolean", "Update", "EventTime")
    return found.select(key, F.timestamp_micros("updated_micros").alias(ts), *fields, "is_expired")
