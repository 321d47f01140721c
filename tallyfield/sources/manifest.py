"""Which loads a table has had: a small table that is read instead of the target.

A load is entered as started, with the target's number of files, before it writes, and as done after. Writes of a table appear as
a whole or not at all, so a load that was cut off is told by the target's file listing: if files were added it
had finished, if not it runs again. One load into a target at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "target string, source string, batch string, state string, files long, at timestamp"
STARTED, DONE, RESET = "started", "done", "reset"


class Manifest:
    """Entries of loads under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _enter(self, target: str, sources: Sequence[str], batch: str, state: str, files: int) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        rows = [(target, s, batch, state, files, now) for s in sources]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def entries(self, target: str):
        """The entries of a target since it was last replaced."""
        self.spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(self.folder)
        own = self.spark.read.schema(SCHEMA).parquet(self.folder).where(F.col("target") == target)
        since = own.where(F.col("state") == RESET).agg(F.max("at")).first()[0]
        return own if since is None else own.where(F.col("at") > F.lit(since))

    def states(self, target: str) -> dict[str, tuple[str, str, int]]:
        """The last (state, batch, files) of each source: as many as the target has had files or runs."""
        last = self.entries(target).groupBy("source").agg(F.max(F.struct("at", (F.col("state") == DONE).alias("_done"), "state", "batch", "files")).alias("r"))
        return {r["source"]: (r["r"]["state"], r["r"]["batch"], r["r"]["files"]) for r in last.collect()}

    def reset(self, target: str) -> None:
        """The target was replaced: earlier loads do not count."""
        self._enter(target, [""], "", RESET, 0)

    def adopt(self, target: str, sources: Sequence[str], files: int) -> None:
        """Enter sources that the target is known to hold from before there was a manifest."""
        self._enter(target, sources, uuid.uuid4().hex, DONE, files)

    def once(self, target: str, sources: Sequence[str], listing: Callable[[], int], load: Callable[[Sequence[str]], None]) -> list[str]:
        """Run ``load`` on the sources that the target does not hold yet and return them.

        ``listing`` counts the target's files. A load that started and was not entered as done is settled first.
        """
        known = self.states(target)
        open_ = [s for s, (state, _, _) in known.items() if state == STARTED]
        if open_:
            held = listing()
            finished = [s for s in open_ if held > known[s][2]]
            if finished:
                self._enter(target, finished, known[finished[0]][1], DONE, held)
        held_already = {s for s, (state, _, _) in known.items() if state == DONE} | (set(finished) if open_ else set())
        new = [s for s in sources if s not in held_already]
        if new:
            batch = uuid.uuid4().hex
            self._enter(target, new, batch, STARTED, listing())
            load(new)
            self._enter(target, new, batch, DONE, listing())
        return new
