"""Repeated word windows across documents: candidate stretches, routed to shards by content.

A window is ``window`` consecutive words. Its anchor is the ``GRAM``-word stretch in it with the
least hash; windows in a row with the same anchor form a segment. Equal windows have equal
anchors, so a window can only repeat where its anchor does: segments of unrepeated anchors
are dropped, equal segments are kept once with their least and greatest document, and the
words of the rest go to the shard of their anchor. What happens in a shard is the caller's:
it says for each window of its segments which document holds it first and last.

An anchor with more than ``HOT`` different segments around it is a frequent phrase. Its windows
are then grouped by their own hash, over all tasks, so no shard grows with a hot phrase.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import SPACED, Sequences, Words, pieces, signed, slices, stored, window_minima, windows_in_rows

GRAM = 12
HOT = 4096

SEGMENT = "_gram long, _body long, _id long, _tx long, _start int, _windows int"
#: Windows ``from`` to ``upto`` of a segment are first in ``first`` and last in ``last``.
RESOLVED = "_gram long, _body long, _from int, _upto int, _first long, _last long"


def segments(rows: DataFrame, window: int) -> DataFrame:
    """The segments of every text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), SPACED)
            starts = windows_in_rows(words, window)
            if not len(starts):
                continue
            sums, other = Sequences(words.hashes), Sequences(words.hashes, 1)
            at = np.arange(len(words) - GRAM + 1)
            grams = sums.of(at, at + GRAM)
            anchor = window_minima(grams, window - GRAM + 1)[starts]
            new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (words.row[starts[1:]] != words.row[starts[:-1]])]))
            first, count = starts[new], np.diff(np.append(new, len(starts)))
            body = other.of(first, first + count + window - 1, salt=1)
            own = pa.array(words.row[first])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(grams[anchor[new]])),
                    pa.array(signed(body)),
                    batch.column("_id").take(own),
                    batch.column("_tx").take(own),
                    pa.array((first - words.first[words.row[first]]).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                names=["_gram", "_body", "_id", "_tx", "_start", "_windows"],
            )

    return rows.mapInArrow(each, SEGMENT)


def single_windows(rows: DataFrame, hot: DataFrame, window: int) -> DataFrame:
    """The windows of hot segments as segments of one window each, under hashes of their own."""
    wanted = hot.groupBy("_id", "_tx").agg(F.collect_list(F.struct("_start", "_windows")).alias("_want"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), SPACED)
            sums, other = Sequences(words.hashes), Sequences(words.hashes, 1)
            row, start = [], []
            for i, want in enumerate(batch.column("_want").to_pylist()):
                place = np.concatenate([np.arange(w["_start"], w["_start"] + w["_windows"]) for w in want])
                row.append(np.full(len(place), i))
                start.append(place)
            row, start = np.concatenate(row), np.concatenate(start)
            at = start + words.first[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(sums.of(at, at + window, salt=2))),
                    pa.array(signed(other.of(at, at + window, salt=3))),
                    batch.column("_id").take(pa.array(row)),
                    batch.column("_tx").take(pa.array(row)),
                    pa.array(start.astype(np.int32)),
                    pa.array(np.ones(len(at), np.int32)),
                ],
                names=["_gram", "_body", "_id", "_tx", "_start", "_windows"],
            )

    return rows.join(wanted, ["_id", "_tx"]).mapInArrow(each, SEGMENT)


def shipped(rows: DataFrame, kept: DataFrame, window: int) -> DataFrame:
    """(_gram, _body, _first, _last, _words) of the segments in ``kept``."""
    wanted = kept.groupBy("_id", "_tx").agg(F.collect_list(F.struct("_gram", "_body", "_id", "_last", "_start", "_windows")).alias("_want"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), SPACED)
            out: list[list] = [[] for _ in range(5)]
            for i, want in enumerate(batch.column("_want").to_pylist()):
                for w in want:
                    a = words.first[i] + w["_start"]
                    stretch = words.data[words.starts[a] : words.ends[a + w["_windows"] + window - 2]]
                    for column, value in zip(out, (w["_gram"], w["_body"], w["_id"], w["_last"], stretch.tobytes())):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["_gram", "_body", "_first", "_last", "_words"])

    return rows.join(wanted, ["_id", "_tx"]).mapInArrow(each, "_gram long, _body long, _first long, _last long, _words binary")


class Shard:
    """The segments of one shard: their ids and bounds, and the words of all of them in a row."""

    def __init__(self, batches: list[pa.RecordBatch], window: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.window = window
        column = lambda name: table.column(name).to_numpy()
        self.gram, self.body, self.first, self.last = map(column, ("_gram", "_body", "_first", "_last"))
        texts = pa.concat_arrays(table.column("_words").chunks)
        self.words = Words(texts, SPACED)
        self.starts, self.ends = self.words.first[:-1], self.words.first[1:]

    def resolved(self, segment: np.ndarray, offset: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        """Windows (by segment and offset) that several documents hold, joined to runs of like ones."""
        keep = np.flatnonzero(first != last)
        keep = keep[np.lexsort((offset[keep], segment[keep]))]
        segment, offset, first, last = segment[keep], offset[keep], first[keep], last[keep]
        if len(keep):
            same = (np.diff(segment) == 0) & (np.diff(offset) == 1) & (np.diff(first) == 0) & (np.diff(last) == 0)
            begin = np.flatnonzero(np.concatenate([[True], ~same]))
            end = np.append(begin[1:], len(keep)) - 1
        else:
            begin = end = keep
        own = segment[begin]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.gram[own]),
                pa.array(self.body[own]),
                pa.array(offset[begin].astype(np.int32)),
                pa.array((offset[end] + 1).astype(np.int32)),
                pa.array(first[begin]),
                pa.array(last[begin]),
            ],
            names=["_gram", "_body", "_from", "_upto", "_first", "_last"],
        )


def repeated(rows: DataFrame, window: int, resolve: Callable[[Shard], pa.RecordBatch]) -> DataFrame:
    """(_id, _tx, _from, _upto, _first, _last): window starts of each document that other documents share.

    ``rows`` has _id, _tx and _text; rows that agree in _id are one document.
    """
    all_segments = stored(segments(rows, window), "passage-segments")
    anchors = stored(
        all_segments.groupBy("_gram").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high")).where("_low < _high").select("_gram"),
        "passage-anchors",
    )
    found = stored(all_segments.join(anchors, "_gram"), "passage-repeats")
    distinct = stored(
        found.groupBy("_gram", "_body").agg(F.min(F.struct("_id", "_tx", "_start", "_windows")).alias("_one"), F.max("_id").alias("_last")),
        "passage-distinct",
    ).select("_gram", "_body", "_one.*", "_last")
    around = stored(
        distinct.groupBy(F.col("_gram").alias("_anchor")).agg(F.count(F.lit(1)).alias("_bodies")).where("_bodies > 1"), "passage-around"
    )
    many = around.where(F.col("_bodies") <= HOT)
    hot = around.where(F.col("_bodies") > HOT)
    alone = distinct.join(around, F.col("_gram") == F.col("_anchor"), "left_anti")

    shards = shipped(rows, distinct.join(many, F.col("_gram") == F.col("_anchor"), "left_semi"), window).repartition(pieces(rows.sparkSession), "_gram")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield resolve(Shard(held, window))

    whole = lambda df: df.where("_first < _last").select("_gram", "_body", F.lit(0).alias("_from"), F.col("_windows").alias("_upto"), "_first", "_last")
    resolved = stored(shards.mapInArrow(each, RESOLVED).unionByName(whole(alone.withColumnRenamed("_id", "_first"))), "passage-resolved")
    windows = stored(single_windows(rows, found.join(hot, F.col("_gram") == F.col("_anchor"), "left_semi"), window), "passage-hot")
    hot_resolved = stored(
        whole(windows.groupBy("_gram", "_body").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.lit(1).alias("_windows"))),
        "passage-hot-resolved",
    )

    def spread(occurrences: DataFrame, runs: DataFrame) -> DataFrame:
        return occurrences.join(runs, ["_gram", "_body"]).select(
            "_id", "_tx", (F.col("_start") + F.col("_from")).alias("_from"), (F.col("_start") + F.col("_upto")).alias("_upto"), "_first", "_last"
        )

    return spread(found, resolved).unionByName(spread(windows, hot_resolved))
