"""Repeated passages with sparse suffix arrays.

Of each shard's texts only the suffixes at the anchors (the content-selected minimisers of
``passages``) are kept and sorted. Neighbours in that order are compared, which gives the
common words to the right; for each place of a window around its anchor, suffixes that agree
far enough to the right are then split by the words to the left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import Sequences, given_id, keyed, stored, window_minima
from tallyfield.llm.passages import GRAM, Shard, repeated


def resolve(shard: Shard) -> pa.RecordBatch:
    """Sort the anchored suffixes, compare neighbours, extend to both sides."""
    window, words = shard.window, shard.words
    sums = Sequences(words.hashes)
    at = np.arange(len(words) - GRAM + 1)
    # all windows of a segment share its anchor, so its first window shows the place
    anchor = window_minima(sums.of(at, at + GRAM), window - GRAM + 1)[shard.starts]
    _, numbers = np.unique(words.hashes, return_inverse=True)
    right, left = shard.ends - anchor, anchor - shard.starts
    windows = shard.ends - shard.starts - window + 1
    place = anchor[:, None] + np.arange(window)
    inside = np.arange(window) < right[:, None]
    suffixes = np.where(inside, numbers[np.minimum(place, len(numbers) - 1)] + 1, 0)
    order = np.lexsort(suffixes.T[::-1])
    ranked = suffixes[order]
    common = np.concatenate([[0], np.cumprod((ranked[1:] == ranked[:-1]) & (ranked[1:] > 0), axis=1).sum(axis=1)])
    found: list[tuple] = []
    for back in range(window - GRAM + 1):
        group = np.cumsum(common < window - back)
        here = np.flatnonzero((left[order] >= back) & (left[order] - back < windows[order]))
        if not len(here):
            continue
        own = order[here]
        before = sums.of(anchor[own] - back, anchor[own])
        by = np.lexsort((before, group[here]))
        own, kind, before = own[by], group[here][by], before[by]
        begin = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (before[1:] != before[:-1])]))
        held = np.diff(np.append(begin, len(own)))
        first = np.repeat(np.minimum.reduceat(shard.first[own], begin), held)
        last = np.repeat(np.maximum.reduceat(shard.last[own], begin), held)
        found.append((own, left[own] - back, first, last))
    return shard.resolved(*(np.concatenate(c) for c in zip(*found)))


def repeated_passages(docs: DataFrame, window: int = 50, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document with words that other documents repeat.

    Columns: doc_id, n_repeated (words inside windows of ``window`` words that occur in another
    document), spans (their word ranges) and first_ids (sorted ids of the documents in which
    those windows occur first, itself included if it is the first). Documents without repeated windows
    have no row. Rows with one id are one document, as are all rows with NULL ids; rows that
    repeat an id and a text give one row. NULL and short texts have no windows.
    """
    rows = keyed(docs, id_column, text_column)
    hits = repeated(rows, window, resolve)
    gathered = stored(
        hits.groupBy("_id", "_tx").agg(F.collect_set(F.struct("_from", "_upto")).alias("_runs"), F.sort_array(F.collect_set("_first")).alias("first_ids")),
        "passage-gathered",
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans = [], []
            for ranges in batch.column("_runs").to_pylist():
                merged: list[list[int]] = []
                for a, b in sorted((r["_from"], r["_upto"] + window - 1) for r in ranges):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                counts.append(sum(b - a for a, b in merged))
                spans.append(",".join(f"{a}:{b}" for a, b in merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(counts, pa.int64()), pa.array(spans, pa.string()), batch.column("first_ids")],
                names=["_id", "n_repeated", "spans", "first_ids"],
            )

    out = gathered.select("_id", "_runs", "first_ids").mapInArrow(each, "_id long, n_repeated long, spans string, first_ids array<long>")
    return out.select(given_id().alias("doc_id"), "n_repeated", "spans", "first_ids")
