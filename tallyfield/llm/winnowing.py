"""Benchmark decontamination by winnowing.

The least hash of k-grams in each sliding window is kept as a fingerprint of training and test
texts. Two texts that share ``span`` words in a row share the window of k-grams in them and
so a fingerprint, at the same place of the shared words. The joined fingerprints give
(document, item, shift) candidates, which are extended word by word to the full runs that both
texts have in common along that shift. Items shorter than ``span`` words count as a whole; each
such length has k-grams and windows of its own, so that the guarantee holds for it too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import ALNUM, Sequences, Words, given_id, keyed, signed, slices, stored, window_minima, windows_in_rows

KGRAM = 5


def fingerprints(words: Words, length: int, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams kept for spans of ``length`` words; ``only``: rows wanted."""
    k = min(KGRAM, length)
    if len(words) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(words) - k + 1)
    grams = Sequences(words.hashes).of(at, at + k, salt=length)
    starts = windows_in_rows(words, length)
    if only is not None:
        starts = starts[only[words.row[starts]]]
    kept = np.unique(window_minima(grams, length - k + 1)[starts])
    return kept, signed(grams[kept])


def prints_of_items(items: DataFrame, span: int) -> DataFrame:
    """(_hash, _item, _at, _span) of the benchmark."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), ALNUM, lower=True)
            lengths = np.minimum(np.diff(words.first), span)
            for length in sorted(set(lengths[lengths > 0].tolist())):
                kept, hashes = fingerprints(words, length, lengths == length)
                rows = words.row[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), batch.column("_item").take(pa.array(rows)), pa.array(kept - words.first[rows]), pa.array(np.full(len(kept), length))],
                    names=["_hash", "_item", "_at", "_span"],
                )

    return items.mapInArrow(each, "_hash long, _item long, _at long, _span long")


def prints_of_documents(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """(_hash, _id, _tx, _place) for every span length in use."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), ALNUM, lower=True)
            for length in lengths:
                kept, hashes = fingerprints(words, length)
                own = pa.array(words.row[kept])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), batch.column("_id").take(own), batch.column("_tx").take(own), pa.array(kept - words.first[words.row[kept]])],
                    names=["_hash", "_id", "_tx", "_place"],
                )

    return rows.mapInArrow(each, "_hash long, _id long, _tx long, _place long")


def runs(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of at least ``least`` true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= least]


def extended(rows: DataFrame, span: int) -> DataFrame:
    """Documents with their candidates to (_id, _tx, n_words, n_hit, _items, _spans)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), ALNUM, lower=True)
            n_words = np.diff(words.first)
            n_hit, names, spans = np.zeros(len(n_words), np.int64), [[] for _ in n_words], [[] for _ in n_words]
            for row, found in enumerate(batch.column("_found").to_pylist()):
                if not found:
                    continue
                own = words.hashes[words.first[row] : words.first[row + 1]]
                hit, items = np.zeros(len(own) + 1, np.int64), set()
                test = Words(pa.array([f["text"] for f in found]), ALNUM, lower=True)
                for i, f in enumerate(found):
                    item = test.hashes[test.first[i] : test.first[i + 1]]
                    for shift in f["shifts"]:
                        a, b = max(0, -shift), min(len(item), len(own) - shift)
                        for x, y in runs(item[a:b] == own[a + shift : b + shift], min(span, len(item))):
                            hit[a + x + shift] += 1
                            hit[a + y + shift] -= 1
                            items.add(f["name"])
                covered = np.cumsum(hit[:-1]) > 0
                n_hit[row], names[row] = covered.sum(), sorted(items)
                spans[row] = [{"start": x, "end": y} for x, y in runs(covered, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_tx"), pa.array(n_words), pa.array(n_hit), pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["_id", "_tx", "n_words", "n_hit", "_items", "_spans"],
            )

    return rows.mapInArrow(each, "_id long, _tx long, n_words long, n_hit long, _items array<string>, _spans array<struct<start:long,end:long>>")


def hits(docs: DataFrame, benchmark: DataFrame, span: int = 13, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """One row per document: _id, _tx, n_words, n_hit, _items, _spans, contaminated."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    name = F.coalesce(F.col(item_column).cast("string"), F.lit(""))
    items = benchmark.select(name.alias("_name"), text.alias("_text")).distinct().withColumn("_item", F.xxhash64("_name", "_text"))
    prints = stored(prints_of_items(items.select("_item", "_text"), span), "winnow-items")
    lengths = sorted(r[0] for r in prints.select("_span").distinct().collect())
    rows = keyed(docs, id_column, text_column)
    shift = F.col("_place") - F.col("_at")
    lines = (
        prints_of_documents(rows, lengths)
        .join(prints, "_hash")
        .groupBy("_id", "_tx", "_item")
        .agg(F.collect_set(shift).alias("shifts"))
    )
    found = stored(
        lines.join(items, "_item")
        .groupBy("_id", "_tx")
        .agg(F.collect_list(F.struct(F.col("_name").alias("name"), F.col("_text").alias("text"), "shifts")).alias("_found")),
        "winnow-found",
    )
    out = extended(rows.join(found, ["_id", "_tx"], "left").select("_id", "_tx", "_text", "_found"), span)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = 13, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, contaminated.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A document word
    is hit if it lies in an occurrence of ``span`` consecutive item words, or of a whole shorter
    item. ``items`` are the ids of such items as sorted strings, ``spans`` the hit word ranges. A
    document is contaminated if at least a twentieth of its words is hit. NULL texts have no
    words; items without words match nothing; an item without id counts under the empty name.
    Repeated rows give repeated results; an empty benchmark leaves all documents clean.
    """
    return hits(docs, benchmark, span, id_column, text_column, item_column).select(
        given_id().alias("doc_id"), "n_words", "n_hit", F.col("_items").alias("items"), F.col("_spans").alias("spans"), "contaminated"
    )
