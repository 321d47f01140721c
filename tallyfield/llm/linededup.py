"""Line dedup by a join of deletion neighbourhoods.

A line is its sequence of words. Equal lines are found by hash. Lines that differ by one word
(replaced, added or left out) share a variant: the line itself or the line without one word. All
variants within the bound are emitted as hashed keys; a line without its word i meets the
other lines that differ in word i, and the lines that lack it. Only the earliest line of a variant
matters to the others, so variants are aggregated and never paired. The lines that survive are
compared word by word with the earlier line that they met.

Long lines have many variants, so lines first have to show that they can have a partner: of two
lines one word apart, either the first or the last half agrees. Lines whose halves occur in
no other line emit no variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import SPACED, Sequences, Words, given_id, keyed, signed, slices, stored

#: A line needs as many words for one changed word to count as near.
LEAST_WORDS = 8

LINE = "_hash long, _check long, _id long, _tx long, _no int, _n int, _k1 long, _k2 long, _k3 long"


class Lines:
    """The lines with words of a slice of texts: row, number in the text, first word, words."""

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts, SPACED)
        breaks = np.flatnonzero(words.data == 10)
        line = np.searchsorted(breaks, words.starts) + words.row
        self.first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(words) else np.zeros(0, np.int64)
        self.count = np.diff(np.append(self.first, len(words)))
        self.row = words.row[self.first]
        self.no = (line[self.first] - self.row) - np.searchsorted(breaks, words.offsets[self.row])
        self.sums, self.check = Sequences(words.hashes), Sequences(words.hashes, 1)


def halves(sums: Sequences, first: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Three keys of the halves that a line one word apart may share, whatever the change."""
    end, a, b = first + n, n // 2, (n - 1) // 2
    head = lambda k: sums.of(first, first + k, salt=11)
    tail = lambda k: sums.of(end - k, end, salt=12)
    return [head(a), np.where(a == b, tail(n - a), head(b)), tail(n - 1 - b)]


def lines_of(rows: DataFrame, least_words: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            lines = Lines(batch.column("_text"))
            end = lines.first + lines.count
            own, short = pa.array(lines.row), lines.count < least_words
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(lines.sums.of(lines.first, end, salt=1))),
                    pa.array(signed(lines.check.of(lines.first, end))),
                    batch.column("_id").take(own),
                    batch.column("_tx").take(own),
                    pa.array(lines.no.astype(np.int32)),
                    pa.array(lines.count.astype(np.int32)),
                    *[pa.array(signed(k), mask=short) for k in halves(lines.sums, lines.first, lines.count)],
                ],
                names=[c.split()[0] for c in LINE.split(", ")],
            )

    return rows.mapInArrow(each, LINE)


def texts_of_lines(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_hash, _id, _tx, _no, _line) of the lines in ``wanted``."""
    listed = wanted.groupBy("_id", "_tx").agg(F.collect_list(F.struct("_no", "_hash")).alias("_want"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out: list[tuple] = []
            for i, t, text, want in zip(*(batch.column(k).to_pylist() for k in ("_id", "_tx", "_text", "_want"))):
                lines = text.split("\n")
                out += [(w["_hash"], i, t, w["_no"], lines[w["_no"]]) for w in want]
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["_hash", "_id", "_tx", "_no", "_line"])

    return rows.join(listed, ["_id", "_tx"]).mapInArrow(each, "_hash long, _id long, _tx long, _no int, _line string")


def variants(lines: DataFrame) -> DataFrame:
    """(_variant, _gap, _hash, _id, _tx, _no): each line without one word (the gap), and whole (-1)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_line", 500_000):
            words = Words(batch.column("_line"), SPACED)
            sums = Sequences(words.hashes)
            first, n = words.first[:-1], np.diff(words.first)
            at = np.arange(len(words))
            start, end = first[words.row], words.first[1:][words.row]
            gaps = sums.without(start, at, end, salt=21)
            whole = sums.of(first, first + n, salt=21)
            own = pa.array(np.concatenate([words.row, np.arange(len(n))]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([gaps, whole]))),
                    pa.array(np.concatenate([at - start, np.full(len(n), -1)]).astype(np.int32)),
                    *[batch.column(c).take(own) for c in ("_hash", "_id", "_tx", "_no")],
                ],
                names=["_variant", "_gap", "_hash", "_id", "_tx", "_no"],
            )

    return lines.mapInArrow(each, "_variant long, _gap int, _hash long, _id long, _tx long, _no int")


def one_apart(a: list[str], b: list[str]) -> bool:
    """Whether at most one word is replaced, added or left out between two lines."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def near_lines(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """(_hash) of the distinct lines that an earlier distinct line is one word away from."""
    key = F.explode(F.array("_k1", "_k2", "_k3")).alias("_key")
    long_lines = distinct.where("_k1 is not null").select("_hash", "_id", "_tx", "_no", key)
    shared = long_lines.groupBy("_key").agg(F.count(F.lit(1)).alias("_lines")).where("_lines > 1").select("_key")
    likely = long_lines.join(shared, "_key").select("_hash", "_id", "_tx", "_no").distinct()
    lines = stored(texts_of_lines(rows, likely), "line-texts")
    place = F.struct("_id", "_tx", "_no", "_hash").alias("_place")
    emitted = stored(variants(lines), "line-variants")
    first = emitted.groupBy("_variant", "_gap").agg(F.min(place).alias("_least"), F.count(F.lit(1)).alias("_held"))
    whole, gap = F.col("_gap") < 0, F.col("_gap") >= 0
    least = stored(
        first.groupBy("_variant").agg(
            F.min(F.when(whole, F.col("_least"))).alias("_whole"),
            F.min(F.when(gap, F.col("_least"))).alias("_gapped"),
            F.map_from_entries(F.collect_list(F.when(gap & (F.col("_held") > 1), F.struct("_gap", "_least")))).alias("_by_gap"),
            F.sum("_held").alias("_all"),
        ).where("_all > 1").drop("_all"),
        "line-least",
    )
    met = emitted.join(least, "_variant")
    partner = F.when(whole, F.col("_gapped")).otherwise(F.least("_whole", F.col("_by_gap")[F.col("_gap")]))
    pairs = (
        met.select("_hash", place, partner.alias("_partner"))
        .where("_partner < _place")
        .groupBy("_hash")
        .agg(F.collect_set("_partner._hash").alias("_partners"))
        .select("_hash", F.explode("_partners").alias("_partner"))
    )
    text = lines.select("_hash", "_line")
    both = pairs.join(text, "_hash").join(text.select(F.col("_hash").alias("_partner"), F.col("_line").alias("_other")), "_partner")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [one_apart(a.encode().split(), b.encode().split()) for a, b in zip(batch.column("_line").to_pylist(), batch.column("_other").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("_hash").filter(pa.array(keep, pa.bool_()))], names=["_hash"])

    return both.mapInArrow(each, "_hash long").distinct()


def removed_lines(rows: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(_id, _tx, _gone): the numbers of the lines to remove, for documents that have some."""
    lines = stored(lines_of(rows, least_words), "lines")
    place = F.struct("_id", "_tx", "_no")
    whole = stored(
        lines.groupBy("_hash", "_check").agg(F.min(place).alias("_at"), F.max(place).alias("_last"), *[F.first(k).alias(k) for k in ("_k1", "_k2", "_k3")]),
        "line-distinct",
    )
    distinct = whole.select("_hash", "_at.*", "_k1", "_k2", "_k3")
    near = stored(near_lines(rows, distinct), "line-near")
    again = whole.where("_at < _last").select("_hash", "_check", "_at")
    copies = lines.join(again, ["_hash", "_check"]).where(place != F.col("_at")).select("_id", "_tx", "_no")
    changed = distinct.join(near, "_hash").select("_id", "_tx", "_no")
    return stored(copies.union(changed).groupBy("_id", "_tx").agg(F.collect_set("_no").alias("_gone")), "line-gone")


def without_lines(text: str, gone) -> str | None:
    """The text without some lines; None if no word is left."""
    drop = {int(n) for n in gone}
    parts = [p for i, p in enumerate(text.split("\n")) if i not in drop]
    return "\n".join(parts) if any(p.strip(" \t\r\x0b\x0c") for p in parts) else None


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: _id, _tx (its key), n_lines, n_removed, removed, kept.

    A line (words between line feeds) is removed if an equal line, or for lines of ``least_words``
    words and more a line one word apart, stands earlier in the input: at a smaller id, or further up in
    the same text. Lines are judged on the input; words are compared as they are, white space between them is not.
    Lines without words stay. ``removed`` lists the line numbers from 0, ``kept`` is the text of the other
    lines. NULL texts are empty and NULL ids last; texts of one id are ordered by hash; rows that repeat an id
    and a text are one document, and each is returned.
    """
    rows = keyed(docs, id_column, text_column)
    gone = removed_lines(rows, least_words)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            counts, removed, kept = [], [], []
            for text, out in zip(batch.column("_text").to_pylist(), batch.column("_gone").to_pylist()):
                parts = text.split("\n")
                counts.append(sum(bool(p.strip(" \t\r\x0b\x0c")) for p in parts))
                removed.append(sorted(out or ()))
                drop = set(removed[-1])
                kept.append("\n".join(p for i, p in enumerate(parts) if i not in drop) if drop else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_tx"), pa.array(counts, pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(kept, pa.string())],
                names=["_id", "_tx", "n_lines", "removed", "kept"],
            )

    out = rows.join(gone, ["_id", "_tx"], "left").mapInArrow(each, "_id long, _tx long, n_lines long, removed array<int>, kept string")
    return out.withColumn("n_removed", F.size("removed").cast("long"))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """``dedup_lines`` with doc_id in place of the key.

    A NULL or empty text has no lines. Of equal or near lines the earliest by doc_id (NULL last), text and place stays. Rows that
    repeat an id and a text are one document, whose result each row gets. Other columns are not looked at; an
    empty table gives an empty result.
    """
    out = dedup_lines(docs, **options)
    return out.select(given_id().alias("doc_id"), "n_lines", "n_removed", "removed", "kept")
