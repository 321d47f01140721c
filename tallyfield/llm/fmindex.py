"""Substring dedup with a compressed FM-index per shard.

Each shard indexes its segments: the suffixes are sorted to a depth of 64 words, the words
before them form the Burrows-Wheeler sequence, and a wavelet matrix of packed bits answers how
often a word occurs before a place. Texts are streamed from right to left: backward search
keeps the rows whose suffixes begin with the current words, cut to the threshold, which is the
matching statistic up to it. Where it reaches the threshold, the rows of that
window say which documents hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import SPACED, Words, given_id, keyed, slices, stored
from tallyfield.llm.passages import Shard, repeated

DEPTH = 64


class WaveletMatrix:
    """Rank of any symbol in a sequence from one packed bit row per binary digit."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.rows = []
        for digit in range(digits - 1, -1, -1):
            bits = (symbols >> digit) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = len(symbols) - int(bits.sum())
            self.rows.append((digit, packed, ones, zeros))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``, plus the place where the symbol's run begins."""
        for digit, packed, ones, zeros in self.rows:
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            one = ones[word] + np.bitwise_count(packed[word] & mask)
            at = np.where((symbol >> digit) & 1, zeros + one, at - one)
        return at


class FMIndex:
    """Index of word numbers (1 and above; 0 separates texts)."""

    def __init__(self, symbols: np.ndarray, threshold: int):
        if not 1 < threshold < DEPTH:
            raise ValueError(f"the threshold must be between 2 and {DEPTH - 1}")
        n = len(symbols)
        self.size, self.threshold = n, threshold
        ranks, span, keys = symbols.astype(np.int64), 1, {}
        while span < DEPTH:
            if span <= threshold - 1 < 2 * span:
                keys = {length: self._pair(ranks, length - span) for length in (threshold - 1,)}
            if span <= threshold < 2 * span or span == threshold:
                keys[threshold] = self._pair(ranks, threshold - span)
            pair = self._pair(ranks, span)
            self.order = np.argsort(pair, kind="stable")
            ahead = pair[self.order]
            ranks = np.empty(n, np.int64)
            ranks[self.order] = np.cumsum(np.concatenate([[0], ahead[1:] != ahead[:-1]]))
            span *= 2
        digits = max(1, int(symbols.max()).bit_length())
        before = symbols[self.order - 1]  # the word before the first suffix is the last separator
        self.matrix = WaveletMatrix(before, digits)
        every = np.arange(1 << digits)
        self.begin = self.matrix.rank(every, np.zeros(len(every), np.int64))
        self.count = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(every)))])
        self.low, self.high = self._classes(keys[threshold - 1])
        self.window_low, _ = self._classes(keys[threshold])

    @staticmethod
    def _pair(ranks: np.ndarray, shift: int) -> np.ndarray:
        """Ranks joined with the ranks ``shift`` further on."""
        return ranks * (int(ranks.max()) + 2) + np.concatenate([ranks[shift:] + 1, np.zeros(shift, np.int64)])

    def _classes(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the bounds of the rows whose suffixes agree with it in ``key``."""
        ahead = key[self.order]
        begin = np.flatnonzero(np.concatenate([[True], ahead[1:] != ahead[:-1]]))
        held = np.diff(np.append(begin, self.size))
        return np.repeat(begin, held), np.repeat(begin + held, held)

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where the rows before ``row`` that ``symbol`` precedes end among its suffixes."""
        return self.count[symbol] + self.matrix.rank(symbol, row) - self.begin[symbol]

    def matches(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, row) of every window of ``threshold`` words of the texts that the index holds.

        All texts advance together, one word a step. When a word does not fit, no window with
        the present end exists; the search starts again one word to the left of that end.
        """
        known = (symbols > 0) & (symbols < len(self.count) - 1)
        end, at = ends.copy(), ends.copy()
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        live = np.flatnonzero(end - starts >= self.threshold)
        places, rows = [], []
        while len(live):
            word = symbols[at[live] - 1]
            fits = known[at[live] - 1]
            word = np.where(fits, word, 0)
            new_low, new_high = self.step(word, low[live]), self.step(word, high[live])
            fits &= new_low < new_high
            on, off = live[fits], live[~fits]
            at[on] -= 1
            low[on], high[on] = new_low[fits], new_high[fits]
            full = on[end[on] - at[on] == self.threshold]
            places.append(at[full])
            rows.append(self.window_low[low[full]])
            inner = low[full]
            low[full], high[full] = self.low[inner], self.high[inner]
            end[full] -= 1
            end[off] -= 1
            at[off], low[off], high[off] = end[off], 0, self.size
            live = live[(at[live] > starts[live]) & (end[live] - starts[live] >= self.threshold)]
        return np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(rows or [np.zeros(0, np.int64)])


def resolve(shard: Shard) -> pa.RecordBatch:
    """Build the index of a shard's segments, stream them against it and read off the documents."""
    _, numbers = np.unique(shard.words.hashes, return_inverse=True)
    n = len(shard.starts)
    symbols = np.zeros(len(numbers) + n, np.int64)  # a separator after each segment
    segment = shard.words.row
    moved = np.arange(len(numbers)) + segment
    symbols[moved] = numbers + 1
    starts, ends = shard.starts + np.arange(n), shard.ends + np.arange(n)
    index = FMIndex(symbols, shard.window)
    place, row = index.matches(symbols, starts, ends)
    owner = np.repeat(np.arange(n), np.diff(np.append(starts, len(symbols))))
    begin = np.unique(index.window_low)
    of_row = owner[index.order]
    first = np.minimum.reduceat(shard.first[of_row], begin)
    last = np.maximum.reduceat(shard.last[of_row], begin)
    kind = np.searchsorted(begin, row)
    own = owner[place]
    return shard.resolved(own, place - starts[own], first[kind], last[kind])


def without(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """(_id, n_words, n_removed, _kept, _spans) of every row of ``rows``."""
    joined = rows.join(removed, ["_id", "_tx"], "left").select("_id", "_text", "_cut")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(batch.column("_text"), SPACED)
            n_words, n_removed, kept, spans = np.diff(words.first), [], [], []
            data = words.data.tobytes()
            for i, cut in enumerate(batch.column("_cut").to_pylist()):
                own = data[words.offsets[i] : words.offsets[i + 1]].split()
                edge = np.zeros(len(own) + 1, np.int64)
                for c in cut or ():
                    edge[c["start"]] += 1
                    edge[c["end"]] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append([{"start": a, "end": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())])
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(own, gone) if not g] if n_removed[-1] else own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(n_words),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["_id", "n_words", "n_removed", "_kept", "_spans"],
            )

    return joined.mapInArrow(each, "_id long, n_words long, n_removed long, _kept string, _spans array<struct<start:long,end:long>>")


def dedup_substrings(docs: DataFrame, window: int = 50, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (text), spans (removed word ranges).

    A word goes if a window of ``window`` words covers it whose words also start in a document
    with a smaller id. Windows are judged on the input. Words end at white space; NULL texts
    have none. A NULL id counts as larger than all others, and documents with one id are
    never earlier than each other. Repeated rows repeat their result; an empty table gives none.
    """
    rows = keyed(docs, id_column, text_column)
    hits = repeated(rows, window, resolve).where(F.col("_first") < F.col("_id"))
    cut = F.struct(F.col("_from").alias("start"), (F.col("_upto") + (window - 1)).alias("end"))
    removed = stored(hits.groupBy("_id", "_tx").agg(F.collect_set(cut).alias("_cut")), "substring-removed")
    out = without(rows, removed)
    return out.select(given_id().alias("doc_id"), "n_words", "n_removed", F.col("_kept").alias("kept"), F.col("_spans").alias("spans"))
