"""Ranked lexical search over bit-sliced Bloom signatures, exact in its results.

Documents of a like number of entries stand as the columns of a block of bits; each of the ``HASHES`` rows that
a term chooses is a slice over all documents of the block, and the slices' conjunction holds every
document that has the term, and a few that have not. Terms enter once for each of the ``STEPS`` that their
occurrences reach, so a conjunction also bounds the occurrences from above. The slices of an item's terms,
weighted and summed, bound the scores of the whole block; documents whose bound falls below the worst
of the best so far are out, all others are rescored exactly from their terms and counts, which
the block keeps beside its slices. Blocks are built once, in one pass over the texts and without a shuffle of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.llm.blocks import blocks_of, dealt, lots, meeting_in_place
from tallyfield.llm.common import ALNUM, LAST_ID, LOWER, Words, mixed, own_id, slices, stored

#: A term has an entry for each of these numbers of occurrences that it reaches.
STEPS = np.array([1, 2, 3, 4, 6, 9, 14, 22])
#: Bits for each entry that a class of documents may have, and slices that an entry sets.
BITS, HASHES = 12, 4
#: Documents and bits of a block, slices of a signature, and terms of a block of items, at most.
DOCUMENTS, BLOCK_BITS, WIDEST, ITEM_TERMS = 256, 1 << 22, 1 << 23, 4096
#: Blocks of items whose best documents a task holds at once.
OPEN = 256
#: Distinct terms whose counts a task holds before it passes them on.
COUNTED = 500_000

_BYTE = np.random.default_rng(29).integers(1, 2**63, 256, dtype=np.uint64)


def term_hashes(words: Words) -> np.ndarray:
    """A sum over each term of a hash of byte and place: no repeating pattern of bytes cancels out."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = words.ends - words.starts
    begins = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begins, size)
    byte = LOWER[words.data[np.repeat(words.starts, size) + place]]
    each = mixed(_BYTE[byte] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mixed(np.add.reduceat(each, begins) + size.astype(np.uint64), 17)


def counted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences), by row and then by term."""
    term = term_hashes(words)
    order = np.lexsort((term, words.row))
    row, term = words.row[order], term[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.r_[at, len(row)])


def chosen(term: np.ndarray, step: int, width: int) -> np.ndarray:
    """The slices of each term's entry for a step, one column for each hash."""
    h = mixed(term, 101 + step)
    start, stride = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((start[:, None] + stride[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def width_of(entries: int) -> int:
    return min(BITS * entries, WIDEST)


def signatures(terms: np.ndarray, many: np.ndarray, owner: np.ndarray, width: int, n: int) -> np.ndarray:
    """The slices of ``n`` documents: ``width`` rows of packed bits."""
    bits = np.zeros((width, n), bool)
    for step, least in enumerate(STEPS):
        on = many >= least
        bits[chosen(terms[on], step, width).reshape(-1), np.repeat(owner[on], HASHES)] = True
    return np.packbits(bits, axis=1)


def reached(slices_: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
    """For each term and document the number of steps that its occurrences may have reached, never too small."""
    width = len(slices_)
    steps = np.zeros((len(terms), n), np.uint8)
    live, held = np.arange(len(terms)), None
    for step in range(len(STEPS)):
        at = chosen(terms[live], step, width)
        rows = slices_[at[:, 0]]
        for k in range(1, HASHES):
            rows &= slices_[at[:, k]]
        if held is not None:
            rows &= held
        some = rows.any(axis=1)
        live, held = live[some], rows[some]
        if not len(live):
            break
        steps[live] += np.unpackbits(held, axis=1)[:, :n]
    return steps


def share(occurrences: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The saturating share of a term's weight; it grows with the occurrences."""
    return 1_000_000_000 * occurrences // (1000 * occurrences + 8 * m)


def bounds(m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The greatest share for each number of steps reached (rows) and document (columns)."""
    most = np.r_[0, STEPS[1:] - 1, np.iinfo(np.int32).max]
    return share(np.minimum(most[:, None], n), m).astype(np.float64)


BLOCK = "_lot int, _docs int, _words long, _width int, _ids binary, _sizes binary, _slices binary, _ends binary, _terms binary, _many binary, _term long, _holds long"
NAMES = [c.split()[0] for c in BLOCK.split(", ")]
KINDS = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in BLOCK.split(", ")]


def indexed(docs: DataFrame, n_lots: int) -> DataFrame:
    """Blocks of documents with their slices, terms and counts, and rows (_term, _holds) of documents that hold a term."""

    def record(values: dict[str, list]) -> pa.RecordBatch:
        n = len(next(iter(values.values())))
        return pa.RecordBatch.from_arrays([pa.array(values[c], k) if c in values else pa.nulls(n, k) for c, k in zip(NAMES, KINDS)], names=NAMES)

    def block(kind: int, held: list[tuple]) -> pa.RecordBatch:
        ids, sizes, distinct = (np.array(x, np.int64) for x in zip(*[h[:3] for h in held]))
        terms, many = (np.concatenate([h[k] for h in held]) for k in (3, 4))
        width = width_of(1 << kind)
        packed = signatures(terms, many, np.repeat(np.arange(len(held)), distinct), width, len(held))
        whole = {"_ids": ids, "_sizes": sizes, "_slices": packed, "_ends": np.cumsum(distinct), "_terms": terms, "_many": many.astype(np.int32)}
        values = {c: [v.tobytes()] for c, v in whole.items()}
        return record(values | {"_lot": [zlib.crc32(values["_ids"][0]) % n_lots], "_docs": [len(held)], "_words": [int(sizes.sum())], "_width": [width]})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        seen, held = [np.zeros(0, np.uint64)], 0

        def passed() -> pa.RecordBatch:
            term, many = np.unique(np.concatenate(seen), return_counts=True)
            return record({"_term": term.view(np.int64), "_holds": many})

        for batch in slices(batches, "_text"):
            row, term, many = counted(Words(batch.column("_text"), ALNUM))
            seen.append(term)
            held += len(term)
            if held >= 4 * COUNTED:
                yield passed()
                seen, held = [], 0
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            total = np.bincount(row, many, batch.num_rows).astype(np.int64)
            entries = np.bincount(row, np.searchsorted(STEPS, many, "right"), batch.num_rows).astype(np.int64)
            for i, own in enumerate(batch.column("_id").to_pylist()):
                if not entries[i]:
                    continue
                kind = int(entries[i] - 1).bit_length()
                group = waiting.setdefault(kind, [])
                a, b = edge[i], edge[i + 1]
                group.append((own, total[i], b - a, term[a:b].copy(), many[a:b].copy()))
                if len(group) >= max(min(DOCUMENTS, BLOCK_BITS // width_of(1 << kind)), 1):
                    yield block(kind, waiting.pop(kind))
        for kind, group in waiting.items():
            yield block(kind, group)
        if held:
            yield passed()

    return docs.mapInArrow(each, BLOCK)


def item_terms(items: DataFrame) -> DataFrame:
    """(_item, _term): the terms of each item, once each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            row, term, _ = counted(Words(batch.column("_text"), ALNUM))
            yield pa.RecordBatch.from_arrays([batch.column("_item").take(pa.array(row)), pa.array(term.view(np.int64))], names=["_item", "_term"])

    return items.select("_item", "_text").mapInArrow(each, "_item long, _term long")


PACKED = ["_items", "_item_terms", "_weights"]


def packed_items(weighted: DataFrame) -> DataFrame:
    """(_block, _item, _term, _w) as one row of binary columns for each block."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def block() -> pa.RecordBatch:
            joined = [np.concatenate(c).tobytes() for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), *[pa.array([x], pa.binary()) for x in joined]], names=["_block", *PACKED])

        for batch in filter(len, batches):
            keys, *values = (batch.column(k).to_numpy() for k in range(4))
            for k in np.unique(keys):
                if at is not None and k != at:
                    yield block()
                    held = []
                at = int(k)
                held.append([v[keys == k] for v in values])
        if held:
            yield block()

    spread = weighted.select("_block", "_item", "_term", "_w").repartition("_block").sortWithinPartitions("_block", "_item", "_term")
    return spread.mapInArrow(each, "_block int, " + ", ".join(f"{c} binary" for c in PACKED))


class Best:
    """The best ``k`` of an item so far, by descending score and ascending id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def floor(self) -> int:
        """The least score that can still matter."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def take(self, scored: list[tuple[int, int]]) -> None:
        self.rows = sorted(self.rows + [(-s, i) for s, i in scored if s > 0])[: self.k]


class Items:
    """A block of items: their terms and weights, and the best documents so far."""

    def __init__(self, items: bytes, terms: bytes, weights: bytes, k: int):
        items, self.weights = np.frombuffer(items, np.int64), np.frombuffer(weights, np.int64)
        self.names, first = np.unique(items, return_index=True)
        self.cut, self.best = np.r_[first, len(items)], [Best(k) for _ in self.names]
        self.terms, self.at = np.unique(np.frombuffer(terms, np.uint64), return_inverse=True)

    def search(self, block: Documents, k: int) -> None:
        """Bound the scores of all documents of a block and rescore those that may be among the best."""
        steps = reached(block.slices, self.terms, block.n)
        across = np.arange(block.n)
        for item, found in enumerate(self.best):
            span = slice(self.cut[item], self.cut[item + 1])
            at, weights = self.at[span], self.weights[span]
            bound = weights.astype(np.float64) @ block.most[steps[at], across] * (1 + 1e-12)
            # the likeliest first; they raise the floor for the rest
            likely = np.argsort(-bound, kind="stable")[:k]
            rest = np.ones(block.n, bool)
            rest[likely] = False
            for some in (likely, np.flatnonzero(rest)):
                some = some[bound[some] >= found.floor()]
                if len(some):
                    found.take([(block.score(d, self.terms[at], weights), int(block.ids[d])) for d in some])

    def result(self) -> pa.RecordBatch:
        rows = [(int(i), -s, d) for i, b in zip(self.names, self.best) for s, d in b.rows]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], names=["_item", "_score", "_id"])


class Documents:
    """A block of documents: slices for the bounds, terms and counts for the scores."""

    def __init__(self, r: dict, n_docs: int, n_words: int):
        whole = lambda c, kind=np.int64: np.frombuffer(r[c], kind)
        self.n, self.ids, sizes, self.ends = r["_docs"], whole("_ids"), whole("_sizes"), np.r_[0, whole("_ends")]
        self.terms, self.many = whole("_terms", np.uint64), whole("_many", np.int32).astype(np.int64)
        self.m = np.array([10 + 90 * s * n_docs // n_words for s in sizes.tolist()])
        self.slices, self.most = whole("_slices", np.uint8).reshape(r["_width"], -1), bounds(self.m, sizes)

    def score(self, d: int, terms: np.ndarray, weights: np.ndarray) -> int:
        own, many = (x[self.ends[d] : self.ends[d + 1]] for x in (self.terms, self.many))
        place = np.minimum(np.searchsorted(own, terms), len(own) - 1)
        met = own[place] == terms
        return int((weights[met] * share(many[place[met]], self.m[d])).sum())


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score.

    Terms are runs of ASCII letters, digits and all beyond ASCII, A-Z in lower case; a NULL text has none. The score
    is the sum, over an item's terms, of the term's whole-number weight and a share that saturates with its
    occurrences and falls with the document's length; scores above 0 count. Equal scores come by ascending doc_id, NULL
    last. Each row of ``docs`` is a document of its own, repeated rows too; item rows that repeat id and text
    are one item, rows that share only the id are items of their own. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    # a block is near a megabyte: batches of 64 would stand in memory twice for each core
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    n_lots = lots(spark)
    texts = docs.select(own_id().alias("_id"), F.col("text").cast("string").alias("_text")).where(F.col("_text").isNotNull())
    index = stored(indexed(texts, n_lots), "slice-blocks")
    blocks = index.where(F.col("_docs").isNotNull()).drop("_term", "_holds")
    n_docs, n_words = (int(x or 0) for x in blocks.agg(F.sum("_docs"), F.sum("_words")).first())
    distinct = items.select("item_id", F.col("text").cast("string").alias("_text")).where(F.col("_text").isNotNull()).distinct()
    asked = stored(distinct.withColumn("_item", F.monotonically_increasing_id()), "slice-items")
    terms = stored(item_terms(asked), "slice-item-terms")
    held = index.where(F.col("_holds").isNotNull()).select("_term", "_holds").join(terms.select("_term").distinct(), "_term")
    holds = held.groupBy("_term").agg(F.sum("_holds").alias("_holds"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("_holds") + 1)))
    n_blocks = blocks_of(terms, ITEM_TERMS)
    weighted = terms.join(holds, "_term").select(dealt(F.xxhash64("_item"), n_blocks).alias("_block"), "_item", "_term", weight.alias("_w"))
    queries = stored(packed_items(weighted), "slice-queries")
    both = meeting_in_place(blocks, queries, n_lots, n_blocks, PACKED)
    columns = ["_block", "_docs", "_width", "_ids", "_sizes", "_slices", "_ends", "_terms", "_many", *PACKED]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Items] = {}
        for batch in batches:
            for place in range(batch.num_rows):
                r = {c: batch.column(i)[place].as_py() for i, c in enumerate(columns)}
                if r["_block"] not in opened:
                    if len(opened) == OPEN:
                        yield opened.pop(next(iter(opened))).result()
                    opened[r["_block"]] = Items(*[r[c] for c in PACKED], k)
                opened[r["_block"]].search(Documents(r, n_docs, n_words), k)
        for items_ in opened.values():
            yield items_.result()

    near = both.select(columns).mapInArrow(each, "_item long, _score long, _id long")
    order = Window.partitionBy("_item").orderBy(F.desc("_score"), "_id")
    top = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("_item", "item_id"), "_item").select(
        "item_id", "rank", F.when(F.col("_id") != LAST_ID, F.col("_id")).alias("doc_id"), F.col("_score").alias("score")
    )
