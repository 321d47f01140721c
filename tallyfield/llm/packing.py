"""Best-fit packing of tokenised documents by bin completion with branch and bound.

Only the number of pieces of each length matters for the packing, so the search runs over a
histogram with at most ``capacity`` entries, however many pieces there are. A branch completes
the sequence of the largest piece left with a maximal filling, at first as often as the counts
allow; a branch ends when the waste so far cannot beat the incumbent, which is at first the
best-fit-decreasing packing. The result is a list of patterns with multiplicities; each
piece finds its sequence from its rank among the pieces of its length, in a distributed join.
"""

from __future__ import annotations

import bisect
import functools
import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import given_id, keyed, numbered, stored
from tallyfield.llm.secretscan import encoding

Pattern = tuple[tuple[int, ...], int]
#: Branches opened before the incumbent is accepted; it bounds the search, never the data.
BRANCHES = 3000


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str, path: str, ranks: str | None, specials: tuple[str, ...]) -> list[int]:
    """Ids under the tokenizer file; ``ranks`` names the same vocabulary for the faster encoder.

    Texts that hold the name of a special token go to the tokenizer itself, which knows it.
    """
    if ranks is None or any(s in text for s in specials):
        return tokenizer(path).encode(text, add_special_tokens=False).ids
    return encoding(ranks).encode_ordinary(text)


PIECES = pa.schema(
    [("_id", pa.int64()), ("_tx", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def pieces_of(docs: DataFrame, path: str, ranks: str | None, end_id: int, capacity: int, id_column: str, text_column: str) -> DataFrame:
    """One row per piece. A longer document is cut from its end, so its first piece may be shorter."""
    specials = tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, t, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([*token_ids(text, path, ranks, specials), end_id], "<u4")
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out.append((i, t, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*out)) or [[] for _ in PIECES]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

    kinds = "_id long, _tx long, piece int, start long, length long, ids_crc32 long"
    return keyed(docs, id_column, text_column).mapInArrow(each, kinds)


# ---- the packing of a histogram --------------------------------------------------------------


def best_fit_decreasing(counts: np.ndarray) -> list[Pattern]:
    """Pieces by falling length, each into the fullest sequence that still takes it, in bulk."""
    capacity = len(counts) - 1
    open_at: dict[int, list[list]] = defaultdict(list)
    held = np.zeros(capacity + 1, np.int64)
    for size in range(capacity, 0, -1):
        n = int(counts[size])
        while n:
            fits = np.flatnonzero(held[size:])
            if len(fits):
                room = size + int(fits[0])
                group = open_at[room].pop()
                take = min(n, group[1])
                if take < group[1]:
                    open_at[room].append([group[0], group[1] - take])
                held[room] -= take
                added = (size,)
            else:
                room, each = capacity, min(n, capacity // size)
                take, added, group = n // each, (size,) * each, [(), 0]
            n -= take * len(added)
            left = room - size * len(added)
            open_at[left].append([(*group[0], *added), take])
            held[left] += take
    return [(sizes, m) for groups in open_at.values() for sizes, m in groups]


def reached(lengths: list[int], counts: list[int], room: int) -> array:
    """For each sum up to ``room``, the first length with which the lengths so far reach it; -1 for the sum 0."""
    first = array("h", [len(lengths)]) * (room + 1)
    first[0] = -1
    mask, sums = (1 << room + 1) - 1, 1
    for i, (size, n) in enumerate(zip(lengths, counts)):
        before, n, step = sums, min(n, room // size), 1
        while n:
            step = min(step, n)
            sums |= sums << step * size & mask
            n, step = n - step, 2 * step
        fresh = sums & ~before
        while fresh:
            low = fresh & -fresh
            first[low.bit_length() - 1] = i
            fresh ^= low
    return first


def fillings(room: int, counts: np.ndarray) -> Iterator[tuple[int, ...]]:
    """Every maximal filling of ``room``: no piece that is left would still fit. Least waste first, then one or two pieces, then
    larger pieces.

    A filling that wastes w is maximal if it takes all pieces of at most w. The others are told
    by the sums that they reach, so no step runs into a dead end. An exact single piece dominates
    every other filling and comes alone.
    """
    held = np.flatnonzero(counts[: room + 1])
    sizes = held[held > 0].tolist()
    if sizes and sizes[-1] == room:
        yield (room,)
        return
    number = [int(counts[x]) for x in sizes]

    def exact(total: int, at: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
            return
        for j in range(at, first[total] - 1, -1):
            for n in range(min(free_counts[j], total // free[j]), 0, -1):
                if first[total - n * free[j]] < j:
                    for f in exact(total - n * free[j], j - 1):
                        yield (free[j],) * n + f

    small: int | None = None
    for waste in range(room + 1):
        forced = bisect.bisect_right(sizes, waste)
        if forced != small:
            small = forced
            base = sum(x * n for x, n in zip(sizes[:small], number))
            if base > room - waste:
                return
            tail = tuple(x for x, n in zip(sizes[:small][::-1], number[:small][::-1]) for _ in range(n))
            free, free_counts = sizes[small:], number[small:]
            first = reached(free, free_counts, room)
        total = room - waste - base
        if total < 0:
            return
        if first[total] < len(free):
            have = dict(zip(free, free_counts))
            for x in reversed(free):  # one or two pieces keep the small ones for later
                y = total - x
                if y == 0 or 0 < y < x and y in have or y == x and have[x] > 1:
                    yield (x, y)[: 1 + (y > 0)] + tail
            for f in exact(total, len(free) - 1):
                if not 0 < len(f) < 3:
                    yield f + tail


def least(counts: np.ndarray) -> int:
    """A lower bound: all tokens over the capacity, and no two pieces above half together."""
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    return max(-(-int((counts * sizes).sum()) // capacity), int(counts[capacity // 2 + 1 :].sum()))


def completions(counts: np.ndarray) -> Iterator[tuple[Pattern, int]]:
    """Patterns with the largest piece left, with multiplicity and waste of one sequence.

    First each as often as the counts allow, then all of them again less often. Without a bound on
    the branches this covers every packing.
    """
    capacity, size = len(counts) - 1, int(np.flatnonzero(counts)[-1])
    left = counts.copy()
    left[size] -= 1
    for again in (False, True):
        for filling in fillings(capacity - size, left):
            pattern = (size, *filling)
            kinds, each = np.unique(pattern, return_counts=True)
            most = int((counts[kinds] // each).min())
            for m in range(most - 1, 0, -1) if again else (most,):
                yield (pattern, m), capacity - sum(pattern)


def pack(histogram: np.ndarray, branches: int = BRANCHES) -> list[Pattern]:
    """Patterns and multiplicities that hold every piece of the histogram (index: length)."""
    capacity = len(histogram) - 1
    incumbent = best_fit_decreasing(histogram)
    best, bound = sum(m for _, m in incumbent), least(histogram)
    total = int((histogram * np.arange(capacity + 1)).sum())
    stack: list[tuple[np.ndarray, Iterator, tuple | None, int]] = []
    if best > bound and branches:
        start = histogram.astype(np.int64)
        stack.append((start, completions(start), None, 0))
    while stack and best > bound and branches:
        counts, ways, path, waste = stack[-1]
        slack = (best - 1) * capacity - total - waste
        pattern, each_waste = next(ways, (None, 0))
        if pattern is None or each_waste > slack:  # the rest wastes no less
            stack.pop()
            continue
        branches -= 1
        if pattern[1] * each_waste > slack:
            continue
        kinds, each = np.unique(pattern[0], return_counts=True)
        after = counts.copy()
        after[kinds] -= pattern[1] * each
        path = (pattern, path)
        if after.any():
            stack.append((after, completions(after), path, waste + pattern[1] * each_waste))
            continue
        done = []
        while path:
            done.append(path[0])
            path = path[1]
        incumbent, best = done, sum(m for _, m in done)
    return incumbent


def places(patterns: list[Pattern]) -> dict[int, list[tuple[int, int, int, int]]]:
    """By length: (first rank, pieces per sequence, first sequence, first offset) of each pattern."""
    out: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for sizes, m in patterns:
        at = 0
        for size in sorted(set(sizes), reverse=True):
            each = sizes.count(size)
            out[size].append((used[size], each, sequence, at))
            used[size] += each * m
            at += each * size
        sequence += m
    return out


def pack_documents(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A NULL or empty text is the end token alone. Repeated rows are packed as often as they come.
    Sequences fill from offset 0 without gaps. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    found = stored(pieces_of(docs, tokenizer_path, ranks_path, end_id, capacity, id_column, text_column), "pack-pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in found.groupBy("length").count().collect():
        histogram[length] = n
    rows = [(k, [tuple(p) for p in v]) for k, v in places(pack(histogram)).items()]
    plan = spark.createDataFrame(rows, "_length long, _plan array<struct<rank:long,each:long,sequence:long,at:long>>")
    ranked = numbered(found, "length", F.xxhash64("_id", "_tx", "piece"), ["_id", "_tx", "piece"], "_rank")
    hit = F.element_at(F.expr("filter(_plan, p -> p.rank <= _rank)"), -1)
    turn = F.col("_rank") - F.col("_hit.rank")
    return (
        ranked.join(plan, F.col("length") == F.col("_length"))
        .withColumn("_hit", hit)
        .select(
            given_id().alias("doc_id"),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_hit.sequence") + F.expr("(_rank - _hit.rank) div _hit.each")).alias("sequence_id"),
            (F.col("_hit.at") + turn % F.col("_hit.each") * F.col("length")).cast("long").alias("offset"),
        )
    )
