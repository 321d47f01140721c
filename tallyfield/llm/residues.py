"""Hard negatives by exact inner products in a residue number system.

Integer vectors are reduced modulo a few small primes. The products of two blocks are then taken modulo each
prime by a matrix product in float32, whose sums stay below 2^24 and so are exact whatever their order,
and the signed scores come back by Chinese remaindering. A first pass finds each anchor's
positives, a second the negatives in the window of scores that each positive opens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.llm.blocks import blocks_of, dealt, finite, first_of, lots, matrix, meeting
from tallyfield.llm.common import pieces, stored

#: Anchors of a block, and rows of a block at most.
ANCHORS, ROWS = 4096, 8192
#: Components of one float32 product; longer vectors are summed modulo the prime in between.
SPAN = 1024
#: Scores that a task holds at once.
TILE = 1 << 20


def primes_for(width: int, bound: int) -> list[int]:
    """Odd primes, largest first, whose residues keep a sum of ``width`` products below 2^24 and whose product exceeds 2 ``bound``."""
    span = max(min(width, SPAN), 1)
    at = 2 * int((((1 << 24) - 1) // span) ** 0.5) + 1
    chosen, product = [], 1
    while product <= 2 * bound:
        while any(at % q == 0 for q in range(3, int(at**0.5) + 1, 2)):
            at -= 2
        chosen.append(at)
        product *= at
        at -= 2
    return chosen or [3]


def centred(x: np.ndarray, prime: int) -> np.ndarray:
    """The residue of least magnitude."""
    half = prime // 2
    return (x + half) % prime - half


def exact_products(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """All inner products of the integer rows of ``a`` with those of ``b``, as 64-bit integers."""
    digits: list[np.ndarray] = []
    for k, prime in enumerate(primes):
        total = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], SPAN):
            left, right = (centred(x[:, at : at + SPAN], prime).astype(np.float32) for x in (a, b))
            total += (left @ right.T).astype(np.int64)
        rest, weight = total % prime, 1
        # mixed radix: what the digits so far leave over, divided by the primes so far
        for j in range(k):
            rest = (rest - digits[j] * (weight % prime)) % prime
            weight *= primes[j]
        digits.append(centred(rest * pow(weight, -1, prime) % prime, prime))
    out, weight = np.zeros((len(a), len(b)), np.int64), 1
    for digit, prime in zip(digits, primes):
        out += digit * np.int64((weight + 2**63) % 2**64 - 2**63)  # modulo 2^64; the whole fits
        weight *= prime
    return out


def packed(rows: DataFrame, key: str, most: int, width: int, scale: int, kind: str, extra: dict[str, str]) -> DataFrame:
    """Rows (key, _id, _label, _v, extra longs or long lists) as blocks of at most ``most``, in binary columns.

    Rows that repeat an id, a label and a vector are one.
    """
    names = ["_n", "_ids", "_labels", "_ints", *extra]
    schema = f"{key} int, _n int, " + ", ".join(f"{c} binary" for c in names[1:])
    columns = [key, "_id", "_label", "_v", *extra]
    ready = rows.select(*columns).repartition(pieces(rows.sparkSession), key).sortWithinPartitions(key, "_id", "_label", "_v")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(own: list[list[np.ndarray]], at: int) -> pa.RecordBatch:
            joined = [np.concatenate(c) for c in zip(*own)]
            values = [[at], [len(joined[0])], *[[x.tobytes()] for x in joined]]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * (len(names) - 1)]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[key, *names])

        held: list[list[np.ndarray]] = []
        at, size, last = None, 0, None
        for batch in filter(len, batches):
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            parts = [batch.column(1).to_numpy(), batch.column(2).to_numpy(), np.floor(scale * matrix(batch.column(3), width)).astype(kind)]
            parts += [np.stack(batch.column(4 + i).to_numpy(zero_copy_only=False)) if e == "list" else batch.column(4 + i).to_numpy() for i, e in enumerate(extra.values())]
            again = np.zeros(len(keys), bool)
            again[1:] = (parts[0][1:] == parts[0][:-1]) & (parts[1][1:] == parts[1][:-1]) & (parts[2][1:] == parts[2][:-1]).all(axis=1)
            if last is not None:
                again[0] = all(np.array_equal(x, p[0]) for x, p in zip(last, parts))
            last = [p[-1] for p in parts[:3]]
            places = np.flatnonzero(~again)
            for k in np.unique(keys[places]):
                own = places[keys[places] == k]
                while len(own):
                    if at is not None and (k != at or size >= most):
                        yield block(held, at)
                        held, size = [], 0
                    at, now = int(k), own[: most - size]
                    held.append([p[now] for p in parts])
                    size, own = size + len(now), own[len(now) :]
        if held:
            yield block(held, at)

    return ready.mapInArrow(each, schema)


class Found:
    """The first ``k`` of each group over the blocks seen so far."""

    def __init__(self, k: int):
        self.k, self.group, self.score, self.ids = k, *(np.zeros(0, np.int64) for _ in range(3))

    def take(self, scores: np.ndarray, fit: np.ndarray, ids: np.ndarray, groups: np.ndarray) -> None:
        if scores.shape[1] > self.k:
            masked = np.where(fit, scores, np.iinfo(np.int64).min)
            fit = fit & (masked >= np.partition(masked, -self.k, axis=1)[:, -self.k, None])
        row, column = np.nonzero(fit)
        new = [np.concatenate(x) for x in ((self.group, groups[row]), (self.score, scores[row, column]), (self.ids, ids[column]))]
        kept = first_of(*new, self.k)
        self.group, self.score, self.ids = (x[kept] for x in new)


def mine(
    vectors: DataFrame, anchors_of: int = 50, moved: int = 7, scale: int = 256, n_labels: int = 10, n_positives: int = 5, n_negatives: int = 3
) -> DataFrame:
    """Hard negatives of every anchor and positive, from (vec_id, embedding, label).

    Rows without an id, a label or a vector, or with a component that is NULL or not finite, take no part. Labels of
    ids divisible by ``moved`` move on by one, modulo ``n_labels``. A component x counts as floor(scale x);
    shorter vectors are padded with zeros. Anchors are the ids divisible by ``anchors_of``; of several rows with an
    anchor's id the least is the anchor, and none of them is its positive. Rows that repeat id, label and
    vector are one; rows that share only the id stand for themselves. Ties go to the smaller id. An empty
    table gives an empty result. Scores that may not fit 62 bits are refused.
    """
    spark, v = vectors.sparkSession, F.col("embedding")
    told = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
    own_id = F.col("vec_id").cast("long")
    label = F.when(own_id % moved == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label")).cast("long")
    rows = vectors.where(told).where(finite(v)).select(own_id.alias("_id"), label.alias("_label"), v.alias("_v"))
    largest = lambda c: F.abs(F.floor(c.cast("double") * scale))
    edge = F.coalesce(F.greatest(largest(F.array_max("_v")), largest(F.array_min("_v"))), F.lit(0))
    width, most = rows.agg(F.max(F.size("_v")), F.max(edge)).first()
    width, most = max(width or 0, 1), int(most or 0)
    bound = width * most * most
    if bound >= 1 << 62:
        raise OverflowError(f"scores of {width} components up to {most} may not fit a long")
    kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64"
    primes = primes_for(width, bound)
    anchors = rows.where(F.col("_id") % anchors_of == 0).groupBy("_id").agg(F.min(F.struct("_label", "_v")).alias("_own")).select("_id", "_own.*")
    anchors = stored(anchors, "mining-anchors")
    n_blocks, n_lots = blocks_of(anchors, ANCHORS), lots(spark)
    placed = anchors.withColumn("_block", dealt(F.xxhash64("_id"), n_blocks))
    held = stored(packed(rows.withColumn("_lot", dealt(F.xxhash64("_id"), n_lots)), "_lot", ROWS, width, scale, kind, {}), "mining-rows")

    def against(queries: DataFrame, k: int, slots: int, schema: str) -> DataFrame:
        """The first ``k`` rows of each anchor (slots = 1: positives) or of each of its windows of scores."""
        q = {c: f"_q{c}" for c in queries.columns if c != "_block"}
        both = meeting(held, queries.withColumnsRenamed(q), n_lots, n_blocks).select("_block", "_n", "_ids", "_labels", "_ints", *q.values())

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def result() -> pa.RecordBatch:
                at = found.group // slots
                values = [ids_a[at], found.score, found.ids]
                if slots > 1:
                    values += [x.reshape(-1)[found.group] for x in (positive_id, positive_score)] + [found.group % slots]
                return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in values], names=[c.split()[0] for c in schema.split(", ")])

            block = found = ids_a = None
            for batch in batches:
                for r in batch.to_pylist():
                    n, m = r["_q_n"], r["_n"]
                    if r["_block"] != block:
                        if block is not None:
                            yield result()
                        block, found = r["_block"], Found(k)
                        ids_a, labels_a = np.frombuffer(r["_q_ids"], np.int64), np.frombuffer(r["_q_labels"], np.int64)
                        ints_a = np.frombuffer(r["_q_ints"], kind).reshape(n, width).astype(np.int64)
                        if slots > 1:
                            positive_id, positive_score = (np.frombuffer(r[f"_q{c}"], np.int64).reshape(n, slots) for c in ("_positive", "_score"))
                            given = np.frombuffer(r["_q_many"], np.int64)
                    ids, labels = np.frombuffer(r["_ids"], np.int64), np.frombuffer(r["_labels"], np.int64)
                    ints = np.frombuffer(r["_ints"], kind).reshape(m, width).astype(np.int64)
                    step = max(TILE // m, 1)
                    for lo in range(0, n, step):
                        here = np.arange(lo, min(lo + step, n))
                        scores = exact_products(ints_a[here], ints, primes)
                        alike = labels_a[here, None] == labels
                        if slots == 1:
                            found.take(scores, alike & (ids_a[here, None] != ids), ids, here)
                            continue
                        for s in range(slots):
                            p = positive_score[here, s, None]
                            # 50 p <= 100 n <= 95 p in whole numbers that cannot overflow
                            fit = ~alike & (scores >= p - p // 2) & (scores <= p + (-p) // 20) & (given[here, None] > s)
                            found.take(scores, fit, ids, here * slots + s)
            if block is not None:
                yield result()

        return both.mapInArrow(each, schema)

    query = packed(placed, "_block", 1 << 30, width, scale, kind, {})
    near = against(stored(query, "mining-queries"), n_positives, 1, "_anchor long, _score long, _other long")
    order = Window.partitionBy("_anchor").orderBy(F.desc("_score"), "_other")
    first = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n_positives)
    listed = first.groupBy("_anchor").agg(F.sort_array(F.collect_list(F.struct("_place", "_other", "_score"))).alias("_all"))
    padded = lambda c: F.slice(F.concat(F.col(f"_all.{c}"), F.array_repeat(F.lit(0).cast("long"), n_positives)), 1, n_positives)
    positives = stored(
        listed.select("_anchor", padded("_other").alias("_positive"), padded("_score").alias("_score"), F.size("_all").cast("long").alias("_many")), "mining-positives"
    )
    asked = placed.join(positives, F.col("_id") == F.col("_anchor")).drop("_anchor")
    windows = packed(asked, "_block", 1 << 30, width, scale, kind, {"_positive": "list", "_score": "list", "_many": "long"})
    hard = against(
        stored(windows, "mining-windows"), n_negatives, n_positives, "_anchor long, _score long, _other long, _positive long, _positive_score long, _slot long"
    )
    order = Window.partitionBy("_anchor", "_slot").orderBy(F.desc("_score"), "_other")
    return (
        hard.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= n_negatives)
        .select(
            F.col("_anchor").alias("anchor_id"),
            F.col("_positive").alias("positive_id"),
            F.col("_place").alias("rank"),
            F.col("_other").alias("negative_id"),
            F.col("_positive_score").alias("positive_score"),
            F.col("_score").alias("negative_score"),
        )
    )
