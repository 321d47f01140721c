"""Near-duplicate vectors by counting collisions on sorted one-dimensional projections.

Two unit vectors at a distance r differ by a normal variable of deviation r on a Gaussian direction. On each of
``PROJECTIONS`` directions the values are sorted, and a vector collides with all whose value lies in
the window around its own. The collisions of a pair follow a binomial law that the threshold fixes, so the least
count that a pair must reach follows from the share of linked pairs that may be lost; pairs that reach it
are verified by their cosine.

Counting meets vectors of one cell only. Cells are signs of further projections, as many as the label's size asks for,
in as many tables as keep the same bound on lost pairs; a pair is counted in the first table in
which it shares a cell. Equal vectors are one node, large cells are dealt in lots whose pairs of lots are
tasks, and a task gives sums and roots per vector, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.bagminhash import classes
from tallyfield.llm.blocks import finite, matrix
from tallyfield.llm.common import LAST_ID, own_id, pieces, stored

#: Share of the pairs just at the threshold that cells, and then counts, may lose.
MISS = 1e-6
#: Projections counted, and the half width of a window in deviations of a pair at the threshold.
PROJECTIONS, REACH = 16, 2.6
#: Vectors that a cell is to hold, and that a lot of a larger cell holds.
CELL, LOT = 512, 1024


def least_count(projections: int = PROJECTIONS, reach: float = REACH, miss: float = MISS) -> int:
    """The largest count that a pair at the threshold falls short of with a probability of at most ``miss``."""
    p = math.erf(reach / math.sqrt(2))
    short = 0.0
    for count in range(projections + 1):
        short += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if short > miss:
            return count
    return projections


def tables_for(bits: int, threshold: float, miss: float = MISS) -> int:
    """Tables of ``bits`` signs each in which a pair at the threshold shares no cell with a probability of at most ``miss``."""
    share = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if share == 1 else math.ceil(math.log(miss) / math.log(1 - share))


@lru_cache(maxsize=32)
def directions(width: int, purpose: int, n: int) -> np.ndarray:
    return np.random.default_rng([width, purpose]).normal(size=(n, width)).T


def cells(vectors: np.ndarray, bits: int, first: int, last: int) -> np.ndarray:
    """The cell of each vector in tables ``first`` to ``last``: signs of whole-number products, the same in any batch."""
    if not bits:
        return np.zeros((len(vectors), last - first), np.int64)
    whole = np.rint(vectors / np.abs(vectors).max(axis=1, keepdims=True) * 32767)
    drawn = np.rint(directions(vectors.shape[1], 1, last * bits)[:, first * bits :] * 1024)
    signs = (whole @ drawn > 0).reshape(len(vectors), last - first, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def collisions(left: np.ndarray, right: np.ndarray, window: float) -> np.ndarray:
    """How often each row of ``left`` (vectors by projections) has each row of ``right`` in its window."""
    count, row = np.zeros((len(left), len(right)), np.uint8), np.arange(len(left))
    for own, other in zip(left.T, right.T):
        order = np.argsort(other, kind="stable")
        line = other[order]
        edge = np.zeros((len(left), len(right) + 1), np.int8)
        edge[row, np.searchsorted(line, own - window, "left")] += 1
        edge[row, np.searchsorted(line, own + window, "right")] -= 1
        count[:, order] += np.cumsum(edge[:, :-1], axis=1, dtype=np.int8).view(np.uint8)
    return count


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place reachable from each of ``n`` by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        lower = root.copy()
        np.minimum.at(lower, a, low)
        np.minimum.at(lower, b, low)
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def links_of(table: pa.Table, threshold: float, most: int) -> tuple[np.ndarray, ...]:
    """(node, links, root) of the vectors of a pair of lots that have links found first in their table."""
    width, at, bits, i, j = (table.column(c)[0].as_py() for c in ("_width", "_table", "_bits", "_low", "_high"))
    table = table.combine_chunks().sort_by("_node")
    vectors = matrix(table.column("_v").chunk(0), width)
    node, many, lot = (table.column(c).to_numpy() for c in ("_node", "_many", "_lot"))
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    distance = math.sqrt(2 - 2 * threshold)
    on_line = unit @ directions(width, 0, PROJECTIONS)
    rows, columns = np.flatnonzero(lot == i), np.flatnonzero(lot == j)
    enough = collisions(on_line[rows], on_line[columns], REACH * distance * (1 + 1e-9)) >= least_count()
    a, b = np.nonzero(enough)
    a, b = rows[a], columns[b]
    if i == j:
        a, b = a[a < b], b[a < b]
    cosine = np.concatenate([np.einsum("ij,ij->i", unit[a[x : x + most]], unit[b[x : x + most]]) for x in range(0, len(a), most)] or [np.zeros(0)])
    a, b = a[cosine >= threshold], b[cosine >= threshold]
    if at:
        earlier = cells(vectors, bits, 0, at)
        new = ~(earlier[a] == earlier[b]).any(axis=1)
        a, b = a[new], b[new]
    n = len(node)
    links = np.bincount(a, many[b], n) + np.bincount(b, many[a], n)
    met = np.flatnonzero(links)
    return node[met], links[met].astype(np.int64), node[roots(n, a, b)[met]]


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors of one label and width are linked if their cosine in double precision is at least ``threshold``, and no
    others. A linked pair is found with a probability of 1 - 2e-6 or more; none is found that is not linked.
    Vectors that are NULL, zero, empty or hold NULL or values that are not finite, and those without a label, link with nothing.
    Rows that repeat id, label and vector are one vector whose result each row gets; rows that share only the
    id are vectors of their own. A NULL id is larger than any other; where it alone stands
    for a component, component_id is NULL. An empty table gives an empty result.
    """
    spark, v = vectors.sparkSession, F.col("embedding")
    rows = vectors.select(own_id("vec_id").alias("_id"), F.col("label").alias("_label"), v.alias("_v"))
    sound = F.col("_label").isNotNull() & F.col("_v").isNotNull()
    whole = F.coalesce(sound & finite(F.col("_v")) & F.exists("_v", lambda x: x != 0), F.lit(False))
    # equal vectors, each id once, before they meet in one group
    equal = rows.where(whole).groupBy("_label", "_v", "_id").agg(F.lit(1).alias("_one")).groupBy("_label", "_v")
    nodes = stored(
        equal.agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_many")).withColumns({"_node": F.monotonically_increasing_id(), "_width": F.size("_v")}),
        "vector-nodes",
    )
    sizes = nodes.groupBy(F.col("_label").alias("_of"), F.col("_width").alias("_wide")).agg(F.count(F.lit(1)).alias("_held"))
    bits = F.greatest(F.ceil(F.log2(F.col("_held") / CELL)), F.lit(0)).cast("int")
    sized = nodes.join(sizes, (F.col("_label") == F.col("_of")) & (F.col("_width") == F.col("_wide"))).select("_node", "_label", "_width", bits.alias("_bits"), "_v")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, width, n_bits = (batch.column(c).to_numpy() for c in (0, 2, 3))
            for wide, b in set(zip(width.tolist(), n_bits.tolist())):
                at = np.flatnonzero((width == wide) & (n_bits == b))
                n = tables_for(b, threshold)
                cell = cells(matrix(batch.column(4).take(pa.array(at)), wide), b, 0, n)
                columns = [np.repeat(node[at], n), np.tile(np.arange(n), len(at)), cell.reshape(-1), np.full(n * len(at), b)]
                arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*arrays, batch.column(1).take(pa.array(np.repeat(at, n)))], names=["_node", "_table", "_cell", "_bits", "_label"])

    label_kind = dict(nodes.dtypes)["_label"]
    placed = stored(sized.mapInArrow(route, f"_node long, _table int, _cell long, _bits int, _label {label_kind}").join(nodes.select("_node", "_width"), "_node"), "vector-cells")
    key = ["_label", "_width", "_table", "_cell"]
    crowd = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("_crowd")).where("_crowd > 1")
    spread = placed.join(crowd, key).withColumn("_lots", F.ceil(F.col("_crowd") / LOT).cast("int")).withColumn("_lot", F.pmod(F.xxhash64("_node"), F.col("_lots")).cast("int"))
    met = spread.withColumn("_other", F.explode(F.expr("sequence(0, _lots - 1)"))).select(
        "_node", *key, "_bits", "_lot", F.least("_lot", "_other").alias("_low"), F.greatest("_lot", "_other").alias("_high")
    )
    task = [*key, "_low", "_high"]
    dealt = met.join(nodes.select("_node", "_many", "_v"), "_node").repartition(pieces(spark), *task)

    def each(table: pa.Table) -> pa.Table:
        return pa.table([pa.array(x, pa.int64()) for x in links_of(table, threshold, 1 << 16)], names=["_node", "_links", "_root"])

    found = stored(dealt.groupBy(*task).applyInArrow(each, "_node long, _links long, _root long"), "vector-links")
    edges = stored(found.where("_node != _root").select(F.col("_node").alias("_a"), F.col("_root").alias("_b")).distinct(), "vector-edges")
    linked = found.groupBy("_node").agg(F.sum("_links").alias("_links"))
    labelled = stored(
        nodes.select("_node", "_rep").join(classes(edges), "_node", "left").select("_node", "_rep", F.coalesce("_class", "_node").alias("_class")), "vector-classes"
    )
    heads = labelled.groupBy("_class").agg(F.min("_rep").alias("_head"))
    of_node = labelled.join(heads, "_class").join(linked, "_node", "left").select("_node", "_head", F.coalesce("_links", F.lit(0)).alias("_links"))
    of_vector = nodes.join(of_node, "_node").select(F.col("_label").alias("_l"), F.col("_v").alias("_w"), "_head", (F.col("_links") + F.col("_many") - 1).alias("_links"))
    sound_rows = rows.where(whole).join(of_vector, (F.col("_label") == F.col("_l")) & (F.col("_v") == F.col("_w"))).select("_id", "_links", "_head")
    others = rows.where(~whole).select("_id", F.lit(0).cast("long").alias("_links"), F.col("_id").alias("_head"))
    given = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return sound_rows.unionByName(others).select(
        given("_id").alias("vec_id"), F.col("_links").alias("n_links"), given("_head").alias("component_id"), (F.col("_id") == F.col("_head")).alias("kept")
    )
