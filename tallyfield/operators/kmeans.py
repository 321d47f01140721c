"""K-means of many sizes and starts at once: a pass over the rows serves all of them.

A fit by itself is some thirty small jobs. Here they are the jobs of all fits together, so their number depends
neither on the sizes nor on the starts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Steps of a fit, the move of a centre below which it ends, and rounds of drawn candidates, as Spark's k-means has them.
STEPS, STILL, ROUNDS = 20, 1e-4, 2
#: Rows drawn a round for each centre of the largest size. Spark draws 2; with 6 the best of ten starts varies less from seed to seed.
DRAWN = 6
#: Steps and tries of the fit of the candidates, which gives the start.
START_STEPS, START_TRIES = 30, 4
#: Rows that are compared at a time, so that their distances stay in the cache of a core.
SLICE = 1024
#: Squared distance below which two points are one, as a share of their squared length.
SAME = 1e-12


def slices(batches: Iterable[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, np.column_stack([part.column(c).to_numpy() for c in columns])


def by_size(models: Sequence[np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
    """Models of equal size as one array: their places, and (model, centre, column)."""
    sizes: dict[int, list[int]] = {}
    for place, centres in enumerate(models):
        sizes.setdefault(len(centres), []).append(place)
    return [(places, np.stack([models[i] for i in places])) for places in sizes.values()]


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a centre is the row's nearest, the first of equals, by (centre, model, row), and the squared distance to it."""
    models, size, width = centres.shape
    flat = centres.transpose(1, 0, 2).reshape(size * models, width)
    # (c, x) -> c.c - 2 c.x as one product; x.x is the same for all centres
    apart = np.column_stack([-2.0 * flat, (flat * flat).sum(axis=1)]) @ np.column_stack([points, np.ones(len(points))]).T
    apart = apart.reshape(size, models, len(points))
    least = apart.min(axis=0)
    hit = apart == least
    if np.count_nonzero(hit) > least.size:
        hit &= hit.cumsum(axis=0) == 1
    return hit, np.maximum(least + (points * points).sum(axis=1), 0.0)


def moments(rows: DataFrame, columns: Sequence[str], models: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Per model and centre: count, sums and sum of squared lengths of the rows nearest to it."""
    groups, names = by_size(models), [f"v{i}" for i in range(len(columns) + 2)]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((centres.shape[1], centres.shape[0], len(names))) for _, centres in groups]
        for _, points in slices(batches, columns):
            wide = np.column_stack([np.ones(len(points)), points, (points * points).sum(axis=1)])
            for total, (_, centres) in zip(totals, groups):
                total += (nearest(points, centres)[0].reshape(-1, len(points)).astype(float) @ wide).reshape(total.shape)
        for total, (places, centres) in zip(totals, groups):
            size = centres.shape[1]
            values = total.reshape(size * len(places), len(names))
            keys = [np.tile(np.array(places, dtype=np.int32), size), np.repeat(np.arange(size, dtype=np.int32), len(places))]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*keys, *values.T.copy())], names=["model", "centre", *names])

    parts = rows.select(*columns).mapInArrow(add, ", ".join(["model int", "centre int", *[f"{n} double" for n in names]]))
    found = [np.zeros((len(centres), len(names))) for centres in models]
    for r in parts.groupBy("model", "centre").agg(*[F.sum(n).alias(n) for n in names]).collect():  # a row for each centre
        found[r["model"]][r["centre"]] = r[2:]
    return found


def cost(centres: np.ndarray, found: np.ndarray) -> float:
    """Summed squared distance of the rows to their centres, from the moments."""
    n, sums, squares = found[:, 0], found[:, 1:-1], found[:, -1]
    return float(max((squares - 2.0 * (centres * sums).sum(axis=1) + n * (centres * centres).sum(axis=1)).sum(), 0.0))


def drawn(rows: DataFrame, columns: Sequence[str], row_id: str, models: Sequence[np.ndarray], size: int, seeds: Sequence[int], turn: int) -> list[np.ndarray]:
    """Per start ``size`` rows, drawn by their squared distance to its candidates; without candidates all rows are alike.

    A draw is a hash of the row's id: least -ln(u) / distance. One pass draws, and where a row lies does not matter.
    """
    draws, names, groups = [f"_u{i}" for i in range(len(seeds))], [f"v{i}" for i in range(len(columns))], by_size(models)

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0), np.zeros((0, len(names)))) for _ in draws]
        for part, points in slices(batches, columns):
            share = np.ones((len(draws), len(points)))
            for places, centres in groups:
                apart = nearest(points, centres)[1]
                share[places] = np.where(apart > SAME * (points * points).sum(axis=1), apart, 0.0)
            for start, name in enumerate(draws):
                u = ((part.column(name).to_numpy().view(np.uint64) >> np.uint64(11)) + 0.5) * 2.0**-53
                open_rows = share[start] > 0
                keys = np.concatenate([kept[start][0], -np.log(u[open_rows]) / share[start][open_rows]])
                held = np.concatenate([kept[start][1], points[open_rows]])
                least = np.argsort(keys, kind="stable")[:size]
                kept[start] = keys[least], held[least]
        for start, (keys, held) in enumerate(kept):
            arrays = [pa.array(np.full(len(keys), start, dtype=np.int32)), pa.array(keys), *[pa.array(c) for c in held.T.copy()]]
            yield pa.RecordBatch.from_arrays(arrays, names=["start", "key", *names])

    hashes = [F.xxhash64(F.lit(seed), F.lit(turn), F.col(row_id)).alias(u) for seed, u in zip(seeds, draws)]
    parts = rows.select(*columns, *hashes).mapInArrow(pick, ", ".join(["start int", "key double", *[f"{n} double" for n in names]]))
    order = F.row_number().over(Window.partitionBy("start").orderBy("key", *names))
    found = parts.withColumn("_n", order).where(F.col("_n") <= size).orderBy("start", "_n").collect()  # size rows for each start
    return [np.array([r[2:-1] for r in found if r["start"] == i], dtype=float).reshape(-1, len(names)) for i in range(len(seeds))]


def start_of(points: np.ndarray, weights: np.ndarray, size: int, seed: Sequence[int]) -> np.ndarray:
    """K-means++ and some steps on the weighted candidates, the cheapest of a few tries; fewer centres if fewer points differ."""
    pick = np.random.default_rng(seed)
    apart = lambda centres: ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)

    def attempt() -> np.ndarray:
        centres = points[[pick.choice(len(points), p=weights / weights.sum())]]
        while len(centres) < size and (share := weights * apart(centres).min(axis=1)).sum() > 0:
            centres = np.vstack([centres, points[pick.choice(len(points), p=share / share.sum())]])
        for _ in range(START_STEPS):
            member = (apart(centres).argmin(axis=1)[:, None] == np.arange(len(centres))) * weights[:, None]
            n = member.sum(axis=0)
            moved = np.where(n[:, None] > 0, member.T @ points / np.maximum(n, 1.0)[:, None], centres)
            if np.array_equal(moved, centres):
                break
            centres = moved
        return centres

    return min((attempt() for _ in range(START_TRIES)), key=lambda centres: float((weights * apart(centres).min(axis=1)).sum()))


def starts(rows: DataFrame, columns: Sequence[str], row_id: str, sizes: Sequence[int], seeds: Sequence[int]) -> list[tuple[int, np.ndarray]]:
    """First centres for each size and seed, by k-means||: candidates of a seed are drawn once, enough for the largest size."""
    found = drawn(rows, columns, row_id, [], 1, seeds, 0)
    if not len(found[0]):
        return []
    for turn in range(1, ROUNDS + 1):
        more = drawn(rows, columns, row_id, found, DRAWN * max(sizes), seeds, turn)
        found = [np.unique(np.vstack(pair), axis=0) for pair in zip(found, more)]
    weights = [m[:, 0] for m in moments(rows, columns, found)]
    return [(k, start_of(points, w, k, [seed, k])) for k in sizes for seed, points, w in zip(seeds, found, weights)]


def fit(rows: DataFrame, columns: Sequence[str], row_id: str, sizes: Sequence[int], seed: int, restarts: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per size the centres of the start that ends with the least cost, and the moments of their rows; nothing for no rows."""
    begun = starts(rows, columns, row_id, sizes, [seed + i for i in range(restarts)])
    centres = [c for _, c in begun]
    going = list(range(len(centres)))
    for _ in range(STEPS):
        still = []
        for place, found in zip(going, moments(rows, columns, [centres[i] for i in going])):
            n = found[:, :1]
            moved = np.where(n > 0, found[:, 1:-1] / np.maximum(n, 1.0), centres[place])
            if ((moved - centres[place]) ** 2).sum(axis=1).max() > STILL * STILL:
                still.append(place)
            centres[place] = moved
        if not (going := still):
            break
    best: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}
    for (k, _), c, found in zip(begun, centres, moments(rows, columns, centres) if begun else []):
        if k not in best or cost(c, found) < best[k][0]:
            best[k] = cost(c, found), c, found
    return {k: (c, found) for k, (_, c, found) in best.items()}


def labelled(rows: DataFrame, columns: Sequence[str], row_id: str, centres: np.ndarray) -> DataFrame:
    """(row_id, cluster) with the place of the nearest centre."""

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, points in slices(batches, columns):
            cluster = nearest(points, centres[None])[0][:, 0].argmax(axis=0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(row_id), pa.array(cluster)], names=[row_id, "cluster"])

    return rows.select(row_id, *columns).mapInArrow(label, StructType([rows.schema[row_id], StructField("cluster", IntegerType())]))


def silhouettes(rows: DataFrame, columns: Sequence[str], fits: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[float | None]:
    """Mean silhouette by squared distances of each fit, as Spark's evaluator has it; None if all rows are in one cluster.

    The mean squared distance of a row to a cluster follows from the moments of the cluster, so rows are read once for all fits.
    """
    held = [(centres, found, found[:, 0] > 0) for centres, found in fits]

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(held))
        for _, points in slices(batches, columns):
            squares, here = (points * points).sum(axis=1), np.arange(len(points))
            for place, (centres, found, used) in enumerate(held):
                if used.sum() < 2:
                    continue
                label = nearest(points, centres[None])[0][:, 0].argmax(axis=0)
                n = np.maximum(found[:, 0], 1.0)[:, None]
                apart = np.maximum(squares + found[:, -1:] / n - 2.0 * (found[:, 1:-1] / n) @ points.T, 0.0)
                apart[~used] = np.inf
                size = found[label, 0]
                own = apart[label, here] * size / np.maximum(size - 1, 1.0)
                apart[label, here] = np.inf
                other = apart.min(axis=0)
                most = np.maximum(own, other)
                # a row alone in its cluster counts as 0
                totals[place] += np.divide(other - own, most, out=np.zeros(len(points)), where=(most > 0) & (size > 1)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)), pa.array(totals)], names=["model", "total"])

    parts = rows.select(*columns).mapInArrow(add, "model int, total double")
    totals = {r["model"]: r["total"] for r in parts.groupBy("model").agg(F.sum("total").alias("total")).collect()}  # a row for each fit
    return [float(totals[i] / found[:, 0].sum()) if used.sum() > 1 else None for i, (_, found, used) in enumerate(held)]
