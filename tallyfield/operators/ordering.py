"""Exact global and per-key order statistics without a one-task sort.

A window without a partition, or one partitioned by a key that holds a third of the
rows, sorts all those rows in one task. Here rows are range-partitioned on
``(keys, order)``, so a hot key or a heavily tied value is spread over many tasks by the
later order columns; each piece is sorted locally and the placement is written once.
Ranks follow from the per-piece counts, which are a handful of rows per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.buckets import last_rank_of_bin
from tallyfield.session import durable

PIECE, SPOT = "_piece", "_spot"


def place(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows sorted by (keys, order) over range pieces, with piece and position columns.

    The position is increasing and gap-free inside a piece. End ``order`` in a unique
    column: ties then have one fixed order, and a hot value can be split.
    """
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return durable(
        df.repartitionByRange(pieces, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(PIECE, F.spark_partition_id())
        .withColumn(SPOT, F.monotonically_increasing_id())
    )


def _runs(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First position and row count of each (key, piece)."""
    return placed.groupBy(*keys, PIECE).agg(
        F.min(SPOT).alias("_first"), F.count(F.lit(1)).alias("_held")
    )


def exact_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = (),
    rank: str = "rank",
    size: str = "group_size",
) -> DataFrame:
    """Add the row number within ``keys`` and the group size."""
    placed = place(df, keys, order)
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _runs(placed, keys).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(PIECE).alias("_at"),
        "_first",
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_held").over(Window.partitionBy(*keys)).alias(size),
    )
    match = F.col(PIECE) == F.col("_at")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    if not keys:
        offsets = F.broadcast(offsets)  # one row per piece: at most shuffle.partitions rows
    return placed.join(offsets, match).select(
        *df.columns, (F.col("_before") + F.col(SPOT) - F.col("_first") + 1).alias(rank), size
    )


def _long(df: DataFrame, measures: Mapping[str, Column], tie: str) -> DataFrame:
    """One (name, value, tie) row per measure, without NULL values."""
    cells = [F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in measures.items()]
    return (
        df.select(F.col(tie).alias("tie"), F.explode(F.array(*cells)).alias("cell"))
        .select("cell.name", "cell.value", "tie")
        .where(F.col("value").isNotNull())
    )


def rows_at_ranks(df: DataFrame, measures: Mapping[str, Column], tie: str, ranks_of) -> dict:
    """For each measure its row count and the (value, tie) at ranks ``ranks_of(count)``.

    One range sort serves all measures. The driver sees one count per (measure, piece)
    and the few requested rows.
    """
    placed = place(_long(df, measures, tie), ["name"], ["value", "tie"])
    runs: dict[str, list] = {name: [] for name in measures}
    for row in _runs(placed, ["name"]).collect():
        runs[row["name"]].append(row)
    wanted: dict[str, list[int]] = {}
    sizes = {name: sum(row["_held"] for row in found) for name, found in runs.items()}
    for name, found in runs.items():
        found.sort(key=lambda row: row[PIECE])
        spots = []
        for rank in ranks_of(sizes[name]) if found else []:
            left = rank - 1
            for row in found:
                if left < row["_held"]:
                    spots.append(row["_first"] + left)
                    break
                left -= row["_held"]
        wanted[name] = spots
    all_spots = sorted({s for spots in wanted.values() for s in spots})
    at = {}
    if all_spots:
        at = {row[SPOT]: (row["value"], row["tie"]) for row in placed.where(F.col(SPOT).isin(all_spots)).collect()}
    return {name: (sizes[name], [at[s] for s in spots]) for name, spots in wanted.items()}


def quantile_scores(
    df: DataFrame, measures: Mapping[str, tuple[Column, bool]], tie: str, bins: int = 5
) -> DataFrame:
    """Score each measure 1..bins by its exact rank; ``True`` reverses the labels.

    Only the last row of each bin is looked up; rows are then scored by comparing with
    those few literals, so the frame itself is not shuffled. NULL stays NULL.
    """

    def bin_ends(size: int) -> list[int]:
        return [last_rank_of_bin(size, index, bins) for index in range(1, bins)]

    cuts = rows_at_ranks(df, {name: column for name, (column, _) in measures.items()}, tie, bin_ends)
    out = {}
    for name, (column, reverse) in measures.items():
        value = column.cast("double")
        score = F.lit(1)
        for cut_value, cut_tie in cuts[name][1]:
            beyond = (value > F.lit(cut_value)) | ((value == F.lit(cut_value)) & (F.col(tie) > F.lit(cut_tie)))
            score = score + beyond.cast("int")
        out[name] = (F.lit(bins + 1) - score if reverse else score).cast("int")
    return df.withColumns(out)


def global_percentiles(
    df: DataFrame, measures: Mapping[str, Column], probabilities: Sequence[float], tie: str
) -> dict[str, list[float]]:
    """Exact linearly interpolated percentiles of whole columns, as driver-side numbers.

    ``percentile`` keeps every distinct value of the column in one buffer; this does not.
    """
    def brackets(size: int) -> list[int]:
        lows = [int(p * (size - 1)) for p in probabilities]
        return [rank for low in lows for rank in (low + 1, min(low + 2, size))]

    out = {}
    for name, (size, rows) in rows_at_ranks(df, measures, tie, brackets).items():
        values = [value for value, _ in rows]
        numbers = []
        for p, low, high in zip(probabilities, values[::2], values[1::2]):
            part = p * (size - 1)
            numbers.append(low + (high - low) * (part - int(part)))
        out[name] = numbers or [None] * len(probabilities)
    return out


def grouped_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, named: Mapping[str, float], tie: str
) -> DataFrame:
    """Exact interpolated percentiles per key, safe when one key holds most of the rows."""
    narrow = df.select(*keys, F.col(value).cast("double").alias(value), F.col(tie).alias("_tie"))
    ranked = exact_rank(narrow.where(F.col(value).isNotNull()), [value, "_tie"], keys, "_rank", "_size")
    aggregates = []
    for name, p in named.items():
        part = F.lit(p) * (F.col("_size") - 1)
        low = F.floor(part)
        aggregates += [
            F.max(F.when(F.col("_rank") == low + 1, F.col(value))).alias(f"_low_{name}"),
            F.max(F.when(F.col("_rank") == F.least(low + 2, F.col("_size")), F.col(value))).alias(f"_high_{name}"),
            F.max(part - low).alias(f"_part_{name}"),
        ]
    return ranked.groupBy(*keys).agg(*aggregates).select(
        *keys,
        *[
            (F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in named
        ],
    )


def running_sums(
    df: DataFrame, order: Sequence[Column | str], sums: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Add running totals in ``order`` within ``keys`` over range pieces.

    ``all_<name>`` is the total of the key; it comes with the offsets at no further cost.
    """
    placed = place(df, keys, order)
    totals = placed.groupBy(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col(PIECE).alias("_at")
    ).agg(*[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()])
    key_names = [f"_key_{k}" for k in keys]
    earlier = Window.partitionBy(*key_names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *key_names,
        "_at",
        *[F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(f"_total_{n}").over(Window.partitionBy(*key_names)).alias(f"all_{n}") for n in sums],
    )
    local = Window.partitionBy(*keys, PIECE).orderBy(SPOT).rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.select("*", *[F.sum(c).over(local).alias(f"_in_{n}") for n, c in sums.items()])
    match = F.col(PIECE) == F.col("_at")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    if not keys:
        offsets = F.broadcast(offsets)  # one row per piece: at most shuffle.partitions rows
    return inside.join(offsets, match).select(
        *df.columns, *[(F.col(f"_off_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums], *[f"all_{n}" for n in sums]
    )
