"""Proportional hazards: Newton steps on the partial likelihood, concordance and calibration.

Every step is one aggregate: rows shrink to sums for each distinct time, the sums of those still at risk run backwards over
the times, and a vector and a matrix as wide as the covariates come to the driver. Times are whole days, so the
ordered windows run over few rows whatever the input. Concordant pairs are counted without forming pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.operators.forecasting import solve
from tallyfield.operators.survival import Z95
from tallyfield.session import stored

#: Deaths at one time that a row of the tie correction stands for at most, before it is spread.
TIES = 10_000
#: (risk, time) cells that a range piece is to hold.
PIECE_CELLS = 500_000


@dataclass
class Hazards:
    """Weights per unit of each covariate, their covariance, and the means that risks are taken from."""

    columns: list[str]
    weights: np.ndarray
    covariance: np.ndarray
    means: np.ndarray
    log_likelihood: float
    steps: int

    def risk(self) -> Column:
        """The linear predictor; a missing covariate counts as its mean."""
        parts = [(F.coalesce(F.col(c).cast("double"), F.lit(float(m))) - float(m)) * float(w) for c, m, w in zip(self.columns, self.means, self.weights)]
        return reduce(add, parts)

    def table(self, df: DataFrame) -> DataFrame:
        """One row per covariate: coefficient, hazard ratio, standard error, z and a 95 % interval of the ratio."""
        rows = []
        for i, c in enumerate(self.columns):
            b, e = float(self.weights[i]), float(np.sqrt(self.covariance[i, i]))
            rows.append((c, b, float(np.exp(b)), e, b / e if e else None, float(np.exp(b - Z95 * e)), float(np.exp(b + Z95 * e))))
        return df.sparkSession.createDataFrame(
            rows, "covariate string, coefficient double, hazard_ratio double, std_error double, z double, lower double, upper double"
        )


def _step(rows: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log partial likelihood, its gradient and the information at ``weights``; ties by Efron's rule."""
    k = len(weights)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    e = F.exp(reduce(add, [F.col(f"x{i}") * float(weights[i]) for i in range(k)]))
    terms = {"s": e, **{f"s{i}": e * F.col(f"x{i}") for i in range(k)}, **{f"s{i}_{j}": e * F.col(f"x{i}") * F.col(f"x{j}") for i, j in pairs}}
    dead = F.col("event") == 1
    sums = [F.sum(v).alias(c) for c, v in terms.items()] + [F.sum(F.when(dead, v)).alias(f"d{c}") for c, v in terms.items()]
    own = [F.sum(F.when(dead, F.col(f"x{i}"))).alias(f"own{i}") for i in range(k)]
    times = rows.groupBy("time").agg(*sums, *own, F.count_if(dead).alias("deaths"))
    onward = Window.orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    at_risk = times.select("deaths", *[f"own{i}" for i in range(k)], *[f"d{c}" for c in terms], *[F.sum(c).over(onward).alias(c) for c in terms])
    # a row for each death of a time: the l-th of d counts the dying by 1 - l / d
    spread = at_risk.where("deaths > 0").withColumn("_lot", F.explode(F.expr(f"sequence(0L, (deaths - 1) div {TIES})")))
    each = spread.withColumn("_l", F.explode(F.expr(f"sequence(_lot * {TIES}, least(deaths, (_lot + 1) * {TIES}) - 1)")))
    left = {c: F.col(c) - F.col("_l") / F.col("deaths") * F.col(f"d{c}") for c in terms}
    first = F.col("_l") == 0
    parts = each.select(*[v.alias(c) for c, v in left.items()], *[F.when(first, F.col(f"own{i}")).otherwise(0.0).alias(f"own{i}") for i in range(k)])
    found = parts.agg(
        F.sum(reduce(add, [F.col(f"own{i}") * float(weights[i]) for i in range(k)]) - F.log("s")).alias("value"),
        *[F.sum(F.col(f"own{i}") - F.col(f"s{i}") / F.col("s")).alias(f"g{i}") for i in range(k)],
        *[F.sum(F.col(f"s{i}_{j}") / F.col("s") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("s") * F.col("s"))).alias(f"h{i}_{j}") for i, j in pairs],
    ).first()
    gradient, information = np.array([found[f"g{i}"] or 0.0 for i in range(k)]), np.zeros((k, k))
    for i, j in pairs:
        information[i, j] = information[j, i] = found[f"h{i}_{j}"] or 0.0
    return found["value"] or 0.0, gradient, information


def fit_hazards(df: DataFrame, time: str, event: str, columns: Sequence[str], steps: int = 30) -> Hazards:
    """Proportional hazards of ``columns`` by Newton's method on the partial likelihood.

    Rows without a time are left out; a missing covariate counts as its mean. Covariates are
    standardised inside. A step that lowers the likelihood is halved. A covariate that never changes has weight 0.
    """
    known = df.where(F.col(time).isNotNull())
    spread = known.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    means = np.array([spread[f"m{i}"] or 0.0 for i in range(len(columns))])
    scale = np.array([spread[f"d{i}"] or 1.0 for i in range(len(columns))])
    rows = known.select(
        F.col(time).alias("time"),
        F.coalesce(F.col(event).cast("int"), F.lit(0)).alias("event"),
        *[((F.coalesce(F.col(c).cast("double"), F.lit(float(means[i]))) - float(means[i])) / float(scale[i])).alias(f"x{i}") for i, c in enumerate(columns)],
    )
    rows = stored(rows, "hazard-rows")
    weights = np.zeros(len(columns))
    value, gradient, information = _step(rows, weights)
    done = 0
    for done in range(1, steps + 1):
        move = solve(information[None], gradient[None])[0][0]
        for _ in range(12):
            tried = _step(rows, weights + move)
            if tried[0] >= value - 1e-9 * abs(value):
                break
            move = move / 2
        weights, (value, gradient, information) = weights + move, tried
        if np.abs(move).max() < 1e-9:
            break
    inverse = np.linalg.pinv(information, hermitian=True)
    return Hazards(list(columns), weights / scale, inverse / np.outer(scale, scale), means, value, done)


def dominated(rank: np.ndarray, time: np.ndarray, many: np.ndarray, dead: np.ndarray) -> tuple[int, int]:
    """Over the deaths of cells: members of lower rank and later time, and of equal rank and later time.

    Two ranks part at their highest differing bit, so one pass for each bit counts every pair once; a pass merges
    the lower half of each block, in order of time, with the deaths of the upper half.
    """
    wide = int(time.max(initial=0)) + 1

    def later(block: np.ndarray, below: np.ndarray, above: np.ndarray) -> int:
        key = block[below] * wide + time[below]
        order = np.argsort(key, kind="stable")
        line, held = key[order], np.r_[0, np.cumsum(many[below][order])]
        upto = np.searchsorted(line, block[above] * wide + time[above], "right")
        end = np.searchsorted(line, (block[above] + 1) * wide, "left")
        return int(((held[end] - held[upto]) * dead[above]).sum())

    ends = np.flatnonzero(dead)
    lower = 0
    for bit in range(int(rank.max(initial=0)).bit_length()):
        upper = (rank >> bit) & 1 == 1
        lower += later(rank >> (bit + 1), np.flatnonzero(~upper), ends[upper[ends]])
    return lower, later(rank, np.arange(len(rank)), ends)


def concordance(df: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """One row: comparable pairs, concordant and tied ones, and the C-index.

    A pair is comparable if one dies and the other's time is later; it is concordant if the one that dies had the
    higher risk, and counts half if the risks are equal. Rows shrink to (risk, time) cells, which are dealt to
    range pieces by risk. Inside a piece pairs are counted by merging; across pieces, running sums over the
    grid of pieces and times suffice. Rows without a time or risk are left out.
    """
    known = df.where(F.col(time).isNotNull() & F.col(risk).isNotNull())
    cells = stored(
        known.groupBy(F.col(risk).cast("double").alias("risk"), F.col(time).cast("long").alias("time")).agg(F.count(F.lit(1)).alias("many"), F.sum(F.coalesce(F.col(event).cast("long"), F.lit(0))).alias("dead")),
        "concordance-cells",
    )
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells.count() // PIECE_CELLS))
    pieces = stored(cells.repartitionByRange(n, "risk").withColumn("piece", F.spark_partition_id()), "concordance-pieces")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if len(batch)]
        if held:
            piece, value, when, many, dead = (np.concatenate(c) for c in zip(*held))
            for p in np.unique(piece):
                at = piece == p
                rank, order = (np.unique(x[at], return_inverse=True)[1] for x in (value, when))
                lower, tied = dominated(rank, order, many[at], dead[at])
                yield pa.RecordBatch.from_arrays([pa.array([lower], pa.int64()), pa.array([tied], pa.int64())], names=["lower", "tied"])

    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    own = (
        pieces.select("piece", "risk", "time", "many", "dead")
        .repartition(n, "piece")
        .mapInArrow(inside, "lower long, tied long")
        .agg(F.coalesce(wide(F.col("lower")), F.lit(0)).alias("lower"), F.coalesce(wide(F.col("tied")), F.lit(0)).alias("tied"))
    )
    sums = pieces.groupBy("piece", "time").agg(F.sum("many").alias("many"), F.sum("dead").alias("dead"))
    grid = (
        sums.groupBy("time").agg(F.lit(n).alias("n")).select("time", F.explode(F.expr("sequence(0, n - 1)")).alias("piece"))
        .join(sums, ["piece", "time"], "left")
        .withColumn("below", F.sum("many").over(Window.partitionBy("time").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)))
    )
    later = Window.partitionBy("piece").orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, -1)
    across = grid.withColumn("after", F.sum("below").over(later)).where("dead > 0").agg(F.coalesce(wide(F.col("dead") * F.col("after")), F.lit(0)).alias("across"))
    onward = Window.orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, -1)
    times = sums.groupBy("time").agg(F.sum("many").alias("many"), F.sum("dead").alias("dead")).withColumn("after", F.sum("many").over(onward))
    pairs = times.agg(F.coalesce(wide(F.col("dead") * F.col("after")), F.lit(0)).alias("pairs"))
    concordant = F.col("lower") + across.select("across").scalar()
    total = pairs.select("pairs").scalar()
    return own.select(total.cast("long").alias("pairs"), concordant.cast("long").alias("concordant"), F.col("tied").cast("long").alias("tied")).withColumn(
        "c_index", F.try_divide(F.col("concordant") + 0.5 * F.col("tied"), F.col("pairs").cast("double"))
    )


def calibration_slope(held: DataFrame, time: str, event: str, model: Hazards) -> float:
    """The weight of the model's own risk on rows it has not seen: 1 if risks are neither too far apart nor too close."""
    return float(fit_hazards(held.withColumn("_risk", model.risk()), time, event, ["_risk"]).weights[0])
