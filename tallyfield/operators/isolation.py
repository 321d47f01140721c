"""Isolation forest: trees built from small hash samples, scored by a vectorised function."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.ordering import global_percentiles
from tallyfield.session import stored

RANGE = 1 << 30
#: Rows that a task scores; a row passes all trees.
SCORED = 100_000
NODE = "tree int, node int, feature int, split double, left int, right int, size int"


def path_constant(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def walkable(tree: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Feature, split, children (right, left) and path length of each node, and the levels of the tree.

    A leaf is its own child, so all rows take the same number of steps. Parents stand before their children.
    """
    leaf, here = tree["feature"] < 0, np.arange(len(tree["feature"]))
    level = np.zeros(len(here), dtype=np.int64)
    for node in here[~leaf]:
        level[[tree["left"][node], tree["right"][node]]] = level[node] + 1
    child = np.column_stack([np.where(leaf, here, tree["right"]), np.where(leaf, here, tree["left"])]).astype(np.int64).ravel()
    return np.where(leaf, 0, tree["feature"]).astype(np.int64), tree["split"].astype(float), child, level + tree["rest"], int(level.max())


@dataclass
class IsolationForest:
    """Fitted trees (at most trees * 511 nodes) and the decision offset."""

    columns: list[str]
    trees: list[dict[str, np.ndarray]]
    sample: int
    offset: float = 0.0

    def raw_score(self) -> Column:
        """-2^(-mean path / constant): near -1 for odd rows, near -0.5 for usual ones."""
        trees, constant = [walkable(tree) for tree in self.trees], path_constant(self.sample)

        @F.pandas_udf("double")
        def score(rows: pd.DataFrame) -> pd.Series:
            points = rows.to_numpy(dtype=float)
            flat, first = points.ravel(), np.arange(len(points)) * points.shape[1]
            depth = np.zeros(len(points))
            for feature, split, child, length, levels in trees:
                at = np.zeros(len(points), dtype=np.int64)
                for _ in range(levels):
                    goes_left = flat.take(first + feature.take(at)) < split.take(at)
                    at = child.take(2 * at + goes_left)
                depth += length.take(at)
            return pd.Series(-np.power(2.0, -depth / max(len(trees), 1) / constant))

        return score(F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.columns]))

    def decision(self) -> Column:
        """Raw score minus the offset: negative rows are the contaminated share."""
        return self.raw_score() - F.lit(self.offset)


def fit_isolation_forest(df: DataFrame, columns: Sequence[str], row_id: str, trees: int = 100, sample: int = 256,
                         contamination: float = 0.1, seed: int = 42) -> IsolationForest:
    """Trees and the offset below which the ``contamination`` share of the rows scores; see ``anomaly_scores``."""
    return anomaly_scores(df, columns, row_id, (), trees, sample, contamination, seed)[0]


def anomaly_scores(df: DataFrame, columns: Sequence[str], row_id: str, keep: Sequence[str], trees: int = 100, sample: int = 256,
                   contamination: float = 0.1, seed: int = 42) -> tuple[IsolationForest, DataFrame]:
    """The fitted forest, and (row_id, keep, anomaly_score) of the rows that it was fitted on.

    The offset needs the score of every row. They are written, so that the rows pass the trees once, dealt evenly:
    the pieces of a file may be few.
    """
    rows = df.count()
    model = grow_trees(df, columns, row_id, rows, trees, sample, seed)
    pieces = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SCORED))
    even = df.select(*dict.fromkeys([row_id, *keep, *columns])).repartition(pieces, row_id)
    scored = stored(even.select(row_id, *keep, model.raw_score().alias("_raw")), "anomaly-scores")
    model.offset = global_percentiles(scored, {"raw": F.col("_raw")}, [contamination], row_id)["raw"][0]
    return model, scored.select(row_id, *keep, (F.col("_raw") - F.lit(model.offset)).alias("anomaly_score"))


def grow_trees(df: DataFrame, columns: Sequence[str], row_id: str, rows: int, trees: int, sample: int, seed: int) -> IsolationForest:
    """Trees from samples drawn by row hash.

    A row enters a tree if its hash for that tree is below one and a half times the sample's
    share of the rows; of these the ``sample`` least hashes stay. The rule is the same at every size, every row can be
    drawn for every tree, and each tree is one group of about 1.5 ``sample`` rows.
    """
    columns = list(columns)
    draw = min(1.0, sample * 1.5 / max(rows, 1))
    narrow = df.select(row_id, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    order = lambda t: F.pmod(F.xxhash64(F.lit(seed + 1), F.col(row_id), t), F.lit(RANGE))
    # a row for each tree, dropped at once: compiled code, which a filter of an array is not
    each = narrow.select(row_id, *columns, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = each.withColumn("_order", order(F.col("tree"))).where(F.col("_order") < int(draw * RANGE))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_order", row_id]).head(sample)
        tree = int(frame["tree"].iloc[0])
        points = frame[columns].to_numpy()
        rng = np.random.default_rng([seed, tree])
        limit = int(np.ceil(np.log2(max(sample, 2))))
        nodes: list[list] = []
        pending = [(np.arange(len(points)), 0, -1, 0)]
        while pending:
            members, level, parent, side = pending.pop()
            here = len(nodes)
            if parent >= 0:
                nodes[parent][side] = here
            held = points[members]
            spread = np.ptp(held, axis=0) if len(members) else np.zeros(points.shape[1])
            open_columns = np.where(spread > 0)[0]
            if level >= limit or not len(open_columns):
                nodes.append([tree, here, -1, 0.0, -1, -1, len(members)])
                continue
            feature = int(rng.choice(open_columns))
            split = float(rng.uniform(held[:, feature].min(), held[:, feature].max()))
            left = held[:, feature] < split
            nodes.append([tree, here, feature, split, -1, -1, len(members)])
            pending.append((members[left], level + 1, here, 4))
            pending.append((members[~left], level + 1, here, 5))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "left", "right", "size"])

    found = drawn.groupBy("tree").applyInPandas(build, NODE).toPandas()  # at most trees * 511 rows
    forest = []
    for _, nodes in found.sort_values(["tree", "node"]).groupby("tree"):
        forest.append(
            {
                "feature": nodes["feature"].to_numpy(),
                "split": nodes["split"].to_numpy(),
                "left": nodes["left"].to_numpy(),
                "right": nodes["right"].to_numpy(),
                "rest": np.array([path_constant(n) for n in nodes["size"]]),
            }
        )
    return IsolationForest(columns, forest, min(sample, rows))
