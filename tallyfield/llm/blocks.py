"""A query set against all rows, in blocks: both sides are packed and meet by (query block, lot).

Rows are dealt to lots by a hash, queries to blocks of bounded size. Each row block goes to every query
block and each query block to every lot, so no task holds more than one block of each side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import pieces


def lots(spark: SparkSession) -> int:
    """Lots that the rows are dealt to: two for each core that the session has."""
    return max(2 * spark.sparkContext.defaultParallelism, 2)


def blocks_of(df: DataFrame, most: int) -> int:
    """How many blocks of about ``most`` rows the rows of ``df`` make; one number comes to the driver."""
    return max(-(-df.count() // most), 1)


def dealt(spread: Column, ways: int) -> Column:
    return F.pmod(spread, F.lit(ways)).cast("int")


def meeting(rows: DataFrame, queries: DataFrame, n_lots: int, n_blocks: int) -> DataFrame:
    """``rows`` (with _lot) and ``queries`` (with _block) joined so that every pair of blocks meets once."""
    n = max(pieces(rows.sparkSession), n_lots)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = rows.withColumn("_block", every(n_blocks)).repartition(n, "_block", "_lot")
    right = queries.withColumn("_lot", every(n_lots)).repartition(n, "_block", "_lot")
    return left.join(right, ["_block", "_lot"])


#: Bytes of packed queries up to which every task gets them all.
SMALL = 32 << 20


def meeting_in_place(rows: DataFrame, queries: DataFrame, n_lots: int, n_blocks: int, packed: list[str]) -> DataFrame:
    """As ``meeting``, but large ``rows`` stay where they are if the ``packed`` columns of stored ``queries`` have at most ``SMALL`` bytes."""
    held = queries.agg(F.sum(sum((F.octet_length(c) for c in packed), F.lit(0)))).first()[0] or 0
    if held > SMALL:
        return meeting(rows, queries, n_lots, n_blocks)
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    return rows.withColumn("_block", every).join(F.broadcast(queries), "_block")


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A list column of numbers as rows of doubles; shorter lists are padded with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def finite(vector: Column) -> Column:
    """No component is NULL, NaN or infinite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group, by descending score and ascending id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[place < k]
