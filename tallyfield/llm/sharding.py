"""Sharding by longest-processing-time scheduling of groups that must stay together.

Groups (equal texts) are taken by falling size and each goes to the shard with the least load.
The order and the loads depend only on how many groups have which size, so the heap runs over
a histogram: sizes are exact below ``2 ** FINE`` and kept to 12 binary digits above, which
bounds it to ``2 ** FINE`` + 4,096 for each doubling whatever the number of groups. Equal
sizes are dealt in bulk, with the result that one-by-one scheduling gives. Documents never
meet in one place: they get their shard from the rank of their group within its size.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import given_id, numbered, own_id, stored

#: Sizes below this power of two are classes of their own.
FINE = 13


def size_class(size: Column) -> Column:
    """The size cut to its 13 leading binary digits."""
    cut = F.greatest(F.length(F.bin(size)) - FINE, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, cut), cut)


def longest_first(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """For (class, groups, bytes) the class with its shards and the ranks up to which each takes.

    Groups of a class weigh the mean of the class. Equal weights go where the n lowest of
    load, load + weight, load + 2 weight ... lie; the last few are dealt from a heap.
    """
    loads = np.zeros(shards)
    plan = []
    for kind, n, total in sorted(classes, reverse=True):
        weight, counts = total / n, np.zeros(shards, np.int64)
        if n > 4 * shards:
            low, high = loads.min(), loads.max() + weight * (n / shards + 2)
            for _ in range(80):
                level = (low + high) / 2
                if np.maximum(np.floor((level - loads) / weight), 0).sum() <= n:
                    low = level
                else:
                    high = level
            counts = np.maximum(np.floor((low - loads) / weight), 0).astype(np.int64)
        heap = [(loads[i] + counts[i] * weight, i) for i in range(shards)]
        heapq.heapify(heap)
        for _ in range(n - int(counts.sum())):
            load, i = heap[0]
            counts[i] += 1
            heapq.heapreplace(heap, (load + weight, i))
        loads += counts * weight
        used = np.flatnonzero(counts)
        plan.append((kind, np.cumsum(counts[used]).tolist(), used.tolist()))
    return plan


def shard(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text", overhead: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, group, shard, slot.

    ``size`` is the UTF-8 length plus ``overhead``; a NULL text has length 0 and belongs to the group
    of empty texts. Equal texts share a shard. A group larger than the mean load fills its shard
    alone; nothing is split. Slots run from 0 without gaps in each shard. Repeated rows are kept
    and get slots of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            own_id(id_column).alias("_id"),
            F.unhex(F.md5(text)).alias("_group"),
            (F.octet_length(text).cast("long") + overhead).alias("size"),
            F.crc32(text).alias("text_crc32"),
        ),
        "shard-rows",
    )
    groups = stored(
        rows.groupBy("_group").agg(F.sum("size").alias("_bytes")).withColumn("_class", size_class(F.col("_bytes"))),
        "shard-groups",
    )
    classes = groups.groupBy("_class").agg(F.count(F.lit(1)), F.sum("_bytes")).collect()
    plan = spark.createDataFrame(longest_first([tuple(c) for c in classes], shards), "_of long, _upto array<long>, _shards array<int>")
    ranked = numbered(groups, "_class", F.xxhash64("_group"), ["_group"], "_rank")
    passed = F.size(F.expr("filter(_upto, u -> u <= _rank)"))
    placed = stored(
        ranked.join(plan, F.col("_class") == F.col("_of")).select("_group", F.col("_shards")[passed].alias("shard")),
        "shard-plan",
    )
    dealt = stored(
        rows.withColumnRenamed("_group", "_own").join(placed, F.col("_own") == F.col("_group")).drop("_own"), "shard-dealt"
    )
    out = numbered(dealt, "shard", F.xxhash64("_id", "_group"), ["_id", "_group"], "slot", ways=512)
    return out.select(given_id().alias("doc_id"), "size", "text_crc32", F.hex("_group").alias("group"), "shard", "slot")
