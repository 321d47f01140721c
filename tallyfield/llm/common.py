"""Helpers of the corpus operators: columns, stored intermediates, exact ranks, word hashes.

Every operator reads its columns by name, so extra columns, also with clashing names, do no
harm: inside, only ``_``-prefixed names are used. A NULL text counts as empty and a NULL
doc_id as larger than any other. Rows that repeat a doc_id *and* a text are one document
whose result is returned for each of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfield.session import work_folder

LAST_ID = 2**63 - 1


def own_id(column: str = "doc_id") -> Column:
    """The document id as a long, with NULL after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(_id, _tx, _text): the id, a hash of the text and the text with NULL as empty."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(own_id(id_column).alias("_id"), F.xxhash64(text).alias("_tx"), text.alias("_text"))


def given_id() -> Column:
    """The id as it came: NULL again where ``own_id`` stood for NULL."""
    return F.when(F.col("_id") != LAST_ID, F.col("_id"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the folder that all executors share and read it from there.

    Later reads see the same rows in the same form when an executor is lost, and joins
    see the true size of the table.
    """
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def lean(spark: SparkSession) -> SparkSession:
    """Arrow batches of a few megabytes: with texts, the default of 10,000 rows takes tens in each task twice."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def pieces(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, key: str, spread: Column, order: Sequence[str], out: str, ways: int = 64) -> DataFrame:
    """Add the gapless row number from 0 within ``key``, without a task that holds a whole key.

    Rows of a key are split ``ways`` ways by the hash ``spread``, numbered inside each part and
    moved up by the counts of the parts before. Rows that agree in ``order`` must be equal in
    all columns. ``df`` is read twice and must be stored.
    """
    split = df.withColumn("_part", F.pmod(spread, F.lit(ways)).cast("int"))
    before = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_at"))
        .agg(F.count(F.lit(1)).alias("_held"))
        .withColumn("_before", F.coalesce(F.sum("_held").over(before), F.lit(0)))
    )
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order))
    return (
        split.withColumn(out, inside.cast("long"))
        .join(offsets, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_at")))
        .withColumn(out, F.col(out) + F.col("_before") - 1)
        .select(*df.columns, out)
    )


# ---- Arrow batches -------------------------------------------------------------------------


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has about ``most_bytes`` bytes in each; rows stay whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = raw(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, ends[at] + most_bytes, side="right")) - 1
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto
        pa.default_memory_pool().release_unused()  # a worker lives through many stages


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; NULL is empty."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def table_of(names: Sequence[str], arrays: Sequence, kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, type=k) for a, k in zip(arrays, kinds)], names=list(names))


# ---- words and their hashes ----------------------------------------------------------------

#: Bytes of words that end at white space: all but space and \t \n \v \f \r.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: all bits of the result depend on all bits of ``x``."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: The prime of all sums, and two bases drawn once. A sum modulo a power of two would not do: texts that differ
#: in a pattern of doubled and negated halves collide there whatever the base.
PRIME = 2**61 - 1
BASES = [int(x) for x in np.random.default_rng(61).integers(2**40, PRIME - 1, 2)]
_P, _LOW30, _LOW31 = np.uint64(PRIME), np.uint64(2**30 - 1), np.uint64(2**31 - 1)
_U30, _U31, _U61, _U1 = (np.uint64(x) for x in (30, 31, 61, 1))


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME."""
    x = (x & _P) + (x >> _U61)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """The product of numbers below PRIME modulo PRIME, by halves of 31 bits."""
    a1, a0, b1, b0 = a >> _U31, a & _LOW31, b >> _U31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return reduced((a1 * b1 << _U1) + (middle >> _U30) + ((middle & _LOW30) << _U31) + a0 * b0)


_POWERS: dict[int, list[np.ndarray]] = {}


def _powers(n: int, which: int) -> list[np.ndarray]:
    """The powers of a base and of its inverse; one table serves all lengths and grows when it must."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        tables = []
        for base in (BASES[which], pow(BASES[which], -1, PRIME)):
            table = np.ones(1, np.uint64)
            while len(table) < max(n, 1 << 16):
                table = np.concatenate([table, times(table, np.uint64(pow(base, len(table), PRIME)))])
            tables.append(table)
        _POWERS[which] = tables
    return _POWERS[which]


class Sequences:
    """Hashes of any stretch of a sequence of 64-bit values, each in constant time.

    The stretch is a polynomial modulo a prime at a fixed random base; ``which`` chooses one of two bases, whose
    hashes are independent of each other.
    """

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = _powers(len(values) + 2, which)
        terms = times(reduced(values), up[: len(values)])
        low, high = np.cumsum(terms & _LOW30), np.cumsum(terms >> _U30)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        self.sums[1:] = reduced(times(reduced(high), np.uint64(1 << 30)) + low)

    def _moved(self, start: np.ndarray, end: np.ndarray, down: np.ndarray) -> np.ndarray:
        return times(reduced(self.sums[end] + (_P - self.sums[start])), self.down[down])

    def plain(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The polynomial of the values from ``start`` to ``end``, free of their place."""
        return self._moved(start, end, start)

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mixed(self.plain(start, end) + (end - start).astype(np.uint64), salt)

    def without(self, start: np.ndarray, gap: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """As ``of`` the stretch would be if the value at ``gap`` were left out."""
        rest = reduced(self.plain(start, gap) + self._moved(gap + 1, end, start + 1))
        return mixed(rest + (end - start - 1).astype(np.uint64), salt)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each stretch of bytes a sum of hashes of byte and place: nothing that repeats in it cancels out."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    begins = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begins, size)
    each = mixed(_BYTES[data[np.repeat(starts, size) + place]] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mixed(np.add.reduceat(each, begins) + size.astype(np.uint64))


class Words:
    """The words of a slice of texts: byte ``starts`` and ``ends``, ``row`` and word hash of each.

    ``first[i]`` is the place of the first word of row i; ``first[n]`` the number of words.
    """

    def __init__(self, texts: pa.Array, kind: np.ndarray = SPACED, lower: bool = False):
        self.data, self.offsets = raw(texts)
        n = len(self.data)
        inside = kind[self.data]
        after, before = np.zeros(n, bool), np.zeros(n, bool)
        after[1:], before[:-1] = inside[:-1], inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        after[edges], before[edges - 1] = False, False
        self.starts = np.flatnonzero(inside & ~after)
        self.ends = np.flatnonzero(inside & ~before) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.first))
        data = LOWER[self.data] if lower else self.data
        self.hashes = byte_hashes(data, self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_PLACE = np.uint64((1 << 26) - 1)


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of its least one, leftmost among equals.

    Windows are compared by the upper 38 bits of the hashes, so equal windows choose the same place.
    """
    if len(hashes) < width or not len(hashes):
        return np.zeros(0, np.int64)
    if len(hashes) > int(_PLACE):
        raise ValueError("a text of more than 67 million words")
    low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    n = len(hashes) - width + 1
    return (np.minimum(low[:n], low[width - span : width - span + n]) & _PLACE).astype(np.int64)


def windows_in_rows(words: Words, length: int) -> np.ndarray:
    """Places of the words at which a stretch of ``length`` words of one text begins."""
    start = np.arange(len(words))
    return start[start + length <= words.first[words.row + 1]]
