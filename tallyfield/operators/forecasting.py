"""Monthly series: gap filling, lag regressions of many keys at once, seasonal baseline."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.session import durable

YEAR, MOST_LAGS, Z95 = 12, 3, 1.959964
TERMS = ["1", "trend", *[f"lag{i}" for i in range(1, MOST_LAGS + 1)], "lag12"]
#: (lags, with the month a year before), in the order in which ties are settled.
CANDIDATES = [(lags, seasonal) for seasonal in (False, True) for lags in range(MOST_LAGS + 1)]


def gap_filled(monthly: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """One row per key and month between its first and last month; gaps are 0.

    The monthly totals are read twice, so they are written once.
    """
    monthly = durable(monthly)
    spans = monthly.groupBy(*keys).agg(F.min(month).alias("_lo"), F.max(month).alias("_hi"))
    months = spans.select(
        *keys, F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias(month)
    )
    return months.join(monthly, [*keys, month], "left").withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


class Series:
    """Many monthly series as rows that end in the last column, standardised, with room for ``horizon`` months more.

    ``n`` is the number of months of each. Months in front of a series are 0 and never enter a sum.
    """

    def __init__(self, months: pa.Array, values: pa.Array, horizon: int = 0):
        offsets, at = months.offsets.to_numpy(), months.flatten().to_numpy().astype(np.int64)
        value = values.flatten().to_numpy(zero_copy_only=False).astype(float)
        row = np.repeat(np.arange(len(months)), np.diff(offsets))
        first = np.full(len(months), np.iinfo(np.int64).max)
        last = np.full(len(months), np.iinfo(np.int64).min)
        np.minimum.at(first, row, at)
        np.maximum.at(last, row, at)
        self.n, self.last = last - first + 1, last
        self.width = max(int(self.n.max(initial=0)), YEAR + 1)
        self.y = np.zeros((len(months), self.width + horizon))
        np.add.at(self.y, (row, self.width - 1 - (last[row] - at)), value)
        self.inside = np.arange(self.width) >= (self.width - self.n)[:, None]
        held = self.y[:, : self.width]
        self.mean = held.sum(axis=1) / self.n
        self.deviation = np.sqrt((np.where(self.inside, held - self.mean[:, None], 0.0) ** 2).sum(axis=1) / self.n)
        self.scale = np.where(self.deviation > 0, self.deviation, 1.0)
        self.y[:, : self.width] = np.where(self.inside, (held - self.mean[:, None]) / self.scale[:, None], 0.0)

    def terms(self, column: int) -> np.ndarray:
        """The TERMS of one month of all series, 0 where a month before the first column is asked for."""
        step = (column - (self.width - self.n)) / self.n
        back = [self.y[:, column - i] if column >= i else np.zeros(len(self.n)) for i in (*range(1, MOST_LAGS + 1), YEAR)]
        return np.column_stack([np.ones(len(self.n)), step, *back])

    def design(self) -> np.ndarray:
        """(series, month, term) over all months."""
        return np.stack([self.terms(column) for column in range(self.width)], axis=1)


def solve(gram: np.ndarray, moment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares weights of many systems at once, least in norm where one is singular, and which are not."""
    value, vector = np.linalg.eigh(gram)
    sound = value > 1e-12 * value[:, -1:]
    inverse = np.where(sound, 1.0 / np.where(sound, value, 1.0), 0.0)
    turned = np.einsum("bij,bi->bj", vector, moment)
    return np.einsum("bij,bj->bi", vector, inverse * turned), sound.all(axis=1)


def fitted(series: Series, seasonal_from: int = 36) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chosen candidate (-1: none), its weights over TERMS, its variance and corrected AIC, for every series.

    Candidates regress on a trend, up to MOST_LAGS lags and, from ``seasonal_from`` months on, the value of
    the same month a year before. All candidates of a series are fitted on the same months, so one matrix of
    products holds all of their systems and their corrected AIC can be compared; the smallest wins, the first of equals.
    """
    n, size = series.n, len(series.n)
    yearly = n >= seasonal_from
    start = np.where(yearly, YEAR, np.minimum(MOST_LAGS, np.maximum(n - 6, 0)))
    used = np.arange(series.width) >= (series.width - n + start)[:, None]
    design = np.where(used[:, :, None], series.design(), 0.0)
    target = np.where(used, series.y[:, : series.width], 0.0)
    gram, moment = np.einsum("btk,btl->bkl", design, design), np.einsum("btk,bt->bk", design, target)
    months = n - start
    scores, weights, variances = np.full((len(CANDIDATES), size), np.inf), np.zeros((len(CANDIDATES), size, len(TERMS))), np.ones((len(CANDIDATES), size))
    for c, (lags, seasonal) in enumerate(CANDIDATES):
        own = [0, 1, *range(2, 2 + lags), *([len(TERMS) - 1] if seasonal else [])]
        k = 3 + lags + seasonal
        able = (lags <= start) & (months > k + 1) & (yearly | (not seasonal))
        if not able.any():
            continue
        w, _ = solve(gram[able][:, own][:, :, own], moment[able][:, own])
        rest = target[able] - np.einsum("btk,bk->bt", design[able][:, :, own], w)
        m = months[able]
        variance = np.maximum((rest**2).sum(axis=1) / m * series.scale[able] ** 2, 1e-12)
        scores[c, able] = np.log(variance) + 2 * k / m + 2 * k * (k + 1) / (m * (m - k - 1))
        full = np.zeros((int(able.sum()), len(TERMS)))
        full[:, own] = w
        weights[c, able], variances[c, able] = full, variance
    best, at = scores.argmin(axis=0), np.arange(size)
    found = np.isfinite(scores[best, at])
    return np.where(found, best, -1), weights[best, at], variances[best, at], scores[best, at]


def lag_forecasts(series: Series, horizon: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Point forecasts, their spread and the chosen order of every series.

    The spread at a step sums the weights with which earlier errors reach it. A series too short
    for any candidate has its mean and deviation.
    """
    best, weights, variance, _ = fitted(series)
    for column in range(series.width, series.width + horizon):
        series.y[:, column] = (series.terms(column) * weights).sum(axis=1)
    carry = np.zeros((len(best), YEAR + 1))
    carry[:, 1 : 1 + MOST_LAGS] = weights[:, 2 : 2 + MOST_LAGS]
    carry[:, YEAR] += weights[:, -1]
    reach = np.ones((len(best), horizon))
    for h in range(1, horizon):
        reach[:, h] = sum(carry[:, i] * reach[:, h - i] for i in range(1, min(h, YEAR) + 1))
    spread = np.sqrt(variance[:, None] * np.cumsum(reach**2, axis=1))
    none = (best < 0)[:, None]
    points = series.mean[:, None] + series.scale[:, None] * np.where(none, 0.0, series.y[:, series.width :])
    names = [f"lags={lags}{' seasonal' if seasonal else ''} trend" for lags, seasonal in CANDIDATES]
    return points, np.where(none, series.deviation[:, None], spread), ["mean" if b < 0 else names[b] for b in best]


def packed_series(monthly: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """One row per key: the months with values, as a count from year 0, and the values.

    Months are few whatever the input, so a row is short.
    """
    count = F.year(month) * 12 + F.month(month) - 1
    pairs = F.collect_list(F.struct(count.alias("m"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v")))
    return monthly.groupBy(*keys).agg(pairs.alias("_pairs")).select(*keys, F.col("_pairs.m").alias("_months"), F.col("_pairs.v").alias("_values"))


def over_series(packed: DataFrame, keys: Sequence[str], schema: str, work: Callable[[pa.Array, pa.Array], list[pa.Array]]) -> DataFrame:
    """``work`` on the months and values of thousands of series at once; its arrays stand beside the keys."""
    kinds = ", ".join(f"`{k}` {packed.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, *[c.split()[0] for c in schema.split(", ")]]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            months, values = (batch.column(batch.num_columns - i) for i in (2, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *work(months, values)], names=names)

    return packed.mapInArrow(each, f"{kinds}, {schema}")


def month_of(count: Column) -> Column:
    return F.make_date(F.floor(count / 12).cast("int"), (count % 12 + 1).cast("int"), F.lit(1))


def lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), pa.array(values.reshape(-1)))


def forecast(monthly: DataFrame, keys: Sequence[str], month: str, value: str, horizon: int = 12) -> DataFrame:
    """Forecast each key's series with a 95 % interval; months without a value are 0.

    Series are monthly totals, one short row each; thousands are solved together.
    """

    def work(months: pa.Array, values: pa.Array) -> list[pa.Array]:
        series = Series(months, values, horizon)
        points, spread, order = lag_forecasts(series, horizon)
        return [pa.array(series.last), lists(points), lists(spread), pa.array(order)]

    found = over_series(packed_series(monthly, keys, month, value), keys, "_last long, _points array<double>, _spread array<double>, model string", work)
    return found.select(*keys, "_last", "model", F.posexplode(F.arrays_zip("_points", "_spread")).alias("_at", "_x")).select(
        *keys,
        month_of(F.col("_last") + F.col("_at") + 1).alias(month),
        F.col("_x._points").alias("forecast"),
        (F.col("_x._points") - Z95 * F.col("_x._spread")).alias("lower"),
        (F.col("_x._points") + Z95 * F.col("_x._spread")).alias("upper"),
        "model",
    )


def lag_coefficients(monthly: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """keys, months, intercept, slope: each series regressed on its value of the month before.

    Both are NULL where that value never changes or fewer than two months have one before them.
    """

    def work(months: pa.Array, values: pa.Array) -> list[pa.Array]:
        series = Series(months, values)
        used = np.arange(series.width) > (series.width - series.n)[:, None]
        design = np.where(used[:, :, None], series.design()[:, :, [0, 2]], 0.0)
        target = np.where(used, series.y, 0.0)
        w, sound = solve(np.einsum("btk,btl->bkl", design, design), np.einsum("btk,bt->bk", design, target))
        intercept = series.mean + series.scale * w[:, 0] - w[:, 1] * series.mean
        return [pa.array(series.n), *[pa.array(x, mask=~sound) for x in (intercept, w[:, 1])]]

    return over_series(packed_series(monthly, keys, month, value), keys, "months long, intercept double, slope double", work)


def seasonal_naive(monthly: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """Each of the next twelve months takes the value of the same month a year before."""
    filled = gap_filled(monthly, keys, month, value)
    last = F.max(month).over(Window.partitionBy(*keys))
    recent = filled.withColumn("_last", last).where(F.col(month) > F.add_months("_last", -12))
    return recent.select(*keys, F.add_months(month, 12).alias(month), F.col(value).alias("forecast"))
