"""Autoregressive moving-average models of many monthly series, by exact likelihood in state-space form.

Each series is differenced until it stands level, all orders up to (2, 2) are fitted at once as rows of one batch, and
the order of least corrected AIC is kept. The likelihood comes from a Kalman filter that runs over the
months once for the whole batch; partial autocorrelations as parameters keep every model stationary and invertible.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.forecasting import Z95, Series, lists, month_of, over_series, packed_series

#: (autoregressive, moving-average) orders that compete.
ORDERS = [(p, q) for p in range(3) for q in range(3)]
#: Differences taken at most, and the level statistic above which one is taken (5 % point of the KPSS test).
DIFFERENCES, LEVEL = 1, 0.463
STATE = 3
#: Where the search begins: (first two partial autocorrelations of each side, before tanh).
STARTS = np.array([[0.1, 0.0, 0.1, 0.0], [0.6, 0.1, -0.5, 0.0], [-0.4, 0.0, 0.5, 0.1]])
STEPS, HALVINGS = 25, 6


def level_statistic(y: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The KPSS statistic for a constant level of each row, with the usual bandwidth."""
    n = inside.sum(axis=1)
    e = np.where(inside, y - (np.where(inside, y, 0).sum(axis=1) / n)[:, None], 0.0)
    band = np.floor(4 * (n / 100) ** 0.25)
    long_run = (e**2).sum(axis=1)
    for lag in range(1, int(band.max(initial=0)) + 1):
        weight = np.maximum(1 - lag / (band + 1), 0)
        long_run += 2 * weight * (e[:, lag:] * e[:, :-lag]).sum(axis=1)
    sums = np.where(inside, np.cumsum(e, axis=1), 0.0)
    return (sums**2).sum(axis=1) / np.maximum(n * long_run, 1e-300)


def polynomials(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Autoregressive and moving-average weights, two each, from unbounded parameters."""
    p1, p2, q1, q2 = np.moveaxis(np.tanh(u[..., :4]), -1, 0)
    return np.stack([p1 * (1 - p2), p2], axis=-1), np.stack([q1 * (1 + q2), q2], axis=-1)


def stationary(ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """The covariance that the state keeps when nothing is seen: the fixed point of one step, a linear system."""
    move = np.zeros((*ar.shape[:-1], STATE, STATE))
    move[..., 0, 0], move[..., 1, 0] = ar[..., 0], ar[..., 1]
    move[..., 0, 1] = move[..., 1, 2] = 1.0
    load = np.concatenate([np.ones((*ma.shape[:-1], 1)), ma], axis=-1)
    noise = (load[..., :, None] * load[..., None, :]).reshape(*ar.shape[:-1], STATE**2, 1)
    twice = np.einsum("...ij,...kl->...ikjl", move, move).reshape(*ar.shape[:-1], STATE**2, STATE**2)
    return np.linalg.solve(np.eye(STATE**2) - twice, noise).reshape(move.shape)


def filtered(u: np.ndarray, z: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Minus twice the log likelihood (without its constant), innovation variance and last state of each row.

    ``u`` may have more axes than the rows of ``z`` have. Rows end in the last column; columns before a row begins
    leave its state as it is. The state holds three numbers, of which the last is 0 after each step; the steps are
    written out, as products of matrices this small cost more than their terms.
    """
    (f1, f2), (m1, m2) = (np.moveaxis(x, -1, 0) for x in polynomials(u))
    cover = stationary(*polynomials(u))
    c00, c01, c02, c11, c12, c22 = (cover[..., i, j] for i, j in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)))
    mean, (s0, s1) = u[..., 4], np.zeros((2, *u.shape[:-1]))
    squares, logs, n = np.zeros(u.shape[:-1]), np.zeros(u.shape[:-1]), inside.sum(axis=-1)
    for t in range(z.shape[-1]):
        on = inside[..., t]
        if not on.any():
            continue
        wide = np.maximum(c00, 1e-12)
        off = z[..., t] - mean - s0
        squares += on * (off**2 / wide)
        logs += on * np.log(wide)
        a00, a01, a02 = f1 * c00 + c01, f1 * c01 + c11, f1 * c02 + c12
        a10, a12 = f2 * c00 + c02, f2 * c02 + c22
        g0, g1 = a00 / wide, a10 / wide
        after = (
            f1 * s0 + s1 + g0 * off, f2 * s0 + g1 * off,
            f1 * a00 + a01 + 1.0 - g0 * a00, f2 * a00 + a02 + m1 - g0 * a10, m2, f2 * a10 + a12 + m1 * m1 - g1 * a10, m1 * m2, m2 * m2,
        )
        if on.all():
            s0, s1, c00, c01, c02, c11, c12, c22 = after
        else:
            s0, s1, c00, c01, c02, c11, c12, c22 = (np.where(on, x, y) for x, y in zip(after, (s0, s1, c00, c01, c02, c11, c12, c22)))
    variance = np.maximum(squares / n, 1e-12)
    return n * np.log(variance) + logs, variance, (s0, s1)


def minimise(u: np.ndarray, free: np.ndarray, z: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quasi-Newton descent of every row at once; ``free`` marks the parameters that may move."""
    m, k = u.shape
    each = lambda points: filtered(points, z[:, None], inside[:, None])[0]

    def slope(at: np.ndarray) -> np.ndarray:
        nudge = 1e-5 * np.eye(k)
        value = each(at[:, None] + np.concatenate([nudge, -nudge]))
        return np.where(free, (value[:, :k] - value[:, k:]) / 2e-5, 0.0)

    lengths = 0.5 ** (2 * np.arange(HALVINGS))
    value, gradient = each(u[:, None])[:, 0], slope(u)
    inverse = np.tile(np.eye(k), (m, 1, 1)) / np.maximum(np.abs(gradient).max(axis=1), 1.0)[:, None, None]
    for _ in range(STEPS):
        step = -np.einsum("mij,mj->mi", inverse, gradient)
        step *= np.minimum(1.0, 1.5 / np.maximum(np.abs(step).max(axis=1), 1e-300))[:, None]
        tried = each(u[:, None] + lengths[:, None] * step[:, None])
        best = tried.argmin(axis=1)
        lower = tried[np.arange(m), best]
        moved = np.where((lower < value - 1e-10)[:, None], lengths[best][:, None] * step, 0.0)
        if not moved.any():
            break
        u, value, before = u + moved, np.minimum(value, lower), gradient
        gradient = slope(u)
        turn = gradient - before
        bend = (turn * moved).sum(axis=1)
        sound = bend > 1e-10
        rho = np.where(sound, 1 / np.where(sound, bend, 1.0), 0.0)[:, None, None]
        left = np.eye(k) - rho * moved[:, :, None] * turn[:, None, :]
        inverse = np.where(sound[:, None, None], left @ inverse @ left.transpose(0, 2, 1) + rho * moved[:, :, None] * moved[:, None, :], np.eye(k) / np.maximum(np.abs(gradient).max(axis=1), 1.0)[:, None, None])
    return u, value


class Fit:
    """The chosen model of every series: differences, order, weights, mean, variance, AIC for a month and last state."""

    def __init__(self, series: Series):
        y = series.y[:, : series.width]
        inside, size = series.inside.copy(), len(series.n)
        self.differences = np.zeros(size, np.int64)
        for _ in range(DIFFERENCES):
            take = (level_statistic(y, inside) > LEVEL) & (inside.sum(axis=1) > 10)
            drop = np.where(take[:, None], np.diff(y, axis=1, prepend=0.0), y)
            inside = np.where(take[:, None], inside & np.roll(inside, 1, axis=1) & (np.arange(series.width) > 0), inside)
            y = np.where(inside, drop, 0.0)
            self.differences += take
        n = inside.sum(axis=1)
        spread = np.sqrt((y**2).sum(axis=1) / n)
        self.scale = np.where(spread > 1e-9, spread, 1.0)
        z = y / self.scale[:, None]
        rows = size * len(ORDERS) * len(STARTS)
        p, q = np.array(ORDERS).T
        free = np.column_stack([p >= 1, p >= 2, q >= 1, q >= 2, np.ones(len(ORDERS), bool)])
        at = np.column_stack([np.tile(STARTS, (len(ORDERS), 1)), np.zeros(len(ORDERS) * len(STARTS))])
        free = np.repeat(free, len(STARTS), axis=0)
        u = np.tile(np.where(free, at, 0.0), (size, 1, 1)).reshape(rows, 5)
        u[:, 4] = np.repeat((z.sum(axis=1) / n), len(ORDERS) * len(STARTS))
        many = lambda x: np.repeat(x, len(ORDERS) * len(STARTS), axis=0)
        u, value = minimise(u, np.tile(free, (size, 1)), many(z), many(inside))
        value = value.reshape(size, len(ORDERS), len(STARTS))
        start, value = value.argmin(axis=2), value.min(axis=2)
        k = (p + q + 2)[None, :]
        months = n[:, None]
        room = months - k - 1
        # of the differenced series in its own units, a month's share
        score = value / months + 2 * np.log(np.maximum(self.scale * series.scale, 1e-12))[:, None] + np.where(room > 0, 2 * k / months + 2 * k * (k + 1) / (months * np.maximum(room, 1)), np.inf)
        best = score.argmin(axis=1)
        row = np.arange(size)
        self.ok = np.isfinite(score[row, best])
        self.score, self.p, self.q = score[row, best], p[best], q[best]
        self.u = u.reshape(size, len(ORDERS), len(STARTS), 5)[row, best, start[row, best]]
        self.ar, self.ma = polynomials(self.u)
        _, self.variance, self.state = filtered(self.u, z, inside)
        self.last = series.y[row, series.width - 1]

    def ahead(self, series: Series, horizon: int) -> tuple[np.ndarray, np.ndarray]:
        """Points and their deviations for the months to come, in the units of the series."""
        points, (s0, s1) = [], self.state
        for _ in range(horizon):
            points.append(self.u[:, 4] + s0)
            s0, s1 = self.ar[:, 0] * s0 + s1, self.ar[:, 1] * s0
        reach = np.zeros((len(self.u), horizon))
        reach[:, 0] = 1.0
        for h in range(1, horizon):
            reach[:, h] = sum(self.ar[:, i] * reach[:, h - 1 - i] for i in range(min(2, h))) + (self.ma[:, h - 1] if h <= 2 else 0.0)
        points = np.column_stack(points) * self.scale[:, None]
        once = (self.differences > 0)[:, None]
        points = np.where(once, self.last[:, None] + np.cumsum(points, axis=1), points)
        reach = np.where(once, np.cumsum(reach, axis=1), reach)
        spread = np.sqrt(self.variance[:, None] * np.cumsum(reach**2, axis=1)) * self.scale[:, None]
        wide = series.scale[:, None]
        return series.mean[:, None] + wide * np.where(self.ok[:, None], points, 0.0), np.where(self.ok[:, None], wide * spread, series.deviation[:, None])


def arima_forecast(monthly: DataFrame, keys: Sequence[str], month: str, value: str, horizon: int = 12) -> DataFrame:
    """Forecast each key's series with a 95 % interval; months without a value are 0.

    ``model`` names the order (autoregressive, differences, moving-average), ``aicc`` is the corrected AIC for a month. A
    series too short for any order has its mean and deviation.
    """

    def work(months: pa.Array, values: pa.Array) -> list[pa.Array]:
        series = Series(months, values)
        fit = Fit(series)
        points, spread = fit.ahead(series, horizon)
        names = [f"({p},{d},{q})" if ok else "mean" for p, d, q, ok in zip(fit.p, fit.differences, fit.q, fit.ok)]
        return [pa.array(series.last), lists(points), lists(spread), pa.array(names), pa.array(np.where(fit.ok, fit.score, np.nan), mask=~fit.ok)]

    schema = "_last long, _points array<double>, _spread array<double>, model string, aicc double"
    # a series costs many filter runs: a few go to each task
    packed = packed_series(monthly, keys, month, value)
    found = over_series(packed.repartition(4 * monthly.sparkSession.sparkContext.defaultParallelism, *keys), keys, schema, work)
    return found.select(*keys, "_last", "model", "aicc", F.posexplode(F.arrays_zip("_points", "_spread")).alias("_at", "_x")).select(
        *keys,
        month_of(F.col("_last") + F.col("_at") + 1).alias(month),
        F.col("_x._points").alias("forecast"),
        (F.col("_x._points") - Z95 * F.col("_x._spread")).alias("lower"),
        (F.col("_x._points") + Z95 * F.col("_x._spread")).alias("upper"),
        "model",
        "aicc",
    )
