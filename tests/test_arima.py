"""The state-space likelihood against a plain one, recovery of planted orders, and gains over lag regressions."""

import datetime as dt

import numpy as np
import pyarrow as pa

from tallyfield.operators import arima as A
from tallyfield.operators import forecasting as FC


def planted(random, n, ar=(), ma=(), steps=False, mean=0.0):
    e = random.normal(size=n + 60)
    y = np.zeros(n + 60)
    for t in range(2, n + 60):
        y[t] = sum(a * y[t - 1 - i] for i, a in enumerate(ar)) + e[t] + sum(b * e[t - 1 - i] for i, b in enumerate(ma))
    y = y[60:] + mean
    return np.cumsum(y) if steps else y


def packed(series):
    return FC.Series(pa.array([list(range(100, 100 + len(y))) for y in series]), pa.array([list(map(float, y)) for y in series]))


def plain_value(ar, ma, mean, z):
    """n log variance + log determinant of the exact Gaussian likelihood, from the autocovariances."""
    n, far = len(z), 400
    psi = np.zeros(far)
    psi[0] = 1
    for j in range(1, far):
        psi[j] = sum(a * psi[j - 1 - i] for i, a in enumerate(ar) if j - 1 - i >= 0) + (ma[j - 1] if j <= len(ma) else 0)
    cover = np.array([(psi[: far - lag] * psi[lag:]).sum() for lag in range(n)])
    full = cover[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    off = z - mean
    return n * np.log(off @ np.linalg.solve(full, off) / n) + np.linalg.slogdet(full)[1]


def test_filter_equals_the_exact_likelihood():
    random = np.random.default_rng(0)
    u = random.normal(size=(6, 5)) * 0.5
    z, inside = random.normal(size=(6, 30)), np.arange(30) >= np.array([0, 0, 3, 10, 17, 5])[:, None]
    ar, ma = A.polynomials(u)
    got, _, _ = A.filtered(u, z, inside)
    for i in range(6):
        assert np.isclose(got[i], plain_value(ar[i], ma[i], u[i, 4], z[i, inside[i]]), rtol=1e-8)


def test_planted_parameters_come_back():
    random = np.random.default_rng(4)
    kinds = [((), (0.7,), False), ((0.6,), (), False), ((0.7,), (0.5,), False), ((), (0.4,), True)]

    def reach(ar, ma):
        """The weights on past errors, which say the same whatever order was chosen."""
        out = [1.0]
        for h in range(1, 6):
            out.append(sum(ar[j] * out[h - 1 - j] for j in range(min(len(ar), h))) + (ma[h - 1] if h <= len(ma) else 0))
        return np.array(out)

    for ar, ma, steps in kinds:
        series = packed([planted(random, 300, ar, ma, steps, 0 if steps else 3) for _ in range(16)])
        fit = A.Fit(series)
        right = fit.differences == steps
        assert right.mean() >= 0.75
        found = np.array([reach(a, m) for a, m in zip(fit.ar[right], fit.ma[right])])
        assert np.abs(np.median(found, axis=0) - reach(ar, ma)).max() < 0.06
        assert np.abs(found - reach(ar, ma)).max(axis=1).mean() < 0.15
        assert abs(np.median(np.sqrt(fit.variance[right]) * fit.scale[right] * series.scale[right]) - 1) < 0.05


def test_moving_average_beats_lag_regression():
    random = np.random.default_rng(7)
    series = [planted(random, 84, ma=(0.9,), mean=50) for _ in range(40)]
    fit = A.Fit(packed(series))
    score = FC.fitted(packed(series))[3]
    assert (fit.q > 0).mean() > 0.8
    assert (fit.score < score).mean() > 0.8 and (fit.score - score).mean() < -0.05


def test_orders_and_odd_series(spark):
    random = np.random.default_rng(1)
    wanted = {"ma": planted(random, 80, ma=(0.8,), mean=20), "flat": np.full(40, 7.0), "one": np.array([3.0]), "few": np.array([1.0, 2, 3, 4]), "walk": planted(random, 90, steps=True)}
    rows = [(k, dt.date(2000 + i // 12, i % 12 + 1, 1), float(v)) for k, y in wanted.items() for i, v in enumerate(y)]
    out = A.arima_forecast(spark.createDataFrame(rows, "k string, m date, v double"), ["k"], "m", "v").orderBy("m").collect()
    by = {k: [r for r in out if r["k"] == k] for k in wanted}
    assert all(len(v) == 12 and all(np.isfinite([r["forecast"], r["lower"], r["upper"]]).all() for r in v) for v in by.values())
    assert all(abs(r["forecast"] - 7) < 1e-6 for r in by["flat"]) and by["one"][0]["model"] == "mean" and by["one"][0]["forecast"] == 3.0
    assert "1" in by["walk"][0]["model"].split(",")[1] and abs(by["walk"][0]["forecast"] - wanted["walk"][-1]) < 4
    assert by["ma"][5]["upper"] - by["ma"][5]["lower"] < 2 * 1.96 * 2
    assert by["ma"][0]["m"] == dt.date(2006, 9, 1)
