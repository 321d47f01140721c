"""Forecasts of many series at once against one least-squares fit at a time."""

import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pytest

from tallyfield.operators import forecasting as FC


def plain_forecast(y, horizon=12, seasonal_from=36, most_lags=3):
    """(points, spread, order) of one series, each candidate fitted by itself."""

    def design(y, lags, seasonal, first):
        steps = np.arange(first, len(y))
        columns = [np.ones(len(steps)), steps.astype(float), *[y[steps - i] for i in range(1, lags + 1)]]
        return np.column_stack(columns + ([y[steps - 12]] if seasonal else []))

    best, yearly = None, len(y) >= seasonal_from
    start = 12 if yearly else min(most_lags, max(len(y) - 6, 0))
    for seasonal in (False, True)[: 1 + yearly]:
        for lags in range(min(most_lags, start) + 1):
            n, k = len(y) - start, 3 + lags + seasonal
            if n <= k + 1:
                continue
            x, target = design(y, lags, seasonal, start), y[start:]
            weights = np.linalg.lstsq(x, target, rcond=None)[0]
            variance = max(float(np.mean((target - x @ weights) ** 2)), 1e-12)
            score = np.log(variance) + 2 * k / n + 2 * k * (k + 1) / (n * (n - k - 1))
            if best is None or score < best[0]:
                best = (score, lags, seasonal, weights, variance)
    if best is None:
        return np.full(horizon, y.mean()), np.full(horizon, y.std()), "mean"
    _, lags, seasonal, weights, variance = best
    series = list(y)
    for _ in range(horizon):
        series.append(float(design(np.array([*series, 0.0]), lags, seasonal, len(series))[-1] @ weights))
    carry = np.zeros(13)
    carry[1 : lags + 1] = weights[2 : 2 + lags]
    carry[12] += weights[2 + lags] if seasonal else 0.0
    reach = [1.0]
    for h in range(1, horizon):
        reach.append(sum(carry[i] * reach[h - i] for i in range(1, min(h, 12) + 1)))
    return np.array(series[len(y) :]), np.sqrt(variance * np.cumsum(np.square(reach))), f"lags={lags}{' seasonal' if seasonal else ''} trend"


def some_series():
    random = np.random.default_rng(8)
    out = []
    for k in range(120):
        n = int(random.integers(1, 90))
        noise = random.normal(size=n) * 10
        for t in range(1, n):
            noise[t] += (k % 5) / 6 * noise[t - 1]
        season = 20 * np.sin(np.arange(n) * math.pi / 6) if k % 3 else 0.0
        out.append(1000.0 * (k % 4) + 2.0 * np.arange(n) * (k % 2) + season + noise)
    return out + [np.array([4.0]), np.array([1.0, 5.0, 2.0])]


def packed(series):
    return FC.Series(pa.array([list(range(100, 100 + len(y))) for y in series]), pa.array([y.tolist() for y in series]), 12)


def test_batched_forecasts_equal_single_fits():
    series = some_series()
    points, spread, order = FC.lag_forecasts(packed(series), 12)
    want = [plain_forecast(y) for y in series]
    assert order == [w[2] for w in want] and len(set(order)) >= 6
    for got, wide, (p, s, _), y in zip(points, spread, want, series):
        assert np.allclose(got, p, rtol=1e-6, atol=1e-6 * (1 + np.abs(y).max())) and np.allclose(wide, s, rtol=1e-5, atol=1e-6)


@pytest.mark.parametrize("y", [[5.0] * 40, [0.0] * 50, [0.0, 1.0] * 20, [3.0] * 7])
def test_singular_systems_give_finite_forecasts(y):
    points, spread, _ = FC.lag_forecasts(packed([np.array(y)]), 12)
    assert np.isfinite(points).all() and np.isfinite(spread).all() and (np.abs(points) < 20).all()


def test_forecast_follows_trend_and_season(spark):
    y = np.array([100 + 2 * i + 30 * math.sin(i * math.pi / 6) for i in range(60)])
    truth = [100 + 2 * i + 30 * math.sin(i * math.pi / 6) for i in range(60, 72)]
    assert np.allclose(FC.lag_forecasts(packed([y]), 12)[0][0], truth, atol=1.0)
    months = [(dt.date(2001 + i // 12, i % 12 + 1, 1), "k", "j", float(v)) for i, v in enumerate(y) if i != 7]
    months += [(dt.date(2003, 5, 1), "one", None, 4.0), (dt.date(2003, 12, 1), "gap", "x", None), (dt.date(2003, 5, 1), "gap", "x", 6.0)]
    frame = spark.createDataFrame(months, "m date, k string, j string, v double")
    out = FC.forecast(frame, ["k", "j"], "m", "v").orderBy("m").collect()
    own = [r for r in out if r["k"] == "k"]
    assert [r["m"] for r in own][:2] == [dt.date(2006, 1, 1), dt.date(2006, 2, 1)] and len(own) == 12
    assert all(r["lower"] <= r["forecast"] <= r["upper"] for r in own)
    one = [(r["m"], r["j"], r["forecast"], r["model"]) for r in out if r["k"] == "one"]
    assert len(one) == 12 and one[0] == (dt.date(2003, 6, 1), None, 4.0, "mean")
    assert [r["m"] for r in out if r["k"] == "gap"][0] == dt.date(2004, 1, 1)
    assert FC.forecast(frame.limit(0), ["k", "j"], "m", "v").collect() == []
