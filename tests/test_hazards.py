"""Proportional hazards, concordance and calibration against plain versions."""

import math

import numpy as np
import pytest

from tallyfield.operators import hazards as Z


def patients(n=300, seed=0, ties=True):
    random = np.random.default_rng(seed)
    x, y = random.normal(size=n), random.integers(0, 3, n).astype(float)
    life = random.exponential(60 * np.exp(-0.8 * x - 0.3 * y))
    censor = random.exponential(80, n)
    time = np.ceil(np.minimum(life, censor) / (8 if ties else 0.01)).astype(int)
    return [(int(t), int(a <= c), float(u), float(v)) for t, a, c, u, v in zip(time, life, censor, x, y)]


def plain_value(rows, b):
    """Efron's log partial likelihood."""
    out = 0.0
    for t in {r[0] for r in rows if r[1]}:
        risk = sum(math.exp(b[0] * r[2] + b[1] * r[3]) for r in rows if r[0] >= t)
        dying = [math.exp(b[0] * r[2] + b[1] * r[3]) for r in rows if r[0] == t and r[1]]
        out += sum(math.log(x) for x in dying) - sum(math.log(risk - i / len(dying) * sum(dying)) for i in range(len(dying)))
    return out


def plain_concordance(rows):
    pairs = good = tied = 0
    for t, e, r in rows:
        for u, _, s in rows:
            if e and u > t:
                pairs, good, tied = pairs + 1, good + (r > s), tied + (r == s)
    return pairs, good, tied


def test_weights_maximise_the_partial_likelihood(spark, monkeypatch):
    rows = patients()
    frame = spark.createDataFrame([(*r, "z") for r in rows] + [(None, 1, 0.0, 0.0, "z")], "t int, e int, x double, y double, time string")
    model = Z.fit_hazards(frame, "t", "e", ["x", "y"])
    assert model.log_likelihood == pytest.approx(plain_value(rows, model.weights), rel=1e-9)
    for i in range(2):
        for d in (-1e-3, 1e-3):
            assert plain_value(rows, model.weights + d * np.eye(2)[i]) < model.log_likelihood
    curve = lambda i, d: plain_value(rows, model.weights + d * np.eye(2)[i])
    bend = np.array([(2 * model.log_likelihood - curve(i, 1e-3) - curve(i, -1e-3)) / 1e-6 for i in range(2)])
    assert np.linalg.inv(model.covariance)[[0, 1], [0, 1]] == pytest.approx(bend, rel=1e-3)
    assert model.weights == pytest.approx([0.8, 0.3], abs=0.25) and model.table(frame).count() == 2
    monkeypatch.setattr(Z, "TIES", 2)
    assert Z.fit_hazards(frame, "t", "e", ["x", "y"]).weights == pytest.approx(model.weights, abs=1e-9)


def test_odd_covariates(spark):
    frame = spark.createDataFrame([(1, 1, 1.0, 5.0), (2, 0, None, 5.0), (3, 1, 0.0, 5.0), (4, 1, 2.0, 5.0), (4, 0, 1.5, 5.0)], "t int, e int, x double, y double")
    assert Z.fit_hazards(frame, "t", "e", ["x", "y"]).weights[1] == 0
    nobody = Z.fit_hazards(frame.where("e = 0"), "t", "e", ["x"])
    assert nobody.weights[0] == 0
    assert Z.fit_hazards(frame.limit(0), "t", "e", ["x"]).weights[0] == 0
    assert Z.concordance(frame.limit(0), "t", "e", "x").first()["c_index"] is None


@pytest.mark.parametrize("levels", [3, 1000])
def test_concordance_counts_all_pairs(spark, levels, monkeypatch):
    rows = [(t, e, float(round(x * levels / 3))) for t, e, x, _ in patients(250, levels)]
    frame = spark.createDataFrame(rows + [(None, 1, 1.0), (3, 1, None)], "t int, e int, r double")
    for cells in (500_000, 7):
        monkeypatch.setattr(Z, "PIECE_CELLS", cells)
        got = Z.concordance(frame, "t", "e", "r").first()
        pairs, good, tied = plain_concordance(rows)
        assert (got["pairs"], got["concordant"], got["tied"]) == (pairs, good, tied)
        assert got["c_index"] == pytest.approx((good + tied / 2) / pairs)


def test_calibration(spark):
    schema = "t int, e int, x double, y double"
    fit_on, held = (spark.createDataFrame(patients(500, seed), schema) for seed in (1, 2))
    model = Z.fit_hazards(fit_on, "t", "e", ["x", "y"])
    slope = Z.calibration_slope(held, "t", "e", model)
    assert slope == pytest.approx(1, abs=0.25)
    model.weights = model.weights * 2
    assert Z.calibration_slope(held, "t", "e", model) == pytest.approx(slope / 2, rel=1e-6)
