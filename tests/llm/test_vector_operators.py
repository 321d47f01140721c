"""The operators on vectors against plain versions, on odd rows and on an empty table."""

from collections import Counter

import brute
import numpy as np
import pytest

from tallyfield.llm import collisions, residues

SCHEMA = "vec_id long, embedding array<float>, label int, _id string, _label string, _v string, _block string, rank string"


def vectors():
    """Clustered vectors with ties, repeated rows, NULLs, values that are not finite, and odd lengths."""
    random = np.random.default_rng(5)
    rows = []
    centres = random.normal(size=(6, 12))
    for i in range(420):
        v = centres[i % 6] + random.normal(size=12) * (0.03 if i % 3 else 0.4)
        rows.append((i, [float(np.float32(x)) for x in np.round(v / np.linalg.norm(v), 1 if i % 5 == 0 else 4)], i % 6 if i % 11 else i % 4))
    rows += [rows[50], rows[51], rows[100]]  # repeated
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(0, 60, 3)]  # copies
    rows += [(2000 + k, [2.0 * x for x in rows[k][1]], rows[k][2]) for k in range(0, 30, 3)]  # the same direction
    rows += [(3000, None, 1), (3001, rows[1][1], None), (None, rows[2][1], 2), (3002, [float("nan")] * 12, 3), (3003, [None] + [0.5] * 11, 3)]
    rows += [(3050, [0.0] * 12, 2), (3004, [float("inf")] + [0.0] * 11, 2), (3005, [], 1), (3100, [0.5, 0.25], 1), (3006, [0.5, 0.25], 1), (150, rows[3][1], 3)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return vectors()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, "z", "z", "z", "z", "z") for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- op13


def test_hard_negatives(table, rows, nothing, monkeypatch):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute.negatives(rows)
    assert len(want) > 50
    assert Counter(tuple(r) for r in residues.mine(table).select(columns).collect()) == want
    monkeypatch.setattr(residues, "ANCHORS", 3)
    monkeypatch.setattr(residues, "TILE", 64)
    assert Counter(tuple(r) for r in residues.mine(table).select(columns).collect()) == want
    assert residues.mine(nothing).collect() == []


@pytest.mark.parametrize("width,most", [(1, 3), (64, 256), (1500, 40_000), (3000, 2**24)])
def test_residue_products_are_exact(width, most):
    random = np.random.default_rng(width)
    a, b = (random.integers(-most, most + 1, (7, width)) for _ in range(2))
    a[0], b[0], b[1] = most, most, -most
    primes = residues.primes_for(width, width * most * most)
    want = a.astype(object) @ b.T.astype(object)
    assert (residues.exact_products(a, b, primes).astype(object) == want).all()


def test_scores_beyond_a_long_are_refused(spark):
    frame = spark.createDataFrame([(50, [1e18, 1.0], 1), (51, [1.0, 1e18], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(OverflowError):
        residues.mine(frame)


# ---- op11


def test_near_vectors(table, rows, nothing, monkeypatch):
    columns = ["vec_id", "n_links", "component_id", "kept"]
    want = brute.vector_links(rows, 0.98)
    assert sum(n > 5 for _, n, _, _ in want) > 50 and sum(not kept for *_, kept in want) > 50
    assert Counter(tuple(r) for r in collisions.near_vectors(table).select(columns).collect()) == want
    assert collisions.near_vectors(nothing).collect() == []


def test_near_vectors_in_cells_and_lots(table, rows, monkeypatch):
    """Many cells, tables and lots give the same links; each pair counts once."""
    monkeypatch.setattr(collisions, "CELL", 12)
    monkeypatch.setattr(collisions, "LOT", 5)
    got = Counter(tuple(r) for r in collisions.near_vectors(table, 0.95).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == brute.vector_links(rows, 0.95)


def test_counts_are_calibrated_to_the_recall():
    """Pairs just at the threshold reach the least count, and few others do."""
    random, n, d = np.random.default_rng(3), 4000, 64
    x, y = (random.normal(size=(n, d)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = 0.98 * x + np.sqrt(1 - 0.98**2) * y
    window, lines = collisions.REACH * np.sqrt(2 - 2 * 0.98), collisions.directions(d, 0, collisions.PROJECTIONS)
    count = lambda other: (np.abs((x - other) @ lines) <= window).sum(axis=1)
    assert (count(near) >= collisions.least_count()).mean() >= 0.9999
    assert (count(y) >= collisions.least_count()).mean() <= 0.002
    bits = 4
    tables = collisions.tables_for(bits, 0.98)
    assert (collisions.cells(x, bits, 0, tables) == collisions.cells(near, bits, 0, tables)).any(axis=1).mean() >= 0.9999


def test_collisions_equal_plain_windows():
    random = np.random.default_rng(1)
    left, right = random.normal(size=(30, 7)).round(1), random.normal(size=(40, 7)).round(1)
    want = (np.abs(left[:, None] - right[None]) <= 0.5 + 1e-12).sum(axis=2)
    assert (collisions.collisions(left, right, 0.5 + 1e-12) == want).all()
