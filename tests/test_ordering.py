"""Exact ranks, percentiles and running sums against brute force, hot keys included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.operators import ordering as O


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, one value shared by a third of them, some NULLs."""
    pick = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 10 < 7 else pick.choice(["a", "b", None])
        value = 5.0 if i % 3 == 0 else (None if i % 97 == 0 else round(pick.uniform(0, 100), 2))
        data.append((i, key, value))
    return spark.createDataFrame(data, "id long, k string, v double").repartition(6), data


def test_exact_rank_per_key(skewed):
    df, data = skewed
    got = {r["id"]: (r["rank"], r["group_size"]) for r in O.exact_rank(df.where("v is not null"), ["v", "id"], ["k"]).collect()}
    for key in {d[1] for d in data}:
        ordered = sorted((d[2], d[0]) for d in data if d[1] == key and d[2] is not None)
        for rank, (_, row_id) in enumerate(ordered, 1):
            assert got[row_id] == (rank, len(ordered))


def test_exact_rank_overall_descending(skewed):
    df, data = skewed
    got = {r["id"]: r["rank"] for r in O.exact_rank(df.where("v is not null"), [F.desc("v"), "id"]).collect()}
    ordered = sorted(((-d[2], d[0]) for d in data if d[2] is not None))
    assert got == {row_id: i for i, (_, row_id) in enumerate(ordered, 1)}


def test_hot_key_and_hot_value_are_spread(skewed):
    df, _ = skewed
    placed = O.place(df.where("v is not null"), ["k"], ["v", "id"])
    sizes = [r["count"] for r in placed.groupBy(O.PIECE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_percentiles(skewed):
    df, data = skewed
    probabilities = [0.0, 0.2, 0.5, 0.85, 1.0]
    values = np.array([d[2] for d in data if d[2] is not None])
    assert O.global_percentiles(df, {"v": F.col("v")}, probabilities, "id")["v"] == pytest.approx(
        list(np.quantile(values, probabilities))
    )
    got = {r["k"]: (r["p20"], r["p85"]) for r in O.grouped_percentiles(df, ["k"], "v", {"p20": 0.2, "p85": 0.85}, "id").collect()}
    for key in got:
        part = [d[2] for d in data if d[1] == key and d[2] is not None]
        assert got[key] == pytest.approx(tuple(np.quantile(part, [0.2, 0.85])))


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([(1, None)], "id long, v double")
    assert O.global_percentiles(empty, {"v": F.col("v")}, [0.5], "id") == {"v": [None]}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 250])
def test_quintile_scores_equal_the_rank_formula(spark, n):
    pick = random.Random(n)
    data = [(i, float(pick.choice([1, 1, 1, 2, 3, i])), None if i == 0 and n > 4 else float(i % 3)) for i in range(n)]
    df = spark.createDataFrame(data, "id long, a double, b double")
    scored = O.quantile_scores(df, {"sa": (F.col("a"), True), "sb": (F.col("b"), False)}, "id")
    got = {r["id"]: (r["sa"], r["sb"]) for r in scored.collect()}
    for position, reverse in ((0, True), (1, False)):
        ordered = sorted((d[1 + position], d[0]) for d in data if d[1 + position] is not None)
        size = len(ordered)
        for rank, (_, row_id) in enumerate(ordered, 1):
            bin_ = max(1, -(-(rank - 1) * 5 // max(size - 1, 1)))
            assert got[row_id][position] == (6 - bin_ if reverse else bin_)
    if n > 4:
        assert got[0][1] is None


def test_running_sums_per_key(skewed):
    df, data = skewed
    out = O.running_sums(df.where("v is not null and k is not null"), ["v", "id"], {"total": F.lit(1)}, ["k"]).collect()
    for key in ("hot", "a", "b"):
        ordered = [r["id"] for r in sorted((r for r in out if r["k"] == key), key=lambda r: (r["v"], r["id"]))]
        totals = {r["id"]: r["total"] for r in out if r["k"] == key}
        assert [totals[i] for i in ordered] == list(range(1, len(ordered) + 1))
