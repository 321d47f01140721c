"""Neighbour lists and recommendations against plain versions, and their recall against full lists."""

import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallyfield.operators import affinity as A
from tallyfield.session import load
from tests.conftest import rows

BASKETS = [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (2, "b"), (3, "a"), (3, "d"), (4, "a"), (4, "b"), (5, None), (5, "e"), (6, "c"), (6, "d"), (7, "b"), (7, "a")]


def plain_neighbours(lines, most):
    held = defaultdict(set)
    for basket, item in lines:
        if item is not None:
            held[basket].add(item)
    single = Counter(i for s in held.values() for i in s)
    pair = Counter((x, y) for s in held.values() for x in s for y in s if x != y)
    out = {}
    for i in single:
        close = sorted((-math.floor(n / math.sqrt(single[i] * single[o]) * 1_000_000), o) for (x, o), n in pair.items() if x == i)
        out[i] = [(o, -s) for s, o in close[:most]]
    return out


def test_neighbour_lists(spark):
    df = spark.createDataFrame(BASKETS, "basket int, thing string")
    for most in (1, 2, 9):
        want = sorted((i, o, s) for i, close in plain_neighbours(BASKETS, most).items() for o, s in close)
        assert rows(A.neighbour_lists(df, "basket", "thing", most), "item", "other", "similarity") == want


def test_recommendations_leave_out_what_is_owned(spark):
    lines = spark.createDataFrame(BASKETS, "basket int, thing string")
    bought = [("u", "c"), ("u", "c"), ("u", "d"), ("v", "a"), ("w", "e"), ("x", None), ("y", "a"), ("y", "b"), ("y", "c"), ("y", "d")]
    got = A.recommend(spark.createDataFrame(bought, "who string, thing string"), A.neighbour_lists(lines, "basket", "thing"), "who", "thing", 2)
    near, want = plain_neighbours(BASKETS, 10), []
    for who in "uv":
        owned = {i for w, i in bought if w == who}
        ties = sorted((-s, o, i) for i in owned for o, s in near[i] if o not in owned)
        best = sorted({o: (s, o, i) for s, o, i in reversed(ties)}.values())[:2]
        want += [(who, k + 1, o, -s / 1_000_000, i) for k, (s, o, i) in enumerate(best)]
    assert rows(got, "who", "place", "thing", "score", "because") == sorted(want)


def test_recall_against_full_lists(spark):
    """Ten neighbours give the recommendations that all neighbours give, and candidates follow the purchases."""
    base = "/root/testdata/sf0.01"
    lines, orders = load(spark, base, "lineitem"), load(spark, base, "orders")
    bought = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("o_custkey", "l_partkey")
    near = A.neighbour_lists(lines, "l_orderkey", "l_partkey")
    short, full = (
        {tuple(r) for r in A.recommend(bought, n, "o_custkey", "l_partkey").select("o_custkey", "l_partkey").collect()}
        for n in (near, A.neighbour_lists(lines, "l_orderkey", "l_partkey", 1 << 20))
    )
    assert len(full) > 1000 and len(short & full) >= 0.99 * len(full)
    assert near.groupBy("item").count().agg({"count": "max"}).first()[0] <= A.NEIGHBOURS


def test_a_pair_is_counted_once_with_both_counts(spark):
    """What a pair needs comes with its members: no row of a pair meets the counts of its items in a join."""
    df = spark.createDataFrame(BASKETS, "basket int, thing string")
    pairs = A.pair_counts(df, "basket", "thing")
    assert rows(pairs, "item", "other", "together", "baskets", "others") == [("a", "b", 4, 5, 4), ("a", "c", 1, 5, 2), ("a", "d", 1, 5, 2), ("b", "c", 1, 4, 2), ("c", "d", 1, 2, 2)]


def test_busy_users_get_the_same_recommendations(spark, monkeypatch):
    base = "/root/testdata/sf0.001"
    lines, orders = load(spark, base, "lineitem"), load(spark, base, "orders")
    bought = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("o_custkey", "l_partkey")
    near = A.neighbour_lists(lines, "l_orderkey", "l_partkey")
    found = []
    for busy in ([], [r[0] for r in orders.select("o_custkey").distinct().collect()][::2]):
        monkeypatch.setattr(A, "busy_users", lambda owned: busy)
        found.append(rows(A.recommend(bought, near, "o_custkey", "l_partkey")))
    assert found[0] == found[1] and len(found[0]) > 100


def test_a_user_with_most_purchases_is_busy(spark):
    owned = spark.range(20000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("_user"), F.col("id").alias("item"))
    assert -1 in A.busy_users(owned) and len(A.busy_users(owned)) <= 1 / A.BUSY
    empty = owned.where("item < 0").withColumnRenamed("_user", "user")
    assert A.recommend(empty, spark.createDataFrame([], "item long, other long, similarity long"), "user", "item").count() == 0
