import pytest
from pyspark.sql import functions as F

from tallyfield.operators import joins as J
from tallyfield.operators import quality as Q
from tests.conftest import rows


def test_suite_counts_and_gate(spark):
    df = spark.createDataFrame(
        [(1, "a@b.co", 5.0), (1, "bad", 1e6), (None, None, None), (2, "c@d.org", -1.0)], "id int, email string, amount double"
    )
    lines = Q.suite(df, "id", [Q.matches("email"), Q.between("amount", 0, 100000)])
    assert rows(lines, "check_name", "failed", "success") == [
        ("amount between", 2, False), ("email matches pattern", 1, False), ("id not null", 1, False), ("id unique", 2, False),
    ]
    with pytest.raises(Q.QualityError, match="email matches pattern: 1 of 4"):
        Q.gate(lines)
    with pytest.raises(Q.QualityError, match="missing"):
        Q.suite(df, "id", [], ["nothing"])


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    r = Q.orphan_keys(child, parent, "k", "p", "x").first()
    assert (r["checked"], r["failed"]) == (3, 1)


def test_star_join_refuses_repeated_keys(spark):
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Q.QualityError):
        J.star_join(fact, [("twice", twice, "k")], verify=True)
    assert J.star_join(fact, [("once", twice.limit(1), "k")], verify=True).count() == 2


def test_haversine(spark):
    km = spark.range(1).select(J.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert km == pytest.approx(111.195, abs=0.01)
