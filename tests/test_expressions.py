"""Edges of the column expressions on hand-made frames."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfield.functions import buckets as B
from tallyfield.functions import clinical as K
from tallyfield.functions import dates as D
from tallyfield.functions import numbers as N
from tallyfield.functions import text as X
from tallyfield.functions import traffic as R
from tallyfield.operators import frames
from tests.conftest import rows

day = dt.date.fromisoformat


def test_names_recode_and_mail(spark):
    people = spark.createDataFrame(
        [(1, " ann ", "lee", " A@B.org ", "m"), (2, None, "poe", "none", "FEMALE"), (3, "x", None, None, None)],
        "id int, first_name string, last_name string, email string, gender string",
    )
    assert rows(people.select("id", X.full_name("first_name", "last_name"))) == [(1, " ann  lee"), (2, None), (3, None)]
    assert rows(people.select("id", X.recode("gender", X.GENDER_CODES))) == [(1, "Male"), (2, "Female"), (3, "Other")]
    assert rows(people.where(X.plausible_email("email")), "id") == [(1,)]
    assert rows(people.select("id", X.prefix_in("email", ["non"]))) == [(1, 0), (2, 1), (3, 0)]


def test_staging_keeps_reachable_customers(spark):
    raw = spark.createDataFrame(
        [(1, " ann ", "lee", " A@B.org ", "m", day("1990-12-31")), (2, "b", "c", "none", "f", None), (3, "d", "e", "d@e.fr", None, None)],
        "customer_id int, first_name string, last_name string, email string, gender string, date_of_birth date",
    )
    out = frames.stage_customers(raw, "2001-01-01")
    assert rows(out, "customer_id", "first_name", "email", "gender", "age", "generation") == [
        (1, "ANN", "a@b.org", "Male", 11, "Gen Z"),
        (3, "D", "d@e.fr", "Other", None, "Baby Boomer"),
    ]


def test_cut_is_right_closed(spark):
    values = [-1.0, 0.0, 25.0, 25.5, 26.0, 100.0, 101.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[1] for r in rows(df.select("i", B.cut("v", *B.AGE_GROUP)))]
    assert got == [None, None, "18-25", "26-35", "26-35", "55+", None, None]
    assert [r[1] for r in rows(df.select("i", B.cut("v", *B.STAY)))][-2:] == ["Extended (10+)", None]


def test_generation_sends_null_to_the_last_label(spark):
    df = spark.createDataFrame([(24,), (25,), (39,), (54,), (55,), (None,)], "a int")
    got = {r[0]: r[1] for r in df.select("a", B.below("a", *B.GENERATION)).collect()}
    assert got == {24: "Gen Z", 25: "Millennial", 39: "Millennial", 54: "Gen X", 55: "Baby Boomer", None: "Baby Boomer"}


def test_calendar_boundaries(spark):
    df = spark.createDataFrame(
        [(day("2001-01-31"), day("2001-02-01")), (day("2000-12-31"), day("2001-01-01")), (day("2004-02-29"), day("2005-02-28"))],
        "a date, b date",
    )
    got = rows(df.select(D.months_crossed("a", "b"), D.years_crossed("a", "b"), D.age_in_365_day_years("a", "b")))
    assert got == [(1, 0, 0), (1, 1, 0), (12, 1, 1)]


def test_sensor_edges(spark):
    df = spark.createDataFrame(
        [(0, 10, 0.0, None), (1, 10, 0.5, 4.9), (2, 10, 0.5, 5.0), (3, 10, 0.5, 120.0), (4, 10, 0.5, 120.1)],
        "i int, n int, o double, s double",
    )
    got = rows(df.select("i", R.density("n", "o"), R.congestion_level("s"), R.congestion_level("s", unknown=True)))
    assert [r[1] for r in got] == [None, 20.0, 20.0, 20.0, 20.0]
    assert [r[2] for r in got] == ["Free Flow", "Heavy", "Heavy", "Free Flow", "Free Flow"]
    assert got[0][3] == "Unknown"


def test_missing_clinical_values_never_fire(spark):
    columns = (
        "age int, charlson_comorbidity_index int, previous_admissions_30d int, severity_of_illness string, avg_systolic_bp double,"
        " avg_heart_rate double, avg_oxygen_saturation double, total_medications int, high_risk_medications int, polypharmacy_flag int"
    )
    df = spark.createDataFrame([(None,) * 10, (64, 2, 0, "Extreme", 180.0, 50.0, 95.0, 10, 0, 0), (65,) + (None,) * 9], columns)
    got = rows(df.select(K.high_risk_patient(), K.vital_instability(), K.medication_burden(), K.severity_rank()))
    assert got == [(0, 0, 0, 1), (0, 0, 0, 4), (1, 0, 0, 1)]


def test_readmission_limit_is_thirty_days(spark):
    df = spark.createDataFrame(
        [(day("2001-01-01"), day("2001-01-31")), (day("2001-01-01"), day("2001-02-01")), (day("2001-01-01"), None)], "d date, n date"
    )
    assert [r[1] for r in df.select("n", K.readmitted_within("n", "d")).collect()] == [1, 0, 0]


def test_rounding_and_guards(spark):
    df = spark.createDataFrame([(0.125, 4.0, 1), (0.375, None, 3)], "v double, s double, n int")
    assert rows(df.select(N.rounded("v", 2), N.mean_gap("s", "n"), N.floored_divisor("s", 5.0))) == [
        (0.12, None, 5.0), (0.38, None, None),
    ]
    assert df.select(N.ratio("v", F.lit(0))).first()[0] is None


@pytest.mark.parametrize("bins", [5])
def test_rank_bins_are_even_and_match_their_inverse(spark, bins):
    for n in [1, 2, 4, 5, 7, 23, 101]:
        got = [r[1] for r in spark.range(1, n + 1).select("id", B.rank_bin("id", F.lit(n), bins)).orderBy("id").collect()]
        assert min(got) == 1 and max(got) <= bins and got == sorted(got)
        for index in range(1, bins):
            assert B.last_rank_of_bin(n, index, bins) == max(i + 1 for i, b in enumerate(got) if b <= index)
        if n >= bins:
            sizes = [got.count(b) for b in range(1, bins + 1)]
            assert max(sizes) - min(sizes) <= 1


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-10, 120), min_size=1, max_size=20))
def test_every_value_has_exactly_one_bin(spark, values):
    edges, labels = B.AGE_GROUP
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for value, label in df.select("v", B.cut("v", edges, labels)).collect():
        inside = [name for low, high, name in zip(edges, edges[1:], labels) if low < value <= high]
        assert inside == ([label] if label else [])


def test_deidentified_rows_hold_no_identifier(spark):
    df = spark.createDataFrame([(7, "ann", day("1910-05-05"), 91), (8, "bob", day("1980-05-05"), 21)], "id int, name string, born date, age int")
    out = frames.deidentify(df, "s", ["id"], ["born"], "age", ["name"])
    assert out.columns == ["id", "born", "age"]
    assert {r["age"] for r in out.collect()} == {90, 21}
    assert all(len(r["id"]) == 64 for r in out.collect())
