"""Bucketed time windows against brute force, with one key that holds most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import admissions as A
from tallyfield.operators import joins as J
from tallyfield.operators import timeline as TL

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def line(spark):
    pick = random.Random(11)
    data = [
        (i, "hot" if i % 3 else pick.choice(["a", "b"]), START + dt.timedelta(minutes=pick.choice([0, 5, 5, pick.randint(0, 9000)])),
         pick.choice([None, pick.randint(1, 9)]))
        for i in range(600)
    ]
    return spark.createDataFrame(data, "id long, k string, t timestamp_ntz, v int"), data


def ordered(data, key):
    return sorted((d for d in data if d[1] == key), key=lambda d: (d[2], d[0]))


def bucket(kind):
    return None if kind == "pieces" else F.date_trunc(kind, F.col("t"))


by_bucket = pytest.mark.parametrize("kind", ["pieces", "hour", "day"])


@by_bucket
@pytest.mark.parametrize("forward", [True, False])
def test_neighbour_is_lead_and_lag(line, forward, kind):
    df, data = line
    out = TL.neighbour(df, ["k"], ["t", "id"], {"other": "id"}, forward, bucket(kind))
    got = {r["id"]: r["other"] for r in out.collect()}
    for key in ("hot", "a", "b"):
        ids = [d[0] for d in ordered(data, key)]
        shifted = ids[1:] + [None] if forward else [None] + ids[:-1]
        assert [got[i] for i in ids] == shifted


@by_bucket
def test_running_total(line, kind):
    df, data = line
    out = TL.running(df, ["k"], ["t", "id"], {"n": F.lit(1)}, bucket(kind))
    got = {r["id"]: r["n"] for r in out.collect()}
    for key in ("hot", "a", "b"):
        assert [got[d[0]] for d in ordered(data, key)] == list(range(1, len(ordered(data, key)) + 1))


@by_bucket
@pytest.mark.parametrize("forward", [True, False])
def test_carry_skips_null(line, forward, kind):
    df, data = line
    out = TL.carry(df, ["k"], ["t", "id"], {"seen": F.col("v")}, forward, bucket(kind))
    got = {r["id"]: r["seen"] for r in out.collect()}
    for key in ("hot", "a", "b"):
        held = None
        for d in ordered(data, key)[:: 1 if forward else -1]:
            held = d[3] if d[3] is not None else held
            assert got[d[0]] == held


@by_bucket
def test_sessions_split_at_the_gap(spark, kind):
    at = lambda s: START + dt.timedelta(seconds=s)
    data = [(1, "u", at(0)), (2, "u", at(1799)), (3, "u", at(1799 + 1800)), (4, "u", at(90000)), (5, "w", at(10))]
    df = spark.createDataFrame(data, "id long, u string, t timestamp_ntz")
    got = {r["id"]: r["session_start"] for r in TL.sessions(df, ["u"], "t", "id", 1800, bucket=bucket(kind)).collect()}
    assert got == {1: at(0), 2: at(0), 3: at(3599), 4: at(90000), 5: at(10)}


@by_bucket
def test_sessions_go_on_over_quiet_buckets(line, kind):
    df, data = line
    got = {r["id"]: r["session_start"] for r in TL.sessions(df, ["k"], "t", "id", 7200, bucket=bucket(kind)).collect()}
    for key in ("hot", "a", "b"):
        opened, before = None, None
        for row_id, _, at, _ in ordered(data, key):
            if before is None or (at - before).total_seconds() >= 7200:
                opened = at
            assert got[row_id] == opened
            before = at


def test_interval_totals_take_both_ends(spark):
    at = lambda h: START + dt.timedelta(hours=h)
    readings = spark.createDataFrame([("r", at(0), 1), ("r", at(5), 2), ("r", at(30), 4), ("q", at(5), 8)], "k string, t timestamp_ntz, v int")
    intervals = spark.createDataFrame(
        [("r", 1, at(0), at(5)), ("r", 2, at(5), at(30)), ("r", 3, at(6), at(6)), ("z", 4, at(0), at(9))],
        "k string, i long, s timestamp_ntz, e timestamp_ntz",
    )
    out = TL.interval_totals(readings, intervals, "k", "t", "s", "e", "i", {"n": F.lit(1), "v": F.col("v")})
    assert {r["i"]: (r["n"], r["v"]) for r in out.collect()} == {1: (2, 3), 2: (2, 6), 3: (0, 0), 4: (0, 0)}


def test_next_after_is_strict(spark):
    at = lambda m: START + dt.timedelta(minutes=m)
    events = spark.createDataFrame([("r", at(0), 1), ("r", at(200), 2), ("q", at(0), 3)], "k string, t timestamp_ntz, i long")
    answers = spark.createDataFrame([("r", at(0)), ("r", at(199))], "k string, t timestamp_ntz")
    got = {r["i"]: r["a"] for r in J.next_after(events, answers, "k", "t", "i", "a").collect()}
    assert got == {1: at(199), 2: None, 3: None}


def test_trailing_counts_leave_the_day_out(spark):
    day = dt.date(2001, 1, 31)
    days = [day, day, day + dt.timedelta(1), day + dt.timedelta(30), day + dt.timedelta(31)]
    df = spark.createDataFrame([("p", d) for d in days], "k string, d date")
    got = {r["d"]: (r["previous_30d"], r["total_previous"]) for r in A.trailing_counts(df, [30], "k", "d").collect()}
    assert got == {days[0]: (0, 0), days[2]: (2, 2), days[3]: (3, 3), days[4]: (2, 4)}


def test_covered_days_count_overlaps_once(spark):
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(n)
    df = spark.createDataFrame([("p", day(0), 10), ("p", day(5), 10), ("p", day(6), 2), ("p", day(20), 5), ("p", day(20), 3)], "k string, d date, s int")
    r = A.proportion_covered(df, ["k"], "d", "s").first()
    assert (r["days_covered"], r["days_in_period"], r["pdc"]) == (20, 25, 0.8)
