"""Pairs near in place and time against all pairs, also at the poles and across the date line."""

import datetime as dt
import math

import numpy as np
import pytest

from tallyfield.operators import places as P
from tests.conftest import rows

SCHEMA = "lat double, lon double, started timestamp, ended timestamp"


def km(a, b):
    la, oa, lb, ob = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def scattered(random, n, centre):
    base = dt.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        lat = max(min(centre[0] + random.normal() * 1.5, 90.0), -90.0)
        lon = (centre[1] + random.normal() * (1.5 if abs(centre[0]) < 85 else 120) + 180) % 360 - 180
        start = base + dt.timedelta(minutes=int(random.integers(0, 6000)))
        out.append((float(lat), float(lon), start, start + dt.timedelta(minutes=int(random.integers(0, 3000)))))
    return out


@pytest.mark.parametrize("centre,radius", [((47.0, 8.0), 60), ((0.0, 179.9), 80), ((89.0, 0.0), 90), ((-89.9, 100.0), 150), ((60.0, -180.0), 3000), ((10.0, 10.0), 25_000)])
def test_pairs_equal_all_pairs(spark, centre, radius):
    random = np.random.default_rng(int(radius))
    a, b = scattered(random, 60, centre), scattered(random, 50, centre)
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(a)], "i long, " + SCHEMA)
    right = spark.createDataFrame([(i, *r, i % 3) for i, r in enumerate(b)], "j long, " + SCHEMA + ", k int")
    want = sorted((i, j, j % 3) for i, x in enumerate(a) for j, y in enumerate(b) if km(x[:2], y[:2]) <= radius and x[2] <= y[3] and y[2] <= x[3])
    assert len(want) > 20
    for dense, hours in ((5000, 24.0), (3, 5.0)):
        assert rows(P.near_and_overlapping(left, right, radius, "i", "j", ["k"], hours, dense), "i", "j", "k") == sorted(want, key=lambda r: tuple((False, str(x)) for x in r))


def test_rows_without_place_or_time(spark):
    at, end = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)
    incidents = [(1, 10.0, 20.0, at, None, 5), (2, None, 20.0, at, end, 6), (3, 10.0, 20.0, None, end, 7), (4, 10.0, 20.0, end, at, 8), (5, 95.0, 20.0, at, end, 9)]
    left = spark.createDataFrame(incidents, "incident_id long, " + SCHEMA + ", estimated_duration int")
    right = spark.createDataFrame([("r", 10.0, 20.0, at, at, "s"), ("far", 50.0, 20.0, at, end, "s")], "route_id string, " + SCHEMA + ", alternative_routes string")
    got = rows(P.affected_routes(left, right, 5.0), "incident_id", "type", "affected_route", "estimated_delay", "distance_km")
    assert got == [(1, "route_diversion", "r", 5, 0.0), *[(i, "no_route", None, i + 4, None) for i in (2, 3, 4, 5)]]
