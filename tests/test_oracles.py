"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import compare, connect

BASE = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()
#: Queries that rightly find nothing in the smallest tables.
MAY_BE_EMPTY = {"completed_filter"}
#: The rows of the input that a query's rows answer to.
KEEP_PACE = {
    "incident_impact_join": "SELECT COUNT(*) FROM events WHERE event_type = 'error'",
    "clv_metrics": "SELECT COUNT(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F'",
    "json_rejects": "SELECT COUNT(*) FROM events",
    "stream_latest_state": "SELECT COUNT(DISTINCT user_id) FROM events",
}


@pytest.fixture(scope="module")
def db():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    message = compare(spark, db, BASE, name, QUERIES[name], ORACLES[name])
    assert message is None or message == "no rows" and name in MAY_BE_EMPTY, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, BASE).limit(1).count() == 1


def test_results_keep_pace_with_their_input(spark, db):
    """Ten times the input gives no smaller a share of output rows; a cut bound to one size would show."""
    larger, base = connect(BASE.replace("0.001", "0.01")), BASE.replace("0.001", "0.01")
    for name in KEEP_PACE:
        share = [QUERIES[name](spark, b).count() / d.execute(KEEP_PACE[name]).fetchone()[0] for d, b in ((db, BASE), (larger, base))]
        assert share[1] >= 0.7 * share[0], (name, share)


def test_products_have_their_own_series_and_pairs(spark, db):
    """Each product is forecast; pairs are of products, not of their categories."""
    sold = db.execute("SELECT COUNT(DISTINCT l_partkey) FROM lineitem").fetchone()[0]
    assert QUERIES["demand_forecast"](spark, BASE).groupBy("product_id").count().where("count = 12").count() == sold
    assert QUERIES["product_seasonal_naive"](spark, BASE).select("product_id").distinct().count() == sold
    assert QUERIES["product_affinity"](spark, BASE).count() > 10 * QUERIES["item_affinity"](spark, BASE).count()


def test_every_supplier_is_a_route(spark, db):
    """The cells of a supplier of any nation have their route; only cells without a supplier stay without one."""
    missing = db.execute(
        """SELECT COUNT(*) FROM events WHERE event_type = 'error' AND user_id * 2 // 3 NOT IN
        (SELECT unnest([s_suppkey, s_suppkey + 1]) FROM supplier)"""
    ).fetchone()[0]
    for name in ("incident_impact_all_routes", "route_diversion_all_routes"):
        assert QUERIES[name](spark, BASE).where("type = 'no_route'").count() == missing


def test_entry(spark):
    assert entry(spark).count() > 0
