"""Data-quality and set-operation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.text import EMAIL_PATTERN
from tallyfield.operators import quality as Q
from tallyfield.operators import traffic as T
from tallyfield.plans.bindings import ORDERS_SQL, PEOPLE_SQL, SENSORS_SQL, orders, people, readings
from tallyfield.plans.registry import Tables, query
from tallyfield.sources import schemas

EMAIL_SQL = f"'{EMAIL_PATTERN}'"


@query(
    "dq_column_exists",
    """SELECT 'o_orderkey' AS column_name, TRUE AS present, COUNT(*) AS checked, COUNT(o_orderkey) AS filled FROM orders
    UNION ALL SELECT 'o_orderstatus', TRUE, COUNT(*), COUNT(o_orderstatus) FROM orders UNION ALL SELECT 'o_comment', FALSE, COUNT(*), 0 FROM orders""",
)
def dq_column_exists(t: Tables) -> DataFrame:
    """Each declared column with its presence, the rows checked and the rows that fill it."""
    return Q.column_report(t.orders, ["o_orderkey", "o_orderstatus", "o_comment"])


@query("dq_not_null", f"WITH {PEOPLE_SQL} SELECT 'email not null' AS check_name, COUNT(*) AS checked, COUNT(*) - COUNT(email) AS failed FROM people"
       " UNION ALL SELECT 'customer_id not null', COUNT(*), COUNT(*) - COUNT(customer_id) FROM people")
def dq_not_null(t: Tables) -> DataFrame:
    return Q.broken_rows(people(t), [Q.not_null("email"), Q.not_null("customer_id")])


@query(
    "dq_unique",
    """WITH g AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT 'l_orderkey, l_linenumber unique' AS check_name, CAST(SUM(n) AS BIGINT) AS checked,
    CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS failed FROM g""",
)
def dq_unique(t: Tables) -> DataFrame:
    """The pair repeats in the supplied table, so this check fails on purpose."""
    return Q.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_regex",
    f"""WITH {PEOPLE_SQL} SELECT 'email matches pattern' AS check_name, COUNT(*) AS checked,
    COUNT(*) FILTER (NOT regexp_matches(trim(email), {EMAIL_SQL})) AS failed FROM people""",
)
def dq_regex(t: Tables) -> DataFrame:
    return Q.broken_rows(people(t).withColumn("email", F.trim("email")), [Q.matches("email")])


@query(
    "dq_between",
    f"""WITH {ORDERS_SQL} SELECT 'amount between' AS check_name, COUNT(*) AS checked,
    COUNT(*) FILTER (NOT amount BETWEEN 0 AND 100000) AS failed FROM ord""",
)
def dq_between(t: Tables) -> DataFrame:
    return Q.broken_rows(orders(t), [Q.between("amount", 0, 100000)])


@query(
    "dq_foreign_key",
    """SELECT 'lineitem.l_orderkey in orders' AS check_name, COUNT(*) AS checked,
      COUNT(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS failed,
      COUNT(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0 AS success FROM lineitem
    UNION ALL SELECT 'orders.o_orderkey in lineitem', COUNT(*), COUNT(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)),
      COUNT(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) = 0 FROM orders
    UNION ALL SELECT 'events.user_id in customer', COUNT(*), COUNT(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer)),
      COUNT(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer)) = 0 FROM events""",
)
def dq_foreign_key(t: Tables) -> DataFrame:
    tables = {"lineitem": t.lineitem, "orders": t.orders, "events": t.events, "customer": t.customer}
    return Q.declared_keys(
        tables,
        [
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders", "o_orderkey", "lineitem", "l_orderkey"),
            ("events", "user_id", "customer", "c_custkey"),
        ],
    )


def reference_sql(name: str, column: str, child: str, parent: str, key: str) -> str:
    """Children whose key has no parent."""
    return f"""SELECT '{name}' AS check_name, COUNT({column}) AS checked, COUNT(*) FILTER ({column} NOT IN (SELECT {key} FROM {parent})) AS failed,
      COUNT(*) FILTER ({column} NOT IN (SELECT {key} FROM {parent})) = 0 AS success FROM {child}"""


def unique_sql(name: str, key: str, table: str) -> str:
    """Rows that share their key."""
    return f"""SELECT '{name}' AS check_name, CAST(SUM(n) AS BIGINT) AS checked, CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS failed,
      COALESCE(SUM(n) FILTER (n > 1), 0) = 0 AS success FROM (SELECT {key}, COUNT(*) AS n FROM {table} GROUP BY ALL)"""


@query(
    "key_report",
    " UNION ALL ".join(
        [
            unique_sql("customers.customer_id unique", "c_custkey", "customer"),
            unique_sql("products.product_id unique", "p_partkey", "part"),
            unique_sql("orders.order_id unique", "o_orderkey", "orders"),
            unique_sql("order_items.order_item_id unique", "l_orderkey, l_linenumber", "lineitem"),
            reference_sql("orders.customer_id in customers", "o_custkey", "orders", "customer", "c_custkey"),
            reference_sql("order_items.order_id in orders", "l_orderkey", "lineitem", "orders", "o_orderkey"),
            reference_sql("order_items.product_id in products", "l_partkey", "lineitem", "part", "p_partkey"),
        ]
    ),
)
def key_report(t: Tables) -> DataFrame:
    """The unique keys and references that the source tables declare, on the supplied tables in their roles."""
    text = lambda c: F.col(c).cast("string")
    return schemas.key_report(
        {
            "customers": t.customer.select(text("c_custkey").alias("customer_id")),
            "products": t.part.select(text("p_partkey").alias("product_id")),
            "orders": t.orders.select(text("o_orderkey").alias("order_id"), text("o_custkey").alias("customer_id")),
            "order_items": t.lineitem.select(
                F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("order_item_id"),
                text("l_orderkey").alias("order_id"),
                text("l_partkey").alias("product_id"),
            ),
        }
    )


@query(
    "dq_report_and_gate",
    f"""WITH {ORDERS_SQL}, c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (NOT amount BETWEEN 0 AND 1000000) AS bad, COUNT(DISTINCT order_id) AS d FROM ord)
    SELECT 'order_id not null' AS check_name, n AS checked, CAST(0 AS BIGINT) AS failed, TRUE AS success FROM c
    UNION ALL SELECT 'amount between', n, bad, bad = 0 FROM c UNION ALL SELECT 'order_id unique', n, n - d, n = d FROM c""",
)
def dq_report_and_gate(t: Tables) -> DataFrame:
    """The suite of the order table; all checks pass, so the gate lets the report through."""
    lines = Q.suite(orders(t), "order_id", [Q.between("amount", 0, 1_000_000)], ["amount"])
    Q.gate(lines)
    return lines


KEEP = ["event_id", "sensor_id", "road_id"]


@query(
    "dq_speed_range",
    f"""WITH {SENSORS_SQL} SELECT 'speed_anomaly' AS type, event_id, sensor_id, road_id, CAST(COALESCE(average_speed, 0) AS DOUBLE) AS speed
    FROM readings WHERE COALESCE(average_speed, 0) < 5 OR COALESCE(average_speed, 0) > 120""",
)
def dq_speed_range(t: Tables) -> DataFrame:
    return T.speed_anomalies(readings(t), KEEP)


SCORED_SQL = SENSORS_SQL + """, scored AS (SELECT *, CAST(vehicle_count - 90 AS DOUBLE) * -0.1 - 0.25 AS anomaly_score,
  occupancy * 0.9 + 0.1 AS congestion_probability, CAST(60 AS DOUBLE) AS predicted_traffic FROM readings)"""


def scored_readings(t: Tables) -> DataFrame:
    """Readings with fixed linear scores in place of fitted models."""
    return readings(t).withColumns(
        {
            "anomaly_score": (F.col("vehicle_count") - 90).cast("double") * -0.1 - 0.25,
            "congestion_probability": F.col("occupancy") * 0.9 + 0.1,
            "predicted_traffic": F.lit(60.0),
        }
    )


_KEEP_SQL = "event_id, sensor_id, road_id"
SPEED_SQL = "CAST(COALESCE(average_speed, 0) AS DOUBLE)"


@query("sensor_anomaly_alerts", f"WITH {SCORED_SQL} SELECT 'sensor_anomaly' AS type, {_KEEP_SQL}, anomaly_score FROM scored WHERE anomaly_score < -0.5")
def sensor_anomaly_alerts(t: Tables) -> DataFrame:
    return T.sensor_anomalies(scored_readings(t), KEEP)


@query(
    "high_congestion_alerts",
    f"""WITH {SCORED_SQL} SELECT 'high_congestion' AS type, {_KEEP_SQL}, congestion_probability, {SPEED_SQL} AS current_speed,
    'Consider alternative routes' AS recommendation FROM scored WHERE congestion_probability > 0.8""",
)
def high_congestion_alerts(t: Tables) -> DataFrame:
    return T.high_congestion(scored_readings(t), KEEP)


@query(
    "incident_alerts",
    f"""WITH {SCORED_SQL} SELECT 'potential_incident' AS type, {_KEEP_SQL}, {SPEED_SQL} AS current_speed, predicted_traffic AS predicted_speed,
    CASE WHEN {SPEED_SQL} < 5 THEN 'high' ELSE 'medium' END AS severity FROM scored WHERE {SPEED_SQL} < predicted_traffic * 0.3""",
)
def incident_alerts(t: Tables) -> DataFrame:
    return T.potential_incidents(scored_readings(t), KEEP)


@query(
    "alert_union",
    f"""WITH {SCORED_SQL} SELECT 'sensor_anomaly' AS type, {_KEEP_SQL}, anomaly_score, CAST(NULL AS DOUBLE) AS speed,
      CAST(NULL AS DOUBLE) AS congestion_probability, CAST(NULL AS DOUBLE) AS current_speed, CAST(NULL AS VARCHAR) AS recommendation FROM scored WHERE anomaly_score < -0.5
    UNION ALL SELECT 'speed_anomaly', {_KEEP_SQL}, NULL, {SPEED_SQL}, NULL, NULL, NULL FROM scored WHERE {SPEED_SQL} < 5 OR {SPEED_SQL} > 120
    UNION ALL SELECT 'high_congestion', {_KEEP_SQL}, NULL, NULL, congestion_probability, {SPEED_SQL}, 'Consider alternative routes' FROM scored WHERE congestion_probability > 0.8""",
)
def alert_union(t: Tables) -> DataFrame:
    rows = scored_readings(t)
    return T.all_alerts([T.sensor_anomalies(rows, KEEP), T.speed_anomalies(rows, KEEP), T.high_congestion(rows, KEEP)])


@query(
    "column_bind",
    """SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS is_open, CAST(o_orderstatus = 'P' AS INTEGER) AS is_partial FROM orders""",
)
def column_bind(t: Tables) -> DataFrame:
    """Encoded columns are added to their own row; nothing is matched by position."""
    status = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", "o_orderstatus").withColumns(
        {"is_open": (status == "O").cast("int"), "is_partial": (status == "P").cast("int")}
    ).drop("o_orderstatus")
