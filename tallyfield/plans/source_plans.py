"""Source and sink queries: each writes whole tables to the work folder and reads them back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.dates import whole_day
from tallyfield.functions.numbers import cents
from tallyfield.functions.text import full_name
from tallyfield.operators import customers as C
from tallyfield.operators.frames import stage_customers
from tallyfield.plans.bindings import AS_OF, ORDERS_SQL, PEOPLE_SQL, RUN_DAY, SENSORS_SQL, orders, people, readings
from tallyfield.plans.registry import Tables, query
from tallyfield.session import work_folder
from tallyfield.sources import lake
from tallyfield.sources.messages import as_messages, latest_state
from tallyfield.sources.warehouse import Warehouse

MONTH = "1998-06-01"


def warehouse(t: Tables) -> Warehouse:
    root = work_folder(t.spark, "warehouse")
    return Warehouse(t.spark, root, "tf_" + root.rsplit("-", 1)[1][:12] + "_")


def monthly_orders(t: Tables) -> DataFrame:
    return orders(t).withColumn("date", F.trunc("order_date", "month"))


@query(
    "scan_partition",
    f"WITH {ORDERS_SQL} SELECT order_id, customer_id, amount, CAST(date_trunc('month', order_date) AS DATE) AS date"
    f" FROM ord WHERE date_trunc('month', order_date) = DATE '{MONTH}'",
)
def scan_partition(t: Tables) -> DataFrame:
    base = work_folder(t.spark, "orders")
    lake.write_partition(monthly_orders(t), base)
    return lake.scan_partition(t.spark, base, MONTH).select("order_id", "customer_id", "amount", "date")


@query(
    "write_partition",
    f"""WITH {ORDERS_SQL} SELECT CAST(date_trunc('month', order_date) AS DATE) AS date, COUNT(*) AS n,
    CAST(SUM(CAST(CASE WHEN date_trunc('month', order_date) = DATE '{MONTH}' THEN 0 ELSE amount END AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM ord GROUP BY 1""",
)
def write_partition(t: Tables) -> DataFrame:
    """All months are written, then one is replaced; the others must not change."""
    base = work_folder(t.spark, "orders")
    rows = monthly_orders(t)
    lake.write_partition(rows, base)
    lake.write_partition(rows.where(F.col("date") == F.lit(MONTH).cast("date")).withColumn("amount", F.lit(0.0)), base)
    return t.spark.read.parquet(base).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(cents("amount")) / F.lit(100.0)).alias("amount")
    )


@query(
    "copy_into",
    f"WITH {ORDERS_SQL} SELECT status, COUNT(*) AS n, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM ord GROUP BY 1",
)
def copy_into(t: Tables) -> DataFrame:
    """The folder is copied twice; the second run finds nothing new."""
    folder = work_folder(t.spark, "incoming")
    orders(t).write.parquet(folder)
    w = warehouse(t)
    w.copy_into("staging", "stg_orders", folder)
    w.copy_into("staging", "stg_orders", folder)
    return w.table("staging", "stg_orders").groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(cents("amount")) / F.lit(100.0)).alias("amount")
    )


@query(
    "warehouse_read",
    f"WITH {ORDERS_SQL} SELECT priority, COUNT(*) AS orders, MAX(order_date) AS last_order FROM ord WHERE status = 'F' GROUP BY 1",
)
def warehouse_read(t: Tables) -> DataFrame:
    w = warehouse(t)
    w.replace("raw", "orders", orders(t))
    return w.read(
        "SELECT priority, COUNT(*) AS orders, MAX(order_date) AS last_order FROM {raw}.orders WHERE status = 'F' GROUP BY priority"
    )


@query(
    "insert_select",
    f"""WITH {ORDERS_SQL} SELECT order_date AS report_date, COUNT(*) AS total_orders,
    CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM ord
    WHERE order_date IN (DATE '{RUN_DAY}', DATE '{RUN_DAY}' + 1) GROUP BY 1""",
)
def insert_select(t: Tables) -> DataFrame:
    """Two daily runs append one row each to the mart; each is run again and adds nothing."""
    w = warehouse(t)
    w.replace("staging", "stg_orders", orders(t))
    source = w.table("staging", "stg_orders")
    daily = source.groupBy(F.col("order_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("total_orders"), (F.sum(cents("amount")) / F.lit(100.0)).alias("total_revenue")
    )
    w.create("mart", "dm_executive_kpis", daily.schema)
    first = dt.date.fromisoformat(RUN_DAY)
    for day in 2 * (first, first + dt.timedelta(days=1)):
        w.insert_select("mart", "dm_executive_kpis", daily.where(F.col("report_date") == F.lit(day)), day.isoformat())
    return w.table("mart", "dm_executive_kpis")


STAGED_SQL = ORDERS_SQL + ", " + PEOPLE_SQL + """, staged AS (
  SELECT customer_id, trim(upper(first_name)) AS first_name, trim(upper(last_name)) AS last_name,
         lower(trim(email)) AS email,
         CASE WHEN upper(gender) IN ('M', 'MALE') THEN 'Male' WHEN upper(gender) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Other' END AS gender,
         date_of_birth, nation_key, balance, CAST(date_diff('year', date_of_birth, DATE '2001-08-02') AS INTEGER) AS age,
         CASE WHEN date_diff('year', date_of_birth, DATE '2001-08-02') < 25 THEN 'Gen Z'
              WHEN date_diff('year', date_of_birth, DATE '2001-08-02') < 40 THEN 'Millennial'
              WHEN date_diff('year', date_of_birth, DATE '2001-08-02') < 55 THEN 'Gen X' ELSE 'Baby Boomer' END AS generation
  FROM people WHERE email IS NOT NULL AND email LIKE '%@%')"""


@query("ctas_replace", f"WITH {STAGED_SQL} SELECT * FROM staged")
def ctas_replace(t: Tables) -> DataFrame:
    """The staging table is built twice; the second build replaces the first."""
    w = warehouse(t)
    w.replace("staging", "stg_customers", people(t))
    w.replace("staging", "stg_customers", stage_customers(people(t), AS_OF))
    return w.table("staging", "stg_customers")


@query(
    "view_customer_360",
    f"""WITH {STAGED_SQL} SELECT generation, COUNT(*) AS customers, CAST(SUM(n) AS BIGINT) AS orders, MAX(last_day) AS last_order_date
    FROM staged LEFT JOIN (SELECT customer_id, COUNT(*) AS n, MAX(order_date) AS last_day FROM ord GROUP BY 1) USING (customer_id)
    GROUP BY 1""",
)
def view_customer_360(t: Tables) -> DataFrame:
    w = warehouse(t)
    name = f"vw_customer_360_{uuid.uuid4().hex}"  # views are shared by all queries of a session
    w.view(name, C.customer_360(stage_customers(people(t), AS_OF), orders(t), AS_OF))
    return t.spark.sql(
        "SELECT generation, COUNT(*) AS customers, SUM(total_orders) AS orders, MAX(last_order_date) AS last_order_date"
        f" FROM {name} GROUP BY generation"
    )


@query(
    "alert_sink",
    f"""WITH {SENSORS_SQL} SELECT 'traffic-alerts' AS topic, sensor_id AS key, sensor_id, road_id,
    CAST(COALESCE(average_speed, 0) AS DOUBLE) AS speed FROM readings
    WHERE COALESCE(average_speed, 0) < 5 OR COALESCE(average_speed, 0) > 120""",
)
def alert_sink(t: Tables) -> DataFrame:
    """Alert records go through their JSON form and are read back."""
    speed = F.coalesce("average_speed", F.lit(0.0))
    alerts = readings(t).where((speed < 5) | (speed > 120)).select("sensor_id", "road_id", speed.alias("speed"))
    fields = F.from_json("value", "sensor_id string, road_id string, speed double")
    return as_messages(alerts, "traffic-alerts", "sensor_id").select("topic", "key", fields.alias("f")).select(
        "topic", "key", "f.*"
    )


@query(
    "latest_state_ttl",
    f"""WITH {SENSORS_SQL}, newest AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS r FROM readings)
    SELECT 'traffic:real_time:' || sensor_id AS key, average_speed, vehicle_count, ts AS updated_at,
           ts + INTERVAL 10 HOURS AS expires_at
    FROM newest WHERE r = 1 AND ts + INTERVAL 10 HOURS > TIMESTAMP '2024-01-30 00:00:00'""",
)
def latest_state_ttl(t: Tables) -> DataFrame:
    """Readings are sparse here, so the query keeps a state for ten hours."""
    return latest_state(
        readings(t), F.concat(F.lit("traffic:real_time:"), F.col("sensor_id")), "ts", "event_id",
        ["average_speed", "vehicle_count"], "INTERVAL 10 HOURS", F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"),
    )


@query("table_bundle_export", f"""WITH {ORDERS_SQL} SELECT 'by_status' AS sheet, status AS name, COUNT(*) AS n FROM ord GROUP BY 2
    UNION ALL SELECT 'by_priority', priority, COUNT(*) FROM ord GROUP BY 2""")
def table_bundle_export(t: Tables) -> DataFrame:
    def sheet(column: str) -> DataFrame:
        return orders(t).groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n"))

    paths = lake.export_bundle(
        {"by_status": sheet("status"), "by_priority": sheet("priority")}, work_folder(t.spark, "bundle")
    )
    back = lake.read_bundle(t.spark, paths)
    named = [df.select(F.lit(name).alias("sheet"), "name", "n") for name, df in back.items()]
    return named[0].unionByName(named[1])


@query(
    "csv_sink",
    f"WITH {ORDERS_SQL} SELECT priority, status, COUNT(*) AS n FROM ord GROUP BY ALL",
)
def csv_sink(t: Tables) -> DataFrame:
    folder = work_folder(t.spark, "csv")
    counts = orders(t).groupBy("priority", "status").agg(F.count(F.lit(1)).alias("n"))
    lake.write_csv(counts, folder)
    return t.spark.read.schema(counts.schema).option("header", True).csv(folder)


@query(
    "lineage_columns",
    f"SELECT o_orderkey, 'orders.parquet' AS source_file, DATE '{RUN_DAY}' AS run_date, 'batch-1' AS batch_id FROM orders",
)
def lineage_columns(t: Tables) -> DataFrame:
    return lake.with_lineage(t.orders, RUN_DAY, "batch-1").select("o_orderkey", "source_file", "run_date", "batch_id")


@query(
    "completed_filter",
    f"WITH {ORDERS_SQL} SELECT * FROM ord WHERE status = 'F' AND order_date = DATE '{RUN_DAY}'",
)
def completed_filter(t: Tables) -> DataFrame:
    """Status and day are ranges on raw columns, so both reach the scan."""
    day = t.orders.where((F.col("o_orderstatus") == "F") & whole_day("o_orderdate", RUN_DAY))
    return day.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


@query("full_name", f"WITH {PEOPLE_SQL} SELECT customer_id, first_name || ' ' || last_name AS full_name FROM people")
def full_name_query(t: Tables) -> DataFrame:
    return people(t).select("customer_id", full_name("first_name", "last_name").alias("full_name"))
