"""How the supplied tables play the roles the operators name.

Every binding exists twice: as a DataFrame and as a SQL common table expression for the
oracle. Both derive their rows from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.numbers import cents
from tallyfield.plans.registry import Tables

AS_OF = "2001-08-02"
RUN_DAY = "1998-06-15"
COMPLETED = "F"

ORDERS_SQL = """ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_totalprice AS amount, o_orderstatus AS status, o_orderpriority AS priority
  FROM orders)"""

DONE_SQL = ORDERS_SQL + ", done AS (SELECT * FROM ord WHERE status = 'F')"


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


PEOPLE_SQL = """people AS (
  SELECT c_custkey AS customer_id,
         ' ' || split_part(c_name, '#', 1) || ' ' AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 7 THEN 'not given'
              ELSE ' ' || split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', 2) || '@' || c_mktsegment || '.example.com'
         END AS email,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'm' WHEN 'AUTOMOBILE' THEN 'Female'
              WHEN 'MACHINERY' THEN 'MALE' WHEN 'HOUSEHOLD' THEN 'f' END AS gender,
         CASE WHEN c_nationkey = 5 THEN NULL
              ELSE CAST(DATE '1925-01-01' + CAST((c_custkey * 37) % 29000 AS INTEGER) AS DATE) END AS date_of_birth,
         c_nationkey AS nation_key, c_acctbal AS balance
  FROM customer)"""


def people(t: Tables) -> DataFrame:
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    last = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    address = F.concat(F.lit(" "), first, F.lit("."), last, F.lit("@"), F.col("c_mktsegment"), F.lit(".example.com"))
    segment = F.col("c_mktsegment")
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), first, F.lit(" ")).alias("first_name"),
        last.alias("last_name"),
        F.when(F.col("c_nationkey") == 3, F.lit(None).cast("string"))
        .when(F.col("c_nationkey") == 7, "not given")
        .otherwise(address)
        .alias("email"),
        F.when(segment == "BUILDING", "m")
        .when(segment == "AUTOMOBILE", "Female")
        .when(segment == "MACHINERY", "MALE")
        .when(segment == "HOUSEHOLD", "f")
        .alias("gender"),
        F.when(
            F.col("c_nationkey") != 5,
            F.date_add(F.lit("1925-01-01").cast("date"), ((F.col("c_custkey") * 37) % 29000).cast("int")),
        ).alias("date_of_birth"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("balance"),
    )


LINES_SQL = """line AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id, l_quantity AS quantity,
         l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS return_flag,
         CAST(l_shipdate AS DATE) AS ship_date, l_linenumber AS line_number
  FROM lineitem)"""


def lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_linenumber").alias("line_number"),
    )


# One row per order: stay, flags, labs, vitals and drug counts derived from its lines.
CLINIC_SQL = (
    ORDERS_SQL
    + ", "
    + PEOPLE_SQL
    + """, per_order AS (
  SELECT l_orderkey AS admission_id, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS q,
         CAST(MAX(l_quantity) AS BIGINT) AS q_max, CAST(SUM(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS d,
         CAST(SUM(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS x,
         CAST(COUNT(*) FILTER (l_returnflag = 'R') AS BIGINT) AS r,
         CAST(COUNT(*) FILTER (l_returnflag = 'A') AS BIGINT) AS a,
         CAST(COUNT(*) FILTER (l_linestatus = 'F') AS BIGINT) AS f,
         CAST(MAX(l_linenumber) AS BIGINT) AS k
  FROM lineitem GROUP BY l_orderkey),
adm AS (
  SELECT o.customer_id AS patient_id, o.order_id AS admission_id, o.order_date AS admission_date,
         CAST(COALESCE(n, 0) AS INTEGER) AS length_of_stay,
         CAST(o.order_date + CAST(COALESCE(n, 0) AS INTEGER) AS DATE) AS discharge_date,
         CASE priority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'Urgent' WHEN '3-MEDIUM' THEN 'Elective Surgery'
              WHEN '5-LOW' THEN NULL ELSE 'Transfer' END AS admission_type,
         CASE priority WHEN '1-URGENT' THEN 'Extreme' WHEN '2-HIGH' THEN 'Major' WHEN '3-MEDIUM' THEN 'Moderate'
              WHEN '5-LOW' THEN 'Minor' ELSE 'Unknown' END AS severity_of_illness,
         amount
  FROM ord o LEFT JOIN per_order p ON o.order_id = p.admission_id)"""
)


def per_order(t: Tables) -> DataFrame:
    hundredths = lambda c: F.sum(cents(c))
    return t.lineitem.groupBy(F.col("l_orderkey").alias("admission_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.max(F.col("l_quantity").cast("bigint")).alias("q_max"),
        hundredths("l_discount").alias("d"),
        hundredths("l_tax").alias("x"),
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count_if(F.col("l_returnflag") == "A").alias("a"),
        F.count_if(F.col("l_linestatus") == "F").alias("f"),
        F.max(F.col("l_linenumber").cast("bigint")).alias("k"),
    )


def admissions(t: Tables, per_line: DataFrame | None = None) -> DataFrame:
    """Orders as admissions; the stay is the number of lines.

    ``per_line`` is ``per_order`` for callers that need its columns as well: they are kept, and
    the lines are aggregated once.
    """
    stay = F.coalesce(F.col("n"), F.lit(0)).cast("int")
    p = F.col("priority")
    if per_line is None:
        counts, kept = t.lineitem.groupBy(F.col("l_orderkey").alias("_order")).agg(F.count(F.lit(1)).alias("n")), []
    else:
        counts, kept = per_line.withColumnRenamed("admission_id", "_order"), [c for c in per_line.columns if c != "admission_id"]
    return (
        orders(t)
        .join(counts, F.col("order_id") == F.col("_order"), "left")
        .select(
            F.col("customer_id").alias("patient_id"),
            F.col("order_id").alias("admission_id"),
            F.col("order_date").alias("admission_date"),
            stay.alias("length_of_stay"),
            F.date_add("order_date", stay).alias("discharge_date"),
            F.when(p == "1-URGENT", "Emergency")
            .when(p == "2-HIGH", "Urgent")
            .when(p == "3-MEDIUM", "Elective Surgery")
            .when(p == "5-LOW", F.lit(None).cast("string"))
            .otherwise("Transfer")
            .alias("admission_type"),
            F.when(p == "1-URGENT", "Extreme")
            .when(p == "2-HIGH", "Major")
            .when(p == "3-MEDIUM", "Moderate")
            .when(p == "5-LOW", "Minor")
            .otherwise("Unknown")
            .alias("severity_of_illness"),
            "amount",
            *kept,
        )
    )


# Events as sensor readings: one road per event type, one sensor per user.
SENSORS_SQL = """readings AS (
  SELECT event_id, 'S' || CAST(user_id AS VARCHAR) AS sensor_id, ts, event_type AS road_id,
         'L' || CAST(user_id % 4 AS VARCHAR) AS lane_id,
         CASE WHEN event_type = 'signup' AND k % 10 = 9 THEN NULL ELSE CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 400.0 END AS average_speed,
         CAST(k AS INTEGER) AS vehicle_count, CAST(k % 20 AS DOUBLE) / 20.0 AS occupancy,
         CAST(k % 13 AS DOUBLE) AS queue_length
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))"""


def readings(t: Tables) -> DataFrame:
    k = F.from_json("props", "k int").getField("k")
    return t.events.withColumn("k", k).select(
        "event_id",
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("sensor_id"),
        "ts",
        F.col("event_type").alias("road_id"),
        F.concat(F.lit("L"), (F.col("user_id") % 4).cast("string")).alias("lane_id"),
        F.when(
            ~((F.col("event_type") == "signup") & (F.col("k") % 10 == 9)), cents("value") / F.lit(400.0)
        ).alias("average_speed"),
        F.col("k").alias("vehicle_count"),
        ((F.col("k") % 20).cast("double") / 20.0).alias("occupancy"),
        (F.col("k") % 13).cast("double").alias("queue_length"),
    )


# The same readings as JSON messages; error events are cut short to stand for bad input.
def messages(t: Tables) -> DataFrame:
    r = readings(t)
    location = F.struct(
        (F.length("road_id") / F.lit(10.0)).alias("latitude"),
        (F.length("sensor_id") / F.lit(10.0)).alias("longitude"),
        "road_id",
        "lane_id",
    )
    body = F.to_json(
        F.struct(
            "sensor_id",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            location.alias("location"),
            F.struct("vehicle_count", "average_speed", "occupancy", "queue_length").alias("measurements"),
            F.create_map(
                F.lit("car"), F.col("vehicle_count"), F.lit("truck"), (F.col("vehicle_count") % 7).cast("int")
            ).alias("vehicle_classification"),
            F.struct((F.col("vehicle_count") / F.lit(4.0)).alias("temperature")).alias("weather_conditions"),
        )
    )
    broken = (F.col("road_id") == "error") & (F.col("vehicle_count") % 5 == 0)
    return r.select(
        "event_id", "ts", F.when(broken, F.substring(body, 1, 20)).otherwise(body).alias("value")
    )
