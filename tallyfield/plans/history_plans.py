"""Joins, windows and admission-history queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import clinical as K
from tallyfield.functions.numbers import cents, money_sum, rounded
from tallyfield.operators import admissions as A
from tallyfield.operators import cohorts as H
from tallyfield.operators import joins as J
from tallyfield.operators import places as P
from tallyfield.operators.timeline import interval_totals
from tallyfield.plans.bindings import (
    AS_OF, CLINIC_SQL, DONE_SQL, LINES_SQL, ORDERS_SQL, PEOPLE_SQL, SENSORS_SQL, admissions, lines, orders, people,
    per_order, readings,
)
from tallyfield.plans.customer_plans import METRICS_SQL, completed
from tallyfield.plans.registry import Tables, query
from tallyfield.operators import customers as C

START, END = "1996-01-01", "2000-12-31"


@query(
    "left_join_agg",
    f"""WITH {DONE_SQL}, {PEOPLE_SQL} SELECT p.customer_id, p.nation_key, COUNT(o.order_id) AS total_orders,
    CAST(SUM(CAST(o.amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
    FROM people p LEFT JOIN done o ON p.customer_id = o.customer_id GROUP BY 1, 2""",
)
def left_join_agg(t: Tables) -> DataFrame:
    """Customers without completed orders stay with count 0."""
    totals = completed(t).groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), money_sum("amount").alias("total_spent")
    )
    joined = people(t).select("customer_id", "nation_key").join(totals, "customer_id", "left")
    return joined.withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))


@query(
    "left_join_collapsed",
    f"""WITH {ORDERS_SQL}, {PEOPLE_SQL} SELECT p.customer_id, COUNT(o.order_id) AS total_orders
    FROM people p LEFT JOIN ord o ON p.customer_id = o.customer_id WHERE o.status = 'F' GROUP BY 1 HAVING COUNT(o.order_id) > 0""",
)
def left_join_collapsed(t: Tables) -> DataFrame:
    """A filter on the right side turns the left join into an inner join."""
    totals = completed(t).groupBy("customer_id").agg(F.count("order_id").alias("total_orders"))
    return people(t).select("customer_id").join(totals, "customer_id", "inner")


@query(
    "inner_equi_join",
    f"""WITH {METRICS_SQL} SELECT o.order_id, m.customer_id, o.amount, m.total_orders, m.total_spent
    FROM ord o JOIN metrics m ON o.customer_id = m.customer_id""",
)
def inner_equi_join(t: Tables) -> DataFrame:
    metrics = C.customer_metrics(orders(t), AS_OF).select("customer_id", "total_orders", "total_spent")
    return orders(t).select("order_id", "customer_id", "amount").join(metrics, "customer_id")


@query(
    "star_left_joins",
    f"""WITH {CLINIC_SQL}, labs AS (SELECT admission_id, round_even(q / CAST(n AS DOUBLE) / 2, 6) AS hemoglobin FROM per_order),
    vitals AS (SELECT admission_id, 80 + q_max AS avg_systolic_bp FROM per_order WHERE n > 1),
    drugs AS (SELECT admission_id, n * 2 AS total_medications FROM per_order WHERE n > 2),
    cond AS (SELECT admission_id, r AS charlson_comorbidity_index FROM per_order WHERE r > 0),
    used AS (SELECT patient_id, COUNT(*) AS total_admissions FROM adm GROUP BY 1),
    social AS (SELECT customer_id AS patient_id, CAST(balance < 0 AS INTEGER) AS financial_hardship FROM people),
    again AS (SELECT admission_id, lead(admission_date) OVER (PARTITION BY patient_id ORDER BY admission_date, admission_id) AS readmission_date FROM adm)
    SELECT a.admission_id, a.patient_id, a.length_of_stay, hemoglobin, avg_systolic_bp, total_medications, charlson_comorbidity_index,
    total_admissions, financial_hardship, readmission_date
    FROM adm a LEFT JOIN labs USING (admission_id) LEFT JOIN vitals USING (admission_id) LEFT JOIN drugs USING (admission_id)
    LEFT JOIN cond USING (admission_id) LEFT JOIN used USING (patient_id) LEFT JOIN social USING (patient_id) LEFT JOIN again USING (admission_id)""",
)
def star_left_joins(t: Tables) -> DataFrame:
    """Labs, vitals, drugs and conditions are columns of one aggregate of the lines, so they join as one."""
    n = F.col("n")
    facts = admissions(t, per_order(t)).select(
        "admission_id", "patient_id", "length_of_stay",
        rounded(F.col("q") / n.cast("double") / 2, 6).alias("hemoglobin"),
        F.when(n > 1, 80 + F.col("q_max")).alias("avg_systolic_bp"),
        F.when(n > 2, n * 2).alias("total_medications"),
        F.when(F.col("r") > 0, F.col("r")).alias("charlson_comorbidity_index"),
    )
    used = orders(t).groupBy(F.col("customer_id").alias("patient_id")).agg(F.count(F.lit(1)).alias("total_admissions"))
    social = people(t).select(
        F.col("customer_id").alias("patient_id"), (F.col("balance") < 0).cast("int").alias("financial_hardship")
    )
    dates = orders(t).select(F.col("customer_id").alias("patient_id"), F.col("order_id").alias("admission_id"), F.col("order_date").alias("admission_date"))
    again = A.next_event_gap(dates)
    return J.star_join(
        facts,
        [
            ("utilisation", used, "patient_id"),
            ("social", social, "patient_id"),
            ("readmissions", again.select("admission_id", "readmission_date"), "admission_id"),
        ],
    )


@query(
    "admission_filter",
    f"""WITH {CLINIC_SQL} SELECT admission_id, patient_id, discharge_date, length_of_stay,
    CAST(2001 - year(date_of_birth) AS INTEGER) AS age FROM adm JOIN people ON patient_id = customer_id
    WHERE discharge_date BETWEEN DATE '{START}' AND DATE '{END}' AND admission_type != 'Elective Surgery'
    AND length_of_stay >= 1 AND 2001 - year(date_of_birth) >= 18""",
)
def admission_filter(t: Tables) -> DataFrame:
    ages = people(t).select(
        F.col("customer_id").alias("patient_id"), (F.lit(2001) - F.year("date_of_birth")).alias("age")
    )
    return A.eligible(admissions(t).join(ages, "patient_id"), START, END, "age").select(
        "admission_id", "patient_id", "discharge_date", "length_of_stay", "age"
    )


NEXT_SQL = CLINIC_SQL + """, gaps AS (SELECT *, lead(admission_date) OVER (PARTITION BY patient_id ORDER BY admission_date, admission_id) AS readmission_date FROM adm),
labelled AS (SELECT *, CASE WHEN readmission_date IS NOT NULL AND readmission_date <= discharge_date + INTERVAL 30 DAY THEN 1 ELSE 0 END AS readmitted_30d FROM gaps)"""


@query(
    "next_event_gap",
    f"""WITH {NEXT_SQL} SELECT admission_id, patient_id, admission_date, readmission_date,
    CAST(readmission_date - admission_date AS INTEGER) AS days_to_readmission FROM gaps""",
)
def next_event_gap(t: Tables) -> DataFrame:
    return A.next_event_gap(admissions(t).select("admission_id", "patient_id", "admission_date"))


def labelled_stays(t: Tables) -> DataFrame:
    return A.next_event_gap(admissions(t)).withColumn(
        "readmitted_30d", K.readmitted_within("readmission_date", "discharge_date", 30)
    )


@query("readmit_label", f"WITH {NEXT_SQL} SELECT admission_id, discharge_date, readmission_date, readmitted_30d FROM labelled")
def readmit_label(t: Tables) -> DataFrame:
    return labelled_stays(t).select("admission_id", "discharge_date", "readmission_date", "readmitted_30d")


@query("event_rate", f"WITH {NEXT_SQL} SELECT COUNT(*) AS n, round_even(AVG(readmitted_30d), 6) AS rate FROM labelled")
def event_rate(t: Tables) -> DataFrame:
    return labelled_stays(t).agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("readmitted_30d"), 6).alias("rate"))


@query(
    "trailing_counts",
    f"""WITH {ORDERS_SQL}, d AS (SELECT customer_id AS patient_id, order_date AS day, COUNT(*) AS n FROM ord GROUP BY 1, 2)
    SELECT patient_id, day,
    CAST(COALESCE(SUM(n) OVER (w RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS BIGINT) AS previous_30d,
    CAST(COALESCE(SUM(n) OVER (w RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS BIGINT) AS previous_90d,
    CAST(COALESCE(SUM(n) OVER (w RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS BIGINT) AS previous_365d,
    CAST(COALESCE(SUM(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS total_previous
    FROM d WINDOW w AS (PARTITION BY patient_id ORDER BY day)""".replace("OVER (w ", "OVER (PARTITION BY patient_id ORDER BY day ").replace(" WINDOW w AS (PARTITION BY patient_id ORDER BY day)", ""),
)
def trailing_counts(t: Tables) -> DataFrame:
    events = orders(t).select(F.col("customer_id").alias("patient_id"), F.col("order_date").alias("day"))
    return A.trailing_counts(events, [30, 90, 365], "patient_id", "day")


@query(
    "latest_before",
    f"""WITH {SENSORS_SQL}, lab AS (SELECT * FROM readings WHERE road_id <> 'purchase'),
    mark AS (SELECT event_id AS visit_id, sensor_id, ts AS discharged FROM readings WHERE road_id = 'purchase')
    SELECT m.sensor_id, m.visit_id, m.discharged, l.average_speed AS lab_value, l.vehicle_count AS lab_count
    FROM mark m LEFT JOIN LATERAL (SELECT average_speed, vehicle_count FROM lab WHERE lab.sensor_id = m.sensor_id AND lab.ts <= m.discharged
      ORDER BY ts DESC, event_id DESC LIMIT 1) l ON TRUE""",
)
def latest_before(t: Tables) -> DataFrame:
    rows = readings(t)
    marks = rows.where(F.col("road_id") == "purchase").select(
        F.col("event_id").alias("visit_id"), "sensor_id", F.col("ts").alias("discharged")
    )
    return J.latest_before(
        rows.where(F.col("road_id") != "purchase"), marks, "sensor_id", "ts", "event_id", "discharged", "visit_id",
        {"lab_value": "average_speed", "lab_count": "vehicle_count"},
    )


STAY_SQL = SENSORS_SQL + """, stay AS (SELECT event_id AS incident_id, sensor_id, ts AS started, ts + INTERVAL 12 HOUR AS ended
  FROM readings WHERE road_id = 'error')"""


@query(
    "mean_during_stay",
    f"""WITH {STAY_SQL} SELECT s.sensor_id, s.incident_id, COUNT(r.average_speed) AS n,
    round_even(CAST(SUM(CAST(round(r.average_speed * 400) AS BIGINT)) AS DOUBLE) / 400.0 / nullif(COUNT(r.average_speed), 0), 6) AS mean_value
    FROM stay s LEFT JOIN readings r ON r.sensor_id = s.sensor_id AND r.ts BETWEEN s.started AND s.ended GROUP BY 1, 2""",
)
def mean_during_stay(t: Tables) -> DataFrame:
    """Mean vital sign within each stay, by running totals at its two ends."""
    totals = interval_totals(
        readings(t), stays(t), "sensor_id", "ts", "started", "ended", "incident_id",
        {"n": F.col("average_speed").isNotNull().cast("bigint"),
         "v": F.coalesce(F.rint(F.col("average_speed") * 400), F.lit(0.0))},
    )
    mean = F.try_divide(F.col("v") / F.lit(400.0), F.col("n").cast("double"))
    return totals.select("sensor_id", "incident_id", "n", rounded(mean, 6).alias("mean_value"))


def stays(t: Tables) -> DataFrame:
    return readings(t).where(F.col("road_id") == "error").select(
        F.col("event_id").alias("incident_id"), "sensor_id", F.col("ts").alias("started"),
        (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("ended"),
    )


@query(
    "interval_join",
    f"""WITH {STAY_SQL} SELECT s.sensor_id, s.incident_id, COUNT(r.event_id) AS readings_count,
    CAST(COALESCE(SUM(r.vehicle_count), 0) AS BIGINT) AS vehicles
    FROM stay s LEFT JOIN readings r ON r.sensor_id = s.sensor_id AND r.ts BETWEEN s.started AND s.ended GROUP BY 1, 2""",
)
def interval_join(t: Tables) -> DataFrame:
    """Readings of the sensor inside [incident start, start + duration]."""
    return interval_totals(
        readings(t), stays(t), "sensor_id", "ts", "started", "ended", "incident_id",
        {"readings_count": F.lit(1), "vehicles": F.col("vehicle_count")},
    )


# Users lie along a line with two cells to three users; a supplier is the route through the cell
# of its key and ends in the next one. So cells grow with the tables and hold two routes at most.
# Suppliers of every eighth nation are not on the network: their cells may be without a route.
def impact_sql(on_network: str) -> str:
    return f"""route AS (SELECT 'R' || CAST(s_suppkey AS VARCHAR) AS route_id, 'R' || CAST(s_suppkey + 1 AS VARCHAR) AS alternative_routes,
  unnest([s_suppkey, s_suppkey + 1]) AS cell FROM supplier WHERE {on_network}),
incident AS (SELECT event_id, user_id * 2 // 3 AS cell, CAST(floor(value) AS INTEGER) AS duration FROM events WHERE event_type = 'error'),
impact AS (SELECT CASE WHEN route_id IS NULL THEN 'no_route' ELSE 'route_diversion' END AS type, event_id AS incident_id,
  route_id AS affected_route, alternative_routes, duration AS estimated_delay FROM incident LEFT JOIN route USING (cell))"""


IMPACT_SQL, ALL_IMPACT_SQL = impact_sql("s_nationkey % 8 <> 0"), impact_sql("TRUE")


def route_segments(suppliers: DataFrame) -> DataFrame:
    """Route segments from suppliers, one row for each cell that a route touches."""
    key = F.col("s_suppkey")
    return suppliers.select(
        F.concat(F.lit("R"), key.cast("string")).alias("route_id"),
        F.concat(F.lit("R"), (key + 1).cast("string")).alias("alternative_routes"),
        F.explode(F.array(key, key + 1)).alias("cell"),
    )


def route_table(t: Tables) -> DataFrame:
    """The routes of the suppliers on the network."""
    return route_segments(t.supplier.where(F.col("s_nationkey") % 8 != 0))


def incidents(events: DataFrame) -> DataFrame:
    """Error events as incidents in their grid cells; works on streams as well."""
    return events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("incident_id"), F.expr("user_id * 2 div 3").alias("cell"), F.floor("value").cast("int").alias("estimated_duration")
    )


@query("incident_impact_join", f"WITH {IMPACT_SQL} SELECT * FROM impact")
def incident_impact_join(t: Tables) -> DataFrame:
    """Each incident with the routes of its grid cell, or once without a route."""
    return J.incident_impact(incidents(t.events), route_table(t), "cell")


@query("incident_impact_all_routes", f"WITH {ALL_IMPACT_SQL} SELECT * FROM impact")
def incident_impact_all_routes(t: Tables) -> DataFrame:
    """As ``incident_impact_join``, with every supplier as a route."""
    return J.incident_impact(incidents(t.events), route_segments(t.supplier), "cell")


# The same users and suppliers on the globe: along circles of latitude a twentieth of a degree for each cell, so that
# density does not change with size. A route is in service for ten days of the month.
PLACES_SQL = """incident AS (SELECT event_id AS incident_id, CAST(floor(value) AS INTEGER) AS duration, ts AS started,
    CAST(ts + to_minutes(CAST(floor(value) AS BIGINT)) AS TIMESTAMP) AS ended,
    40 + 0.2 * (user_id // 10800) + 0.01 * (user_id % 7) AS lat, (user_id / 30 + 60) % 360 - 180 AS lon FROM events WHERE event_type = 'error'),
route AS (SELECT 'R' || CAST(s_suppkey AS VARCHAR) AS route_id, 'R' || CAST(s_suppkey + 1 AS VARCHAR) AS alternative_routes,
    40 + 0.2 * (s_suppkey // 7200) AS lat, (s_suppkey / 20 + 60) % 360 - 180 AS lon,
    TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey * 7 % 30 AS INTEGER)) AS started, TIMESTAMP '2024-01-11' + to_days(CAST(s_suppkey * 7 % 30 AS INTEGER)) AS ended FROM supplier),
near AS (SELECT incident_id, route_id, alternative_routes, 2 * 6371.0 * asin(sqrt(pow(sin(radians(r.lat - i.lat) / 2), 2)
    + cos(radians(i.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - i.lon) / 2), 2))) AS distance_km
  FROM incident i JOIN route r ON i.started <= r.ended AND r.started <= i.ended),
affected AS (SELECT CASE WHEN route_id IS NULL THEN 'no_route' ELSE 'route_diversion' END AS type, incident_id, route_id AS affected_route,
    alternative_routes, duration AS estimated_delay, round_even(distance_km, 6) AS distance_km
  FROM incident LEFT JOIN (SELECT * FROM near WHERE distance_km <= 8) USING (incident_id))"""


def placed_incidents(events: DataFrame) -> DataFrame:
    """Error events as incidents with a place and a duration in minutes; works on streams as well."""
    user, minutes = F.col("user_id"), F.floor("value").cast("int")
    return events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("incident_id"),
        minutes.alias("estimated_duration"),
        F.col("ts").alias("started"),
        (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("ended"),
        (40 + F.lit(0.2) * F.expr("user_id div 10800") + F.lit(0.01) * (user % 7)).alias("lat"),
        ((user / 30 + 60) % 360 - 180).alias("lon"),
    )


def placed_routes(t: Tables) -> DataFrame:
    """Suppliers as routes with a place and ten days of service."""
    key = F.col("s_suppkey")
    opened = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(key * 7 % 30).cast("int"))
    return t.supplier.select(
        F.concat(F.lit("R"), key.cast("string")).alias("route_id"),
        F.concat(F.lit("R"), (key + 1).cast("string")).alias("alternative_routes"),
        (40 + F.lit(0.2) * F.expr("s_suppkey div 7200")).alias("lat"),
        ((key / 20 + 60) % 360 - 180).alias("lon"),
        opened.alias("started"),
        (opened + F.expr("INTERVAL 10 DAYS")).alias("ended"),
    )


@query("affected_routes", f"WITH {PLACES_SQL} SELECT * FROM affected")
def affected_routes(t: Tables) -> DataFrame:
    """Each incident with the routes within eight kilometres that are in service while it lasts."""
    found = P.affected_routes(placed_incidents(t.events), placed_routes(t), 8.0)
    return found.withColumn("distance_km", rounded("distance_km", 6))


@query(
    "topk_by_metric",
    f"WITH {METRICS_SQL} SELECT customer_id, total_spent FROM metrics ORDER BY total_spent DESC, customer_id LIMIT 20",
)
def topk_by_metric(t: Tables) -> DataFrame:
    """A top-20 report: each task keeps 20 rows."""
    metrics = C.customer_metrics(orders(t), AS_OF)
    return metrics.select("customer_id", "total_spent").orderBy(F.desc("total_spent"), "customer_id").limit(20)


@query(
    "best_row_by_metric",
    f"WITH {METRICS_SQL} SELECT customer_id AS best_customer, total_spent AS best_spent FROM metrics ORDER BY total_spent DESC, customer_id LIMIT 1",
)
def best_row_by_metric(t: Tables) -> DataFrame:
    best = F.max_by(F.struct("customer_id", "total_spent"), F.struct("total_spent", -F.col("customer_id")))
    return C.customer_metrics(orders(t), AS_OF).agg(best.alias("b")).select(
        F.col("b.customer_id").alias("best_customer"), F.col("b.total_spent").alias("best_spent")
    )


@query("ordered_output", f"WITH {DONE_SQL} SELECT customer_id, order_date, order_id FROM done ORDER BY customer_id, order_date, order_id")
def ordered_output(t: Tables) -> DataFrame:
    return completed(t).select("customer_id", "order_date", "order_id").orderBy("customer_id", "order_date", "order_id")


@query(
    "growth_rate",
    f"""WITH {LINES_SQL}, m AS (SELECT p_type AS category, CAST(date_trunc('month', ship_date) AS DATE) AS month,
      CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM line JOIN part ON p_partkey = product_id GROUP BY 1, 2),
    g AS (SELECT *, lag(revenue) OVER (PARTITION BY category ORDER BY month) AS before FROM m)
    SELECT category, month, revenue, round_even((revenue - before) / before, 6) AS growth_rate FROM g""",
)
def growth_rate(t: Tables) -> DataFrame:
    per_product = lines(t).groupBy("product_id", F.trunc("ship_date", "month").alias("month")).agg(
        F.sum(cents("price")).alias("c")
    )
    monthly = (
        per_product.join(t.part, F.col("product_id") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("category"), "month")
        .agg((F.sum("c") / F.lit(100.0)).alias("revenue"))
    )
    return H.growth(monthly, ["category"], "month", "revenue")


@query(
    "hospital_kpis",
    f"""WITH {NEXT_SQL} SELECT severity_of_illness, COUNT(*) AS cases, round_even(AVG(readmitted_30d), 6) AS readmission_rate,
    round_even(AVG(length_of_stay), 6) AS mean_stay, round_even(AVG(length_of_stay * 2), 6) AS case_mix_index,
    round_even(AVG(CASE WHEN length_of_stay >= 9 THEN 1 ELSE 0 END), 6) AS mortality_rate,
    round_even(CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS cost_per_case FROM labelled GROUP BY 1""",
)
def hospital_kpis(t: Tables) -> DataFrame:
    rows = labelled_stays(t).withColumns(
        {"died": F.when(F.col("length_of_stay") >= 9, 1).otherwise(0), "mix": F.col("length_of_stay") * 2}
    )
    return A.kpis(rows, ["severity_of_illness"], "readmitted_30d", "died", "amount", "mix")


@query(
    "bed_occupancy",
    f"""WITH {CLINIC_SQL}, c AS (SELECT admission_date AS day, 1 AS step FROM adm UNION ALL SELECT discharge_date, -1 FROM adm),
    d AS (SELECT day, SUM(step) AS net FROM c GROUP BY 1)
    SELECT day, CAST(SUM(net) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS occupied,
    round_even(CAST(SUM(net) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 500, 6) AS occupancy_rate FROM d""",
)
def bed_occupancy(t: Tables) -> DataFrame:
    return A.census(admissions(t), "admission_date", "discharge_date", F.lit(500))


@query(
    "health_disparities",
    f"""WITH {NEXT_SQL}, g AS (SELECT c_mktsegment AS grp, COUNT(*) AS n, CAST(SUM(readmitted_30d) AS BIGINT) AS events
      FROM labelled JOIN customer ON c_custkey = patient_id GROUP BY 1)
    SELECT grp, n, events, round_even(events / CAST(n AS DOUBLE), 6) AS rate,
    round_even((events / CAST(n AS DOUBLE)) / (SELECT events / CAST(n AS DOUBLE) FROM g WHERE grp = 'BUILDING'), 6) AS rate_ratio FROM g""",
)
def health_disparities(t: Tables) -> DataFrame:
    rows = labelled_stays(t).join(
        t.customer.select(F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("grp")), "patient_id"
    )
    return A.rate_ratio(rows, "grp", "readmitted_30d", "BUILDING")


@query(
    "outbreak_flags",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2),
    w AS (SELECT *, round_even(AVG(n) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 6) AS trailing_mean,
      round_even(stddev_samp(n) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 6) AS trailing_sd FROM d)
    SELECT event_type, day, n, trailing_mean, trailing_sd, CAST(COALESCE(n > trailing_mean + 3.0 * trailing_sd, FALSE) AS INTEGER) AS outbreak FROM w""",
)
def outbreak_flags(t: Tables) -> DataFrame:
    return A.outbreak_flags(t.events.withColumn("day", F.col("ts").cast("date")), "event_type", "day")


@query(
    "adherence_pdc",
    f"""WITH {ORDERS_SQL}, {LINES_SQL}, f AS (SELECT customer_id, p_type AS drug, ship_date AS day, MAX(ship_date + CAST(quantity AS INTEGER)) AS fin
      FROM line JOIN ord USING (order_id) JOIN part ON p_partkey = product_id GROUP BY 1, 2, 3),
    m AS (SELECT *, MAX(fin) OVER (PARTITION BY customer_id, drug ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f),
    c AS (SELECT *, greatest(CAST(fin - greatest(day, COALESCE(reach, day)) AS INTEGER), 0) AS fresh FROM m)
    SELECT customer_id, drug, CAST(SUM(fresh) AS BIGINT) AS days_covered, CAST(MAX(fin) - MIN(day) AS BIGINT) AS days_in_period,
    round_even(CAST(SUM(fresh) AS DOUBLE) / CAST(MAX(fin) - MIN(day) AS BIGINT), 6) AS pdc FROM c GROUP BY 1, 2""",
)
def adherence_pdc(t: Tables) -> DataFrame:
    fills = (
        lines(t)
        .join(orders(t).select("order_id", "customer_id"), "order_id")
        .join(t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("drug")), "product_id")
        .select("customer_id", "drug", F.col("ship_date").alias("day"), "quantity")
    )
    return A.proportion_covered(fills, ["customer_id", "drug"], "day", "quantity")
