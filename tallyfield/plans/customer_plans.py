"""Customer queries: metrics, segments, reports and daily KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.numbers import cents, share
from tallyfield.functions.text import GENDER_CODES, plausible_email, recode
from tallyfield.operators import customers as C
from tallyfield.plans import daily
from tallyfield.plans.bindings import AS_OF, COMPLETED, DONE_SQL, ORDERS_SQL, PEOPLE_SQL, RUN_DAY, orders, people
from tallyfield.plans.registry import Tables, query
from tallyfield.session import work_folder


def completed(t: Tables) -> DataFrame:
    return orders(t).where(F.col("status") == COMPLETED)


EXTRACT_SQL = DONE_SQL + """, extract AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders,
         CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         round_even(CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_order_value,
         MAX(order_date) AS last_order_date, MIN(order_date) AS first_order_date,
         COUNT(DISTINCT date_trunc('month', order_date)) AS active_months,
         CAST(date_diff('day', MAX(order_date), DATE '2001-08-02') AS INTEGER) AS days_since_last_order,
         CAST(date_diff('day', MIN(order_date), MAX(order_date)) AS INTEGER) AS customer_lifespan
  FROM done GROUP BY customer_id)"""


def scored_sql(source: str, recency: str, frequency: str, monetary: str) -> str:
    def score(column: str) -> str:
        return (
            f"CAST(greatest(1, ((row_number() OVER (ORDER BY {column}, customer_id) - 1) * 5 + COUNT(*) OVER () - 2)"
            f" // greatest(COUNT(*) OVER () - 1, 1)) AS INTEGER)"
        )

    cases = " ".join(
        "WHEN rfm_score IN (" + ", ".join(f"'{code}'" for code in codes) + f") THEN '{segment}'" for segment, codes in C.SEGMENT_CODES.items()
    )
    return f"""ranked AS (
  SELECT *, 6 - {score(recency)} AS recency_score, {score(frequency)} AS frequency_score,
         {score(monetary)} AS monetary_score FROM {source}),
scored AS (
  SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR) AS rfm_score
  FROM ranked),
rfm AS (
  SELECT *, CASE {cases} ELSE '{C.DEFAULT_SEGMENT}' END AS segment FROM scored)"""


RFM_SQL = (
    EXTRACT_SQL
    + ", roles AS (SELECT *, days_since_last_order AS recency, total_orders AS frequency, total_revenue AS monetary FROM extract), "
    + scored_sql("roles", "recency", "frequency", "monetary")
)


def rfm(t: Tables) -> DataFrame:
    return C.rfm_segments(C.segmentation_extract(completed(t), AS_OF))


def metrics_sql(day: str, source: str = "ord") -> str:
    """Metrics per customer on a day, from the orders of ``source``."""
    return f"""metrics AS (
  SELECT customer_id, COUNT(order_id) AS total_orders,
         CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
         round_even(CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS avg_order_value,
         MIN(order_date) AS first_order, MAX(order_date) AS last_order,
         CAST(date_diff('day', MAX(order_date), DATE '{day}') AS INTEGER) AS days_since_last_order,
         CAST(date_diff('day', MIN(order_date), MAX(order_date)) AS INTEGER) AS customer_lifetime_days
  FROM {source} GROUP BY customer_id)"""


METRICS_SQL = f"{ORDERS_SQL}, {metrics_sql(AS_OF)}"


@query("customer_metrics", f"WITH {METRICS_SQL} SELECT * FROM metrics")
def customer_metrics(t: Tables) -> DataFrame:
    return C.customer_metrics(orders(t), AS_OF)


@query(
    "customer_360",
    f"""WITH {ORDERS_SQL}, {PEOPLE_SQL}
    SELECT p.customer_id, p.first_name, p.last_name, p.email, p.gender, p.date_of_birth, p.nation_key, p.balance,
           COUNT(o.order_id) AS total_orders, CAST(SUM(CAST(o.amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
           round_even(CAST(SUM(CAST(o.amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o.amount), 4) AS avg_order_value,
           MAX(o.order_date) AS last_order_date, MIN(o.order_date) AS first_order_date,
           CAST(date_diff('day', MAX(o.order_date), DATE '2001-08-02') AS INTEGER) AS days_since_last_order
    FROM people p LEFT JOIN ord o ON p.customer_id = o.customer_id
    GROUP BY ALL""",
)
def customer_360(t: Tables) -> DataFrame:
    return C.customer_360(people(t), orders(t), AS_OF)


@query("segmentation_extract", f"WITH {EXTRACT_SQL} SELECT * FROM extract")
def segmentation_extract(t: Tables) -> DataFrame:
    return C.segmentation_extract(completed(t), AS_OF)


@query(
    "rfm_quintiles",
    f"""WITH {RFM_SQL} SELECT customer_id, recency, frequency, monetary, recency_score, frequency_score,
    monetary_score, rfm_score FROM rfm""",
)
def rfm_quintiles(t: Tables) -> DataFrame:
    return rfm(t).select(
        "customer_id", "recency", "frequency", "monetary", "recency_score", "frequency_score",
        "monetary_score", "rfm_score",
    )


@query("segment_rule_table", f"WITH {RFM_SQL} SELECT customer_id, rfm_score, segment FROM rfm")
def segment_rule_table(t: Tables) -> DataFrame:
    return rfm(t).select("customer_id", "rfm_score", "segment")


@query(
    "segment_insights",
    f"""WITH {RFM_SQL} SELECT segment, COUNT(*) AS customer_count, round_even(AVG(recency), 4) AS avg_recency,
    round_even(AVG(frequency), 4) AS avg_frequency,
    round_even(CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_monetary,
    round_even(AVG(avg_order_value), 4) AS avg_order_value,
    CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    round_even(CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) * 100
      / (SELECT CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) FROM rfm), 4) AS revenue_percentage,
    CASE segment {' '.join(f"WHEN '{name}' THEN '{advice}'" for name, advice in C.RECOMMENDATIONS.items())} END AS recommendation
    FROM rfm GROUP BY segment""",
)
def segment_insights(t: Tables) -> DataFrame:
    return C.segment_insights(rfm(t))


@query(
    "segment_summary",
    f"""WITH {RFM_SQL} SELECT segment, COUNT(*) AS customer_count, round_even(AVG(recency), 2) AS recency_mean,
    round_even(AVG(frequency), 2) AS frequency_mean,
    round_even(CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS monetary_mean,
    CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS monetary_sum,
    round_even(AVG(avg_order_value), 2) AS avg_order_value_mean FROM rfm GROUP BY segment""",
)
def segment_summary(t: Tables) -> DataFrame:
    return C.segment_summary(rfm(t))


@query(
    "segment_metrics",
    f"""WITH {RFM_SQL} SELECT segment, COUNT(*) AS customer_id,
    CAST(SUM(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS monetary,
    round_even(AVG(avg_order_value), 4) AS avg_order_value, round_even(AVG(frequency), 4) AS frequency
    FROM rfm GROUP BY segment""",
)
def segment_metrics(t: Tables) -> DataFrame:
    return C.segment_metrics(rfm(t))


@query(
    "cluster_summary",
    f"""WITH {EXTRACT_SQL}, lab AS (SELECT CASE WHEN total_orders >= 6 THEN 1 WHEN total_orders >= 4 THEN 2
      WHEN total_orders >= 2 THEN 3 ELSE 0 END AS cluster, * FROM extract)
    SELECT cluster, round_even(AVG(days_since_last_order), 2) AS "Avg_Recency", round_even(AVG(total_orders), 2) AS "Avg_Frequency",
    round_even(AVG(total_revenue), 2) AS "Avg_Monetary", round_even(AVG(avg_order_value), 2) AS "Avg_Order_Value",
    round_even(AVG(customer_lifespan), 2) AS "Avg_Lifespan", COUNT(*) AS "Customer_Count" FROM lab GROUP BY cluster""",
)
def cluster_summary(t: Tables) -> DataFrame:
    """Labels are given by order count here; fitted labels come from ``kmeans_clusters``."""
    return C.cluster_summary(labelled(t))


def labelled(t: Tables) -> DataFrame:
    orders_held = F.col("total_orders")
    return C.segmentation_extract(completed(t), AS_OF).select(
        "*",
        F.when(orders_held >= 6, 1).when(orders_held >= 4, 2).when(orders_held >= 2, 3).otherwise(0).alias("cluster"),
        F.col("days_since_last_order").alias("recency"),
        orders_held.alias("frequency"),
        F.col("total_revenue").alias("monetary"),
    )


@query(
    "scale_and_label_names",
    f"""WITH {EXTRACT_SQL} SELECT customer_id,
      CASE WHEN total_orders >= 6 THEN 'High Value' WHEN total_orders >= 4 THEN 'Regular Customers'
           WHEN total_orders >= 2 THEN 'New Customers' ELSE 'Price Sensitive' END AS name_of_four,
      CASE WHEN total_orders >= 6 THEN 'Loyal Customers' WHEN total_orders >= 4 THEN 'At Risk'
           WHEN total_orders >= 2 THEN 'New Customers' ELSE 'Champions' END AS name_of_five,
      CASE WHEN total_orders >= 6 THEN 'Cluster_1' WHEN total_orders >= 4 THEN 'Cluster_2'
           WHEN total_orders >= 2 THEN 'Cluster_3' ELSE 'Cluster_0' END AS name_of_seven FROM extract""",
)
def scale_and_label_names(t: Tables) -> DataFrame:
    return labelled(t).select(
        "customer_id",
        C.cluster_name("cluster", 4).alias("name_of_four"),
        C.cluster_name("cluster", 5).alias("name_of_five"),
        C.cluster_name("cluster", 7).alias("name_of_seven"),
    )


@query(
    "rfm_crosstab",
    f"""WITH {RFM_SQL} SELECT recency_score, frequency_score,
    COUNT(*) FILTER (monetary_score = 1) AS monetary_1, COUNT(*) FILTER (monetary_score = 2) AS monetary_2,
    COUNT(*) FILTER (monetary_score = 3) AS monetary_3, COUNT(*) FILTER (monetary_score = 4) AS monetary_4,
    COUNT(*) FILTER (monetary_score = 5) AS monetary_5 FROM rfm GROUP BY ALL""",
)
def rfm_crosstab(t: Tables) -> DataFrame:
    return C.rfm_crosstab(rfm(t))


@query(
    "value_counts",
    """SELECT o_orderpriority AS value, COUNT(*) AS n,
    round_even(COUNT(*) / CAST((SELECT COUNT(*) FROM orders) AS DOUBLE), 6) AS share FROM orders GROUP BY 1""",
)
def value_counts(t: Tables) -> DataFrame:
    return C.value_counts(t.orders, "o_orderpriority")


@query(
    "hierarchy_rollup",
    f"""WITH {ORDERS_SQL}, {PEOPLE_SQL}, named AS (
      SELECT n_regionkey AS region, CASE upper(gender) WHEN 'M' THEN 'Male' WHEN 'MALE' THEN 'Male' WHEN 'F' THEN 'Female'
        WHEN 'FEMALE' THEN 'Female' ELSE 'Other' END AS gender, nation_key AS nation, amount
      FROM ord JOIN people USING (customer_id) JOIN nation ON n_nationkey = nation_key)
    SELECT region, gender, nation, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount_sum,
           CAST(GROUPING(region, gender, nation) AS BIGINT) AS level
    FROM named GROUP BY ROLLUP (region, gender, nation)""",
)
def hierarchy_rollup(t: Tables) -> DataFrame:
    spent = orders(t).groupBy("customer_id").agg((F.sum(cents("amount")) / 100.0).alias("amount"))
    named = (
        people(t)
        .join(spent, "customer_id")
        .join(t.nation, F.col("nation_key") == F.col("n_nationkey"))
        .select(
            F.col("n_regionkey").alias("region"),
            recode("gender", GENDER_CODES).alias("gender"),
            F.col("nation_key").alias("nation"),
            "amount",
        )
    )
    return C.hierarchy_rollup(named, ["region", "gender", "nation"], "amount")


@query(
    "executive_kpis",
    f"""WITH {METRICS_SQL} SELECT DATE '{RUN_DAY}' AS report_date,
    CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, COUNT(DISTINCT o.order_id) AS total_orders,
    COUNT(DISTINCT CASE WHEN first_order = DATE '{RUN_DAY}' THEN o.customer_id END) AS new_customers,
    COUNT(DISTINCT CASE WHEN first_order < DATE '{RUN_DAY}' THEN o.customer_id END) AS returning_customers,
    round_even(CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_order_value,
    CAST(0 AS DOUBLE) AS customer_acquisition_cost,
    round_even(CAST(SUM(CAST(total_spent AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS customer_lifetime_value,
    CAST(0 AS DOUBLE) AS churn_rate, COUNT(DISTINCT o.customer_id) AS monthly_active_users,
    CAST(0 AS DOUBLE) AS conversion_rate
    FROM ord o JOIN metrics m ON o.customer_id = m.customer_id WHERE o.order_date = DATE '{RUN_DAY}'""",
)
def executive_kpis(t: Tables) -> DataFrame:
    return C.executive_kpis(orders(t), RUN_DAY)


@query(
    "fact_customer_metrics",
    f"""WITH {METRICS_SQL}, {scored_sql('metrics', 'days_since_last_order', 'total_orders', 'total_spent')}
    SELECT customer_id, DATE '{AS_OF}' AS metric_date, total_orders, total_spent AS total_revenue, avg_order_value,
    days_since_last_order,
    round_even(total_spent * (total_orders / greatest(customer_lifetime_days / 365.0, CAST(1 AS DOUBLE) / 365)) * 2, 2) AS lifetime_value,
    recency_score, frequency_score, monetary_score, segment AS rfm_segment FROM rfm""",
)
def fact_customer_metrics(t: Tables) -> DataFrame:
    return C.fact_customer_metrics(orders(t), AS_OF)


#: Two run dates of the daily queries.
RUNS = (RUN_DAY, AS_OF)


def fact_sql(day: str) -> str:
    known = f"known AS (SELECT * FROM ord WHERE order_date <= DATE '{day}')"
    scored = scored_sql("metrics", "days_since_last_order", "total_orders", "total_spent")
    return f"""(WITH {ORDERS_SQL}, {known}, {metrics_sql(day, 'known')}, {scored}
    SELECT CAST(customer_id AS VARCHAR) AS customer_id, DATE '{day}' AS metric_date, CAST(total_orders AS INTEGER) AS total_orders,
      total_spent AS total_revenue, avg_order_value, days_since_last_order,
      round_even(total_spent * (total_orders / greatest(customer_lifetime_days / 365.0, CAST(1 AS DOUBLE) / 365)) * 2, 2) AS lifetime_value,
      recency_score, frequency_score, monetary_score, segment AS rfm_segment, TRUE AS has_churn_probability FROM rfm)"""


def daily_runs(t: Tables, days: Sequence[str]) -> dict[str, str]:
    """The folders after one run a day, the first day run twice."""
    root = work_folder(t.spark, "daily")
    paths = {}
    buyers = people(t).where(plausible_email("email")).withColumn("email", F.trim("email"))
    for day in (*days, days[0]):
        last = orders(t).groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
        idle = share(F.count_if(F.datediff(F.lit(day).cast("date"), F.col("last_order")) > 90), F.count(F.lit(1)))
        paths = daily.run_daily(buyers, orders(t), root, day, {"churn_rate": last.agg(idle.alias("x")).scalar()}, (0, 1_000_000))
    return paths


@query("daily_run", " UNION ALL ".join(f"SELECT * FROM {fact_sql(day)}" for day in RUNS))
def daily_run(t: Tables) -> DataFrame:
    """The customer fact after runs on two dates and a repeat of the first: both days stand, once each."""
    fact = t.spark.read.parquet(daily_runs(t, RUNS)["fact_customer_metrics"])
    chance = F.coalesce(F.col("churn_probability").between(0, 1), F.lit(False))
    return fact.select(
        *[F.col(c).cast("double") if c in ("total_revenue", "avg_order_value", "lifetime_value") else F.col(c) for c in fact.columns if c != "churn_probability"],
        chance.alias("has_churn_probability"),
    )
