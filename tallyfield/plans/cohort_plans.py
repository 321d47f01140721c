"""Cohort, lifetime value and survival queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators import cohorts as H
from tallyfield.operators import customers as C
from tallyfield.operators import survival as S
from tallyfield.plans.bindings import AS_OF, DONE_SQL, orders
from tallyfield.plans.customer_plans import METRICS_SQL, completed
from tallyfield.plans.registry import Tables, query

TABLE_SQL = DONE_SQL + """, reg AS (SELECT customer_id, CAST(date_trunc('month', MIN(order_date)) AS DATE) AS cohort_month FROM ord GROUP BY 1),
acts AS (SELECT d.*, cohort_month, CAST(date_diff('month', cohort_month, order_date) AS INTEGER) AS period_number
  FROM done d JOIN reg USING (customer_id)),
cells AS (SELECT cohort_month, period_number, COUNT(DISTINCT customer_id) AS customers,
    CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue, COUNT(DISTINCT order_id) AS orders,
    round_even(CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_order_value
  FROM acts GROUP BY 1, 2),
cohort AS (SELECT c.*, z.cohort_size, round_even(c.customers / CAST(z.cohort_size AS DOUBLE), 6) AS retention_rate,
    round_even(revenue / c.customers, 4) AS revenue_per_customer,
    round_even(c.orders / CAST(c.customers AS DOUBLE), 6) AS orders_per_customer
  FROM cells c LEFT JOIN (SELECT cohort_month, customers AS cohort_size FROM cells WHERE period_number = 0) z USING (cohort_month))"""

CLV_STEPS = """clv0 AS (SELECT customer_id, MIN(order_date) AS first_purchase, MAX(order_date) AS last_purchase,
    COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    round_even(CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_order_value,
    CAST(date_diff('day', MIN(order_date), MAX(order_date)) AS DOUBLE) AS customer_lifespan
  FROM done GROUP BY 1),
clv1 AS (SELECT *, round_even(CASE WHEN total_orders > 1 THEN customer_lifespan / (total_orders - 1) END, 6) AS avg_days_between_orders,
    total_orders / greatest(customer_lifespan / CAST(365 AS DOUBLE), CAST(1 AS DOUBLE) / 365) AS yearly FROM clv0),
clv AS (SELECT * EXCLUDE (yearly), round_even(yearly, 6) AS purchase_frequency,
    round_even(total_revenue * yearly * 2, 2) AS predicted_clv FROM clv1)"""
CLV_SQL = f"{DONE_SQL}, {CLV_STEPS}"


def activity(t: Tables) -> DataFrame:
    return H.cohort_activity(completed(t), H.registrations(orders(t)))


def table(t: Tables) -> DataFrame:
    return H.cohort_table(activity(t))


@query("cohort_table", f"WITH {TABLE_SQL} SELECT * FROM cohort")
def cohort_table(t: Tables) -> DataFrame:
    return table(t)


@query(
    "self_derived_join",
    f"WITH {TABLE_SQL} SELECT cohort_month, period_number, customers, cohort_size FROM cohort",
)
def self_derived_join(t: Tables) -> DataFrame:
    return table(t).select("cohort_month", "period_number", "customers", "cohort_size")


@query(
    "cohort_mart",
    f"""WITH {METRICS_SQL}, g AS (SELECT CAST(date_trunc('month', first_order) AS DATE) AS cohort_month,
      CAST(date_diff('month', first_order, DATE '{AS_OF}') AS INTEGER) AS period_number, COUNT(*) AS customers_count,
      SUM(CAST(total_spent AS DECIMAL(18,2))) AS spent FROM metrics GROUP BY 1, 2)
    SELECT cohort_month, period_number, customers_count,
      round_even(customers_count / CAST(first_value(customers_count) OVER (PARTITION BY cohort_month ORDER BY period_number) AS DOUBLE), 6) AS retention_rate,
      round_even(CAST(spent AS DOUBLE) / customers_count, 4) AS avg_revenue_per_user, CAST(spent AS DOUBLE) AS cumulative_revenue FROM g""",
)
def cohort_mart(t: Tables) -> DataFrame:
    return H.cohort_mart(C.customer_metrics(orders(t), AS_OF), AS_OF)


@query(
    "ratio_to_first",
    f"""WITH {TABLE_SQL} SELECT cohort_month, period_number, customers,
    round_even(customers / CAST(first_value(customers) OVER (PARTITION BY cohort_month ORDER BY period_number) AS DOUBLE), 6) AS ratio FROM cells""",
)
def ratio_to_first(t: Tables) -> DataFrame:
    cells = table(t).select("cohort_month", "period_number", "customers")
    return H.ratio_to_first(cells, "cohort_month", "period_number", "customers", "ratio")


@query(
    "running_revenue",
    f"""WITH {TABLE_SQL} SELECT cohort_month, period_number, CAST(SUM(CAST(revenue AS DECIMAL(18,2)))
    OVER (PARTITION BY cohort_month ORDER BY period_number) AS DOUBLE) AS cumulative_revenue FROM cells""",
)
def running_revenue(t: Tables) -> DataFrame:
    return H.running_revenue(table(t))


@query("clv_metrics", f"WITH {CLV_SQL} SELECT * FROM clv")
def clv_metrics(t: Tables) -> DataFrame:
    return H.clv_metrics(completed(t))


@query(
    "quantile_tiers",
    f"""WITH {CLV_SQL}, q AS (SELECT quantile_cont(predicted_clv, [0.8, 0.6, 0.4, 0.2]) AS c,
      quantile_cont(purchase_frequency, [0.8, 0.6, 0.4, 0.2]) AS f FROM clv)
    SELECT customer_id, predicted_clv, purchase_frequency,
      CASE WHEN predicted_clv >= c[1] THEN 'High Value' WHEN predicted_clv >= c[2] THEN 'Medium-High Value'
        WHEN predicted_clv >= c[3] THEN 'Medium Value' WHEN predicted_clv >= c[4] THEN 'Medium-Low Value' ELSE 'Low Value' END AS clv_segment,
      CASE WHEN purchase_frequency >= f[1] THEN 'Very Frequent' WHEN purchase_frequency >= f[2] THEN 'Frequent'
        WHEN purchase_frequency >= f[3] THEN 'Moderate' WHEN purchase_frequency >= f[4] THEN 'Occasional' ELSE 'Rare' END AS frequency_segment
    FROM clv, q""",
)
def quantile_tiers(t: Tables) -> DataFrame:
    return H.quantile_tiers(H.clv_metrics(completed(t))).select(
        "customer_id", "predicted_clv", "purchase_frequency", "clv_segment", "frequency_segment"
    )


@query(
    "retention_matrix",
    f"""WITH {TABLE_SQL}, named AS (SELECT cohort_month, 'Period_' || CAST(period_number AS VARCHAR) AS period, retention_rate FROM cohort)
    PIVOT named ON period USING first(retention_rate) GROUP BY cohort_month""",
)
def retention_matrix(t: Tables) -> DataFrame:
    return H.retention_matrix(table(t))


@query(
    "retention_lines",
    f"""WITH {TABLE_SQL} SELECT cohort_month, string_agg(CAST(period_number AS VARCHAR), ',' ORDER BY period_number) AS periods,
    string_agg(COALESCE(CAST(CAST(round_even(retention_rate * 1000000, 0) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY period_number) AS rates FROM cohort GROUP BY 1""",
)
def retention_lines(t: Tables) -> DataFrame:
    """The matrix as one row per cohort: its periods, and their rates in millionths."""
    return H.retention_lines(table(t))


@query(
    "retention_melt",
    f"""WITH {TABLE_SQL} SELECT cohort_month, 'Period_' || CAST(period_number AS VARCHAR) AS period, retention_rate FROM cohort
    WHERE retention_rate IS NOT NULL""",
)
def retention_melt(t: Tables) -> DataFrame:
    return H.melt_table(table(t))


@query(
    "cohort_report",
    f"""WITH {TABLE_SQL}, {CLV_STEPS},
    lim AS (SELECT quantile_cont(predicted_clv, 0.5) AS mid, quantile_cont(predicted_clv, 0.8) AS hi FROM clv)
    SELECT COUNT(*) AS total_customers, CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
      round_even(CAST(SUM(CAST(predicted_clv AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS avg_clv,
      round_even(CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) FILTER (predicted_clv >= (SELECT hi FROM lim)) AS DOUBLE)
        / CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE), 6) AS top_fifth_revenue_share,
      round_even((SELECT mid FROM lim), 2) AS median_clv,
      (SELECT round_even(AVG(customers / CAST(cohort_size AS DOUBLE)), 6) FROM cohort WHERE period_number = 1) AS retention_month_1,
      (SELECT round_even(AVG(customers / CAST(cohort_size AS DOUBLE)), 6) FROM cohort WHERE period_number = 6) AS retention_month_6,
      (SELECT round_even(AVG(customers / CAST(cohort_size AS DOUBLE)), 6) FROM cohort WHERE period_number = 12) AS retention_month_12
    FROM clv""",
)
def cohort_report(t: Tables) -> DataFrame:
    return H.cohort_report(table(t), H.clv_metrics(completed(t)))


@query(
    "monthly_revenue",
    f"""WITH {TABLE_SQL} SELECT CAST(cohort_month + to_months(period_number) AS DATE) AS order_month,
    CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM cells GROUP BY 1""",
)
def monthly_revenue(t: Tables) -> DataFrame:
    return H.monthly_revenue(table(t))


@query(
    "histogram",
    f"""WITH {CLV_SQL}, b AS (SELECT MIN(predicted_clv) AS low, MAX(predicted_clv) AS high FROM clv)
    SELECT CAST(least(floor((predicted_clv - low) * 50 / (high - low)), 49) + 1 AS INTEGER) AS bin, COUNT(*) AS n FROM clv, b GROUP BY 1""",
)
def histogram(t: Tables) -> DataFrame:
    return H.histogram(H.clv_metrics(completed(t)), "predicted_clv", 50)


@query(
    "five_number_by_group",
    f"""WITH {TABLE_SQL}, q AS (SELECT period_number, COUNT(*) AS n, quantile_cont(revenue_per_customer, [0.0, 0.25, 0.5, 0.75, 1.0]) AS v
      FROM cohort WHERE period_number <= 12 GROUP BY 1)
    SELECT period_number, n, round_even(v[1], 4) AS low, round_even(v[2], 4) AS lower_quartile, round_even(v[3], 4) AS median,
    round_even(v[4], 4) AS upper_quartile, round_even(v[5], 4) AS high FROM q""",
)
def five_number_by_group(t: Tables) -> DataFrame:
    rows = table(t).where(F.col("period_number") <= 12)
    return H.five_numbers(rows, "period_number", "revenue_per_customer")


@query(
    "linear_trend",
    f"""WITH {CLV_SQL} SELECT CAST(regr_count(predicted_clv, purchase_frequency) AS BIGINT) AS n,
    round_even(regr_slope(predicted_clv, purchase_frequency), 3) AS slope,
    round_even(regr_intercept(predicted_clv, purchase_frequency), 1) AS intercept,
    round_even(regr_r2(predicted_clv, purchase_frequency), 6) AS r2 FROM clv""",
)
def linear_trend(t: Tables) -> DataFrame:
    return H.linear_trend(H.clv_metrics(completed(t)), "predicted_clv", "purchase_frequency")


@query(
    "mrr",
    f"""WITH {DONE_SQL}, m AS (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS month,
      SUM(CAST(amount AS DECIMAL(18,2))) AS amount FROM done GROUP BY 1, 2)
    SELECT a.month, COALESCE(CAST(SUM(CASE WHEN b.month IS NOT NULL THEN a.amount END) AS DOUBLE), 0) AS mrr,
    COUNT(b.month) AS recurring_customers
    FROM m a LEFT JOIN m b ON a.customer_id = b.customer_id AND b.month = a.month - INTERVAL 1 MONTH GROUP BY 1""",
)
def mrr(t: Tables) -> DataFrame:
    return H.recurring_revenue(completed(t))


@query(
    "churn_rate_monthly",
    f"""WITH {DONE_SQL}, m AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS month FROM done)
    SELECT CAST(a.month + INTERVAL 1 MONTH AS DATE) AS month, COUNT(*) AS active_before, COUNT(*) - COUNT(b.month) AS churned,
    round_even((COUNT(*) - COUNT(b.month)) / CAST(COUNT(*) AS DOUBLE), 6) AS churn_rate
    FROM m a LEFT JOIN m b ON a.customer_id = b.customer_id AND b.month = a.month + INTERVAL 1 MONTH GROUP BY 1""",
)
def churn_rate_monthly(t: Tables) -> DataFrame:
    return H.monthly_churn(completed(t))


SURVIVAL_SQL = DONE_SQL + f""", base AS (SELECT customer_id, MIN(order_date) AS first_purchase, MAX(order_date) AS last_purchase,
    COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM done GROUP BY 1),
flagged AS (SELECT *, CASE WHEN DATE '{AS_OF}' - last_purchase > 90 THEN 1 ELSE 0 END AS churned,
    CAST(last_purchase - first_purchase AS INTEGER) AS time_to_last_purchase FROM base),
surv AS (SELECT * FROM (SELECT *, CAST(CASE WHEN churned = 1 THEN time_to_last_purchase ELSE DATE '{AS_OF}' - first_purchase END AS INTEGER)
    AS survival_time FROM flagged) WHERE survival_time > 0)"""


@query("survival_data", f"WITH {SURVIVAL_SQL} SELECT * FROM surv")
def survival_data(t: Tables) -> DataFrame:
    return S.survival_data(completed(t), AS_OF)


@query(
    "kaplan_meier",
    f"""WITH {SURVIVAL_SQL}, g AS (SELECT survival_time AS time, COUNT(*) AS leaving, CAST(SUM(churned) AS BIGINT) AS n_event FROM surv GROUP BY 1),
    r AS (SELECT *, CAST(SUM(leaving) OVER (ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS n_risk FROM g),
    p AS (SELECT *, product(1 - n_event / CAST(n_risk AS DOUBLE)) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS s,
      SUM(CASE WHEN n_event < n_risk THEN n_event / (CAST(n_risk AS DOUBLE) * (n_risk - n_event)) END) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS v,
      MAX(CASE WHEN n_event = n_risk THEN 1 ELSE 0 END) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS ended FROM r)
    SELECT time, n_risk, n_event, leaving - n_event AS n_censor, round_even(s, 6) AS survival,
      round_even(CASE WHEN ended = 0 THEN s * s * v END, 8) AS variance,
      round_even(CASE WHEN ended = 0 THEN s * exp(-1.959963984540054 * sqrt(v)) END, 6) AS lower,
      round_even(CASE WHEN ended = 0 THEN least(s * exp(1.959963984540054 * sqrt(v)), 1) END, 6) AS upper FROM p""",
)
def kaplan_meier(t: Tables) -> DataFrame:
    return S.kaplan_meier(S.survival_data(completed(t), AS_OF))
