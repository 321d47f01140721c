"""Mart, basket, journey and session queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators import marts as M
from tallyfield.plans.bindings import AS_OF, LINES_SQL, ORDERS_SQL, lines, orders
from tallyfield.plans.registry import Tables, query


def _money(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("unit_cost"),
    )


@query(
    "fact_product_performance",
    f"""WITH {LINES_SQL}, g AS (SELECT product_id, ship_date AS metric_date, CAST(SUM(quantity) AS BIGINT) AS units_sold, {_money('price')} AS revenue,
      round_even(AVG(line_number % 5 + 1), 4) AS avg_rating, COUNT(*) AS review_count,
      round_even(COUNT(*) FILTER (return_flag = 'R') / CAST(COUNT(*) AS DOUBLE), 6) AS return_rate FROM line GROUP BY 1, 2)
    SELECT g.*, round_even(units_sold / CAST(p_size * 10 AS DOUBLE), 6) AS stock_turnover FROM g LEFT JOIN part ON p_partkey = product_id""",
)
def fact_product_performance(t: Tables) -> DataFrame:
    stock = t.part.select(F.col("p_partkey").alias("product_id"), (F.col("p_size") * 10).alias("stock_quantity"))
    return M.product_performance(lines(t).withColumn("rating", F.col("line_number") % 5 + 1), stock)


CAMPAIGN_SQL = """camp AS (SELECT 'C' || CAST(user_id % 20 AS VARCHAR) AS campaign_id, CAST(ts AS DATE) AS metric_date,
    COUNT(*) FILTER (event_type = 'view') AS impressions, COUNT(*) FILTER (event_type = 'click') AS clicks,
    COUNT(*) FILTER (event_type = 'purchase') AS conversions,
    COALESCE(CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE), 0) AS revenue FROM events GROUP BY 1, 2),
  priced AS (SELECT *, round_even(impressions * CAST(0.02 AS DOUBLE) + clicks * CAST(0.5 AS DOUBLE), 2) AS cost FROM camp)"""


def campaigns(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.concat(F.lit("C"), (F.col("user_id") % 20).cast("string")).alias("campaign_id"),
        F.col("ts").cast("date").alias("metric_date"), "event_type", "value",
    )
    return M.campaign_performance(rows, F.col("impressions") * F.lit(0.02) + F.col("clicks") * F.lit(0.5))


@query(
    "fact_campaign_performance",
    f"""WITH {CAMPAIGN_SQL} SELECT *, round_even(clicks / nullif(CAST(impressions AS DOUBLE), 0), 6) AS ctr,
    round_even(conversions / nullif(CAST(clicks AS DOUBLE), 0), 6) AS conversion_rate, round_even(revenue / nullif(cost, 0), 6) AS roas,
    round_even(cost / nullif(CAST(conversions AS DOUBLE), 0), 6) AS cpa FROM priced""",
)
def fact_campaign_performance(t: Tables) -> DataFrame:
    return campaigns(t)


@query(
    "dm_category_performance",
    f"""WITH {LINES_SQL}, m AS (SELECT p_type AS category, p_brand AS subcategory, CAST(date_trunc('month', ship_date) AS DATE) AS report_date,
      {_money('price')} AS revenue, CAST(SUM(quantity) AS BIGINT) AS units_sold, {_money('quantity * p_retailprice')} AS cost
      FROM line JOIN part ON p_partkey = product_id GROUP BY 1, 2, 3),
    w AS (SELECT *, CAST(SUM(CAST(revenue AS DECIMAL(18,2))) OVER (PARTITION BY report_date) AS DOUBLE) AS whole,
      lag(revenue) OVER (PARTITION BY category, subcategory ORDER BY report_date) AS before FROM m)
    SELECT category, subcategory, report_date, revenue, units_sold, round_even(revenue / units_sold, 4) AS avg_price,
    round_even((revenue - cost) / revenue, 6) AS profit_margin, round_even(revenue / whole, 6) AS market_share,
    round_even((revenue - before) / before, 6) AS growth_rate FROM w""",
)
def dm_category_performance(t: Tables) -> DataFrame:
    return M.category_performance(lines(t), products(t))


SESSION_SQL = """stepped AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
  flagged AS (SELECT *, CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) >= 1800000000 THEN 1 ELSE 0 END AS opens FROM stepped),
  numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS number FROM flagged),
  sess AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS pages_viewed,
    CAST(MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS conversion_flag,
    round_even((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / CAST(1000000 AS DOUBLE), 3) AS duration_seconds FROM numbered GROUP BY user_id, number)"""


def session_rows(t: Tables) -> DataFrame:
    return M.session_table(t.events, "user_id", "ts", "event_id")


@query("session_table", f"WITH {SESSION_SQL} SELECT * FROM sess")
def session_table(t: Tables) -> DataFrame:
    return session_rows(t)


@query(
    "session_behaviour",
    f"""WITH {SESSION_SQL} SELECT 'D' || CAST(user_id % 3 AS VARCHAR) AS device_type, COUNT(*) AS sessions, CAST(SUM(pages_viewed) AS BIGINT) AS pages,
    round_even(COUNT(*) FILTER (pages_viewed = 1) / CAST(COUNT(*) AS DOUBLE), 6) AS bounce_rate,
    round_even(COUNT(*) / CAST(SUM(pages_viewed) AS DOUBLE), 6) AS exit_page_rate, round_even(AVG(duration_seconds), 3) AS mean_duration,
    round_even(SUM(duration_seconds) / nullif(SUM(pages_viewed - 1), 0), 3) AS mean_time_on_page,
    round_even(SUM(conversion_flag) / CAST(COUNT(*) AS DOUBLE), 6) AS conversion_rate FROM sess GROUP BY 1""",
)
def session_behaviour(t: Tables) -> DataFrame:
    device = F.concat(F.lit("D"), (F.col("user_id") % 3).cast("string"))
    return M.session_behaviour(session_rows(t).withColumn("device_type", device), ["device_type"])


@query(
    "support_sla",
    """WITH s AS (SELECT l_orderkey, MAX(l_shipdate) AS resolved FROM lineitem GROUP BY 1)
    SELECT o_orderstatus AS issue_type, o_orderpriority AS priority, COUNT(*) AS tickets, COUNT(resolved) AS resolved,
    round_even(AVG(date_diff('second', o_orderdate, resolved) / CAST(3600 AS DOUBLE)), 4) AS mean_hours,
    round_even(AVG(o_orderkey % 5 + 1), 4) AS mean_satisfaction FROM orders LEFT JOIN s ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def support_sla(t: Tables) -> DataFrame:
    """Orders as tickets, resolved by their last shipment."""
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("resolved_date"))
    tickets = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderstatus").alias("issue_type"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("created_date"), "resolved_date", (F.col("o_orderkey") % 5 + 1).alias("satisfaction_score"),
    )
    return M.support_sla(tickets)


@query(
    "review_stats",
    """SELECT l_partkey AS product_id, round_even(AVG(l_linenumber % 5 + 1), 4) AS avg_rating, COUNT(*) AS review_count,
    CAST(SUM(l_quantity) AS BIGINT) AS helpful_votes, round_even(COUNT(*) FILTER (l_linestatus = 'F') / CAST(COUNT(*) AS DOUBLE), 6) AS verified_share
    FROM lineitem GROUP BY 1""",
)
def review_stats(t: Tables) -> DataFrame:
    return M.review_stats(
        t.lineitem.select(
            F.col("l_partkey").alias("product_id"), (F.col("l_linenumber") % 5 + 1).alias("rating"),
            F.col("l_quantity").alias("helpful_votes"), (F.col("l_linestatus") == "F").alias("verified_purchase"),
        )
    )


@query(
    "kpi_placeholders",
    f"""WITH {CAMPAIGN_SQL}, {SESSION_SQL}, {ORDERS_SQL}, last AS (SELECT customer_id, MAX(order_date) AS last_order FROM ord GROUP BY 1)
    SELECT round_even((SELECT SUM(cost) FROM priced) / (SELECT COUNT(*) FROM events WHERE event_type = 'signup'), 4) AS customer_acquisition_cost,
    (SELECT round_even(COUNT(*) FILTER (DATE '{AS_OF}' - last_order > 90) / CAST(COUNT(*) AS DOUBLE), 6) FROM last) AS churn_rate,
    (SELECT round_even(SUM(conversion_flag) / CAST(COUNT(*) AS DOUBLE), 6) FROM sess) AS conversion_rate""",
)
def kpi_placeholders(t: Tables) -> DataFrame:
    last = orders(t).groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    return M.kpi_parts(campaigns(t), t.events.where(F.col("event_type") == "signup"), last, session_rows(t), AS_OF)


@query(
    "item_affinity",
    f"""WITH {LINES_SQL}, b AS (SELECT DISTINCT order_id, p_type AS item FROM line JOIN part ON p_partkey = product_id),
    s AS (SELECT item, COUNT(*) AS n FROM b GROUP BY 1), total AS (SELECT COUNT(DISTINCT order_id) AS n FROM b),
    p AS (SELECT x.item AS item_a, y.item AS item_b, COUNT(*) AS together FROM b x JOIN b y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2)
    SELECT item_a, item_b, together, round_even(together * (SELECT n FROM total) / CAST(sa.n * sb.n AS DOUBLE), 6) AS lift
    FROM p JOIN s sa ON sa.item = item_a JOIN s sb ON sb.item = item_b""",
)
def item_affinity(t: Tables) -> DataFrame:
    baskets = (
        t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .join(products(t).select("product_id", "category"), "product_id")
    )
    return M.basket_affinity(baskets, "order_id", "category")


@query(
    "product_affinity",
    """WITH b AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS item FROM lineitem),
    s AS (SELECT item, COUNT(*) AS n FROM b GROUP BY 1), total AS (SELECT COUNT(DISTINCT order_id) AS n FROM b),
    p AS (SELECT x.item AS item_a, y.item AS item_b, COUNT(*) AS together FROM b x JOIN b y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2)
    SELECT item_a, item_b, together, round_even(together * (SELECT n FROM total) / CAST(sa.n * sb.n AS DOUBLE), 6) AS lift
    FROM p JOIN s sa ON sa.item = item_a JOIN s sb ON sb.item = item_b""",
)
def product_affinity(t: Tables) -> DataFrame:
    """Products bought together. An order has a bounded number of lines, so the pairs grow with the orders."""
    return M.basket_affinity(t.lineitem, "l_orderkey", "l_partkey")


@query(
    "price_elasticity",
    f"""WITH {LINES_SQL}, p AS (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS q, {_money('price')} AS r FROM line GROUP BY 1)
    SELECT p_type AS category, COUNT(*) AS products, round_even(regr_slope(ln(q), ln(r / q)), 6) AS elasticity
    FROM p JOIN part ON p_partkey = product_id GROUP BY 1""",
)
def price_elasticity(t: Tables) -> DataFrame:
    return M.price_elasticity(lines(t), products(t))


@query(
    "journey_paths",
    """WITH f AS (SELECT user_id, event_type, MIN(ts) AS seen FROM events GROUP BY 1, 2),
    p AS (SELECT user_id, string_agg(event_type, ' > ' ORDER BY seen, event_type) AS path FROM f GROUP BY 1)
    SELECT path, COUNT(*) AS users FROM p GROUP BY 1""",
)
def journey_paths(t: Tables) -> DataFrame:
    return M.first_touch_paths(t.events, "user_id", "ts", "event_type")


@query(
    "funnel",
    """WITH f AS (SELECT user_id, MIN(ts) FILTER (event_type = 'view') AS a, MIN(ts) FILTER (event_type = 'click') AS b,
      MIN(ts) FILTER (event_type = 'purchase') AS c FROM events GROUP BY 1),
    n AS (SELECT COUNT(*) FILTER (a IS NOT NULL) AS x, COUNT(*) FILTER (a IS NOT NULL AND b >= a) AS y,
      COUNT(*) FILTER (a IS NOT NULL AND b >= a AND c >= b) AS z FROM f)
    SELECT 1 AS step_number, 'view' AS step, x AS users, CAST(1 AS DOUBLE) AS conversion FROM n
    UNION ALL SELECT 2, 'click', y, round_even(y / nullif(CAST(x AS DOUBLE), 0), 6) FROM n
    UNION ALL SELECT 3, 'purchase', z, round_even(z / nullif(CAST(y AS DOUBLE), 0), 6) FROM n""",
)
def funnel(t: Tables) -> DataFrame:
    return M.funnel(t.events, "user_id", "ts", "event_type", ["view", "click", "purchase"])
