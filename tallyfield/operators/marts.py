"""Daily performance marts: products, campaigns, categories, support, sessions, reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.numbers import cents, ratio, rounded, share
from tallyfield.operators.cohorts import growth
from tallyfield.operators.timeline import sessions
from tallyfield.session import durable


def product_performance(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """Units, revenue, rating, return rate and stock turnover per product and day.

    Lines shrink to (product, day) before the product table is joined.
    """
    daily = lines.groupBy("product_id", F.col("ship_date").alias("metric_date")).agg(
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        (F.sum(cents("price")) / F.lit(100.0)).alias("revenue"),
        rounded(F.avg("rating"), 4).alias("avg_rating"),
        F.count("rating").alias("review_count"),
        share(F.count_if(F.col("return_flag") == "R"), F.count(F.lit(1))).alias("return_rate"),
    )
    return daily.join(stock, "product_id", "left").select(
        *daily.columns, rounded(ratio("units_sold", "stock_quantity"), 6).alias("stock_turnover")
    )


def campaign_performance(events: DataFrame, cost: Column) -> DataFrame:
    """Click, conversion and cost ratios per campaign and day."""
    daily = events.groupBy("campaign_id", "metric_date").agg(
        F.count_if(F.col("event_type") == "view").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("conversions"),
        (F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", cents("value"))), F.lit(0)) / F.lit(100.0)).alias("revenue"),
    )
    return daily.withColumn("cost", rounded(cost, 2)).withColumns(
        {
            "ctr": share("clicks", "impressions"),
            "conversion_rate": share("conversions", "clicks"),
            "roas": share("revenue", "cost"),
            "cpa": share("cost", "conversions"),
        }
    )


def category_performance(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, price, margin, market share and growth per category and month.

    The share window runs over categories of one month, the growth window over the months
    of one category: both hold rows that are already aggregated.
    """
    per_product = lines.groupBy("product_id", F.trunc("ship_date", "month").alias("report_date")).agg(
        F.sum(cents("price")).alias("c"), F.sum(F.col("quantity").cast("bigint")).alias("q")
    )
    monthly = (
        per_product.join(products, "product_id")
        .groupBy("category", "subcategory", "report_date")
        .agg(
            F.sum("c").alias("_c"),
            F.sum("q").alias("units_sold"),
            F.sum(F.col("q") * cents("unit_cost")).alias("_cost"),
        )
    )
    whole = F.sum("_c").over(Window.partitionBy("report_date"))
    table = monthly.select(
        "category", "subcategory", "report_date",
        (F.col("_c") / F.lit(100.0)).alias("revenue"),
        "units_sold",
        rounded(F.col("_c") / F.lit(100.0) / F.col("units_sold"), 4).alias("avg_price"),
        share(F.col("_c") - F.col("_cost"), "_c").alias("profit_margin"),
        share("_c", whole).alias("market_share"),
    )
    return growth(table, ["category", "subcategory"], "report_date", "revenue")


def support_sla(tickets: DataFrame) -> DataFrame:
    """Hours to resolution and satisfaction by issue type and priority."""
    hours = F.timestamp_diff("SECOND", F.col("created_date").cast("timestamp"), F.col("resolved_date").cast("timestamp")) / 3600
    return tickets.groupBy("issue_type", "priority").agg(
        F.count(F.lit(1)).alias("tickets"),
        F.count("resolved_date").alias("resolved"),
        rounded(F.avg(hours), 4).alias("mean_hours"),
        rounded(F.avg("satisfaction_score"), 4).alias("mean_satisfaction"),
    )


def session_table(events: DataFrame, user: str, ts: str, tie: str, gap_seconds: int = 1800,
                  converted: str = "purchase", kind: str = "event_type") -> DataFrame:
    """One row per web session: start, end, pages, duration and conversion."""
    marked = sessions(events.select(user, ts, tie, kind), [user], ts, tie, gap_seconds)
    return marked.groupBy(user, "session_start").agg(
        F.max(ts).alias("session_end"),
        F.count(F.lit(1)).alias("pages_viewed"),
        F.max((F.col(kind) == converted).cast("int")).alias("conversion_flag"),
    ).withColumn(
        "duration_seconds",
        rounded((F.unix_micros(F.col("session_end").cast("timestamp")) - F.unix_micros(F.col("session_start").cast("timestamp"))) / F.lit(1e6), 3),
    )


def session_behaviour(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sessions, pages, bounce share, duration and conversion by device or source."""
    return table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("pages_viewed").alias("pages"),
        share(F.count_if(F.col("pages_viewed") == 1), F.count(F.lit(1))).alias("bounce_rate"),
        share(F.count(F.lit(1)), F.sum("pages_viewed")).alias("exit_page_rate"),
        rounded(F.avg("duration_seconds"), 3).alias("mean_duration"),
        rounded(F.sum("duration_seconds") / F.nullif(F.sum(F.col("pages_viewed") - 1), F.lit(0)), 3).alias("mean_time_on_page"),
        share(F.sum("conversion_flag"), F.count(F.lit(1))).alias("conversion_rate"),
    )


def review_stats(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        rounded(F.avg("rating"), 4).alias("avg_rating"),
        F.count(F.lit(1)).alias("review_count"),
        F.sum(F.col("helpful_votes").cast("bigint")).alias("helpful_votes"),
        share(F.count_if("verified_purchase"), F.count(F.lit(1))).alias("verified_share"),
    )


def kpi_parts(campaigns: DataFrame, signups: DataFrame, last_orders: DataFrame, table: DataFrame, as_of: str) -> DataFrame:
    """The three KPI measures the executive row holds as constants.

    Each is a one-row aggregate; two enter the third as scalar subqueries.
    """
    cost = campaigns.agg(F.sum("cost").alias("cost")).scalar()
    new = signups.agg(F.count(F.lit(1)).alias("n")).scalar()
    idle = F.datediff(F.lit(as_of).cast("date"), F.col("last_order")) > 90
    churn = last_orders.agg(share(F.count_if(idle), F.count(F.lit(1))).alias("churn")).scalar()
    return table.agg(share(F.sum("conversion_flag"), F.count(F.lit(1))).alias("conversion_rate")).select(
        rounded(ratio(cost, new), 4).alias("customer_acquisition_cost"), churn.alias("churn_rate"), "conversion_rate"
    )


def basket_affinity(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """Lift of items bought together.

    ``item`` must be a category of a small catalogue, or baskets must be bounded. They first shrink
    to their set of items and equal sets to one row with a count; pairs are formed from those
    sets only, so neither a huge basket of few categories nor a popular set multiplies rows.
    """
    baskets = lines.groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))
    shapes = durable(baskets.groupBy("items").agg(F.count(F.lit(1)).alias("n")))
    total = shapes.agg(F.sum("n").alias("n")).scalar()
    singles = shapes.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n"))
    pairs = (
        shapes.select(F.explode("items").alias("item_a"), "items", "n")
        .select("item_a", F.explode("items").alias("item_b"), "n")
        .where(F.col("item_a") < F.col("item_b"))
        .groupBy("item_a", "item_b")
        .agg(F.sum("n").alias("together"))
    )
    a = singles.select(F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    b = singles.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    lift = ratio(F.col("together") * total, F.col("n_a") * F.col("n_b"))
    return pairs.join(a, "item_a").join(b, "item_b").select("item_a", "item_b", "together", rounded(lift, 6).alias("lift"))


def price_elasticity(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Log-log slope of units on mean price over the products of a category."""
    per_product = lines.groupBy("product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("q"), F.sum(cents("price")).alias("c")
    )
    x = F.ln(F.col("c") / F.lit(100.0) / F.col("q"))
    return (
        per_product.join(products, "product_id")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("products"), rounded(F.regr_slope(F.ln("q"), x), 6).alias("elasticity"))
    )


def first_touch_paths(events: DataFrame, user: str, ts: str, kind: str) -> DataFrame:
    """Users per order in which the event kinds first occurred.

    A user shrinks to one first time per kind, so a path has as many steps as kinds.
    """
    firsts = events.groupBy(user, kind).agg(F.min(ts).alias("_at"))
    path = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", kind))), lambda s: s.getField(kind)), " > "
    )
    return firsts.groupBy(user).agg(path.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("users"))


def funnel(events: DataFrame, user: str, ts: str, kind: str, steps: Sequence[str]) -> DataFrame:
    """Users who reached each step at or after the step before, by first times."""
    firsts = events.groupBy(user).agg(
        *[F.min(F.when(F.col(kind) == s, F.col(ts))).alias(f"t{i}") for i, s in enumerate(steps)]
    )
    reached, counts = F.lit(True), []
    for i, step in enumerate(steps):
        ordered = F.col(f"t{i}").isNotNull() if i == 0 else F.col(f"t{i}") >= F.col(f"t{i - 1}")
        reached = reached & F.coalesce(ordered, F.lit(False))
        counts.append(F.count_if(reached).alias(f"n{i}"))
    lines = [
        F.struct(
            F.lit(i + 1).alias("step_number"), F.lit(s).alias("step"), F.col(f"n{i}").alias("users"),
            (F.lit(1.0) if i == 0 else share(f"n{i}", f"n{i - 1}")).alias("conversion"),
        )
        for i, s in enumerate(steps)
    ]
    return firsts.agg(*counts).select(F.explode(F.array(*lines)).alias("x")).select("x.*")
