"""Customer metrics, RFM scores, segments and their reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.dates import days_between, month_start, whole_day
from tallyfield.functions.numbers import cents, money_mean, money_sum, rounded, share
from tallyfield.operators.ordering import quantile_scores
from tallyfield.session import durable

# Score codes (recency, frequency, monetary digit) of each segment; the first
# list that holds a code wins, every other code is Lost. All codes of the sixth list are
# already taken by the fifth, so that segment never occurs.
SEGMENT_CODES = {
    "Champions": ["555", "554", "544", "545", "454", "455", "445"],
    "Loyal Customers": ["543", "444", "435", "355", "354", "345", "344", "335"],
    "Potential Loyalists": ["512", "511", "422", "421", "412", "411", "311"],
    "New Customers": ["534", "343", "334", "325", "324"],
    "At Risk": ["155", "154", "144", "214", "215", "115", "114"],
    "Cannot Lose Them": ["155", "154", "144", "214", "215", "115"],
    "Need Attention": ["332", "322", "231", "241", "251", "233", "232"],
}
DEFAULT_SEGMENT = "Lost"

# Advice text per segment.
RECOMMENDATIONS = {
    "Champions": "Reward with exclusive offers, early access to new products",
    "Loyal Customers": "Up-sell and cross-sell, referral programs",
    "Potential Loyalists": "Membership programs, personalized recommendations",
    "New Customers": "Welcome campaigns, onboarding programs",
    "At Risk": "Win-back campaigns, special discounts",
    "Cannot Lose Them": "Dedicated account manager, premium support",
    "Need Attention": "Re-engagement campaigns, surveys for feedback",
    "Lost": "Aggressive win-back campaigns, exit surveys",
}

# Display names of cluster ids for four and five clusters.
CLUSTER_NAMES = {
    4: ["Price Sensitive", "High Value", "Regular Customers", "New Customers"],
    5: ["Champions", "Loyal Customers", "At Risk", "New Customers", "Lost Customers"],
}


def customer_metrics(orders: DataFrame, as_of: str, customer: str = "customer_id", order: str = "order_id",
                     amount: str = "amount", day: str = "order_date") -> DataFrame:
    """Orders, spend, first and last order, recency and lifetime per customer."""
    return (
        orders.groupBy(customer)
        .agg(
            F.count(order).alias("total_orders"),
            money_sum(amount).alias("total_spent"),
            money_mean(amount, 2).alias("avg_order_value"),
            F.min(day).alias("first_order"),
            F.max(day).alias("last_order"),
        )
        .withColumn("days_since_last_order", days_between("last_order", F.lit(as_of).cast("date")))
        .withColumn("customer_lifetime_days", days_between("first_order", "last_order"))
    )


def customer_360(people: DataFrame, orders: DataFrame, as_of: str, customer: str = "customer_id",
                 order: str = "order_id", amount: str = "amount", day: str = "order_date") -> DataFrame:
    """All customer columns plus order totals; customers without orders stay with count 0.

    Orders are aggregated before the join, so one row per customer is shuffled instead of
    one row per order with all customer columns as the grouping key.
    """
    totals = orders.groupBy(customer).agg(
        F.count(order).alias("total_orders"),
        money_sum(amount).alias("total_spent"),
        money_mean(amount).alias("avg_order_value"),
        F.max(day).alias("last_order_date"),
        F.min(day).alias("first_order_date"),
    )
    return (
        people.join(totals, customer, "left")
        .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
        .withColumn("days_since_last_order", days_between("last_order_date", F.lit(as_of).cast("date")))
    )


def segmentation_extract(completed: DataFrame, as_of: str, customer: str = "customer_id",
                         order: str = "order_id", amount: str = "amount", day: str = "order_date") -> DataFrame:
    """Per customer with at least one completed order: orders, revenue, recency, activity.

    Two distinct counts in one aggregate would multiply the input rows. An order has one
    date, so distinct orders are counted per (customer, month) and months are rows.
    """
    monthly = completed.groupBy(customer, month_start(day).alias("_month")).agg(
        F.countDistinct(order).alias("_orders"),
        F.sum(cents(amount)).alias("_cents"),
        F.count(amount).alias("_amounts"),
        F.min(day).alias("_first"),
        F.max(day).alias("_last"),
    )
    return (
        monthly.groupBy(customer)
        .agg(
            F.sum("_orders").alias("total_orders"),
            (F.sum("_cents") / F.lit(100.0)).alias("total_revenue"),
            rounded(F.sum("_cents") / F.lit(100.0) / F.sum("_amounts"), 4).alias("avg_order_value"),
            F.max("_last").alias("last_order_date"),
            F.min("_first").alias("first_order_date"),
            F.count("_month").alias("active_months"),
        )
        .withColumn("days_since_last_order", days_between("last_order_date", F.lit(as_of).cast("date")))
        .withColumn("customer_lifespan", days_between("first_order_date", "last_order_date"))
    )


def rfm_scores(metrics: DataFrame, customer: str, recency: str, frequency: str, monetary: str) -> DataFrame:
    """Exact quintile scores; recency is reversed. Ties are ordered by customer."""
    metrics = durable(metrics)
    scored = quantile_scores(
        metrics,
        {
            "recency_score": (F.col(recency), True),
            "frequency_score": (F.col(frequency), False),
            "monetary_score": (F.col(monetary), False),
        },
        customer,
    )
    code = F.concat(*[F.col(c).cast("string") for c in ("recency_score", "frequency_score", "monetary_score")])
    return scored.withColumn("rfm_score", code)


def segment_of(code: Column | str) -> Column:
    """Segment of a three-digit score code, by one literal map."""
    first_hit: dict[str, str] = {}
    for segment, codes in SEGMENT_CODES.items():
        for item in codes:
            first_hit.setdefault(item, segment)
    pairs = [F.lit(x) for item in first_hit.items() for x in item]
    value = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(value, F.lit(""))), F.lit(DEFAULT_SEGMENT))


def rfm_segments(metrics: DataFrame, customer: str = "customer_id", recency: str = "days_since_last_order",
                 frequency: str = "total_orders", monetary: str = "total_revenue") -> DataFrame:
    """RFM roles, scores, code and segment."""
    roles = metrics.withColumns(
        {"recency": F.col(recency), "frequency": F.col(frequency), "monetary": F.col(monetary)}
    )
    return rfm_scores(roles, customer, "recency", "frequency", "monetary").withColumn(
        "segment", segment_of("rfm_score")
    )


def recommendation(segment: Column | str) -> Column:
    pairs = [F.lit(x) for item in RECOMMENDATIONS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(segment) if isinstance(segment, str) else segment)


def segment_insights(rfm: DataFrame) -> DataFrame:
    """Counts, means, revenue, revenue share and advice per segment."""
    by_segment = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        rounded(F.avg("recency"), 4).alias("avg_recency"),
        rounded(F.avg("frequency"), 4).alias("avg_frequency"),
        money_mean("monetary").alias("avg_monetary"),
        rounded(F.avg("avg_order_value"), 4).alias("avg_order_value"),
        money_sum("monetary").alias("total_revenue"),
    )
    return add_share(by_segment, "total_revenue", "revenue_percentage", 100).withColumn(
        "recommendation", recommendation("segment")
    )


def add_share(small: DataFrame, measure: str, name: str, scale: float = 1.0, digits: int = 4) -> DataFrame:
    """Share of the grand total, for a frame with one row per segment or class.

    The window runs over those few rows; a second aggregate would compute them twice.
    """
    total = F.sum(measure).over(Window.partitionBy())
    return small.withColumn(name, rounded(F.try_divide(F.col(measure) * F.lit(scale), total), digits))


def segment_summary(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(
        F.count("customer_id").alias("customer_count"),
        rounded(F.avg("recency"), 2).alias("recency_mean"),
        rounded(F.avg("frequency"), 2).alias("frequency_mean"),
        rounded(F.sum(cents("monetary")) / F.lit(100.0) / F.count("monetary"), 2).alias("monetary_mean"),
        money_sum("monetary").alias("monetary_sum"),
        rounded(F.avg("avg_order_value"), 2).alias("avg_order_value_mean"),
    )


def segment_metrics(rfm: DataFrame) -> DataFrame:
    """The four-column variant of the summary."""
    return rfm.groupBy("segment").agg(
        F.count("customer_id").alias("customer_id"),
        money_sum("monetary").alias("monetary"),
        rounded(F.avg("avg_order_value"), 4).alias("avg_order_value"),
        rounded(F.avg("frequency"), 4).alias("frequency"),
    )


def cluster_summary(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    means = {
        "Avg_Recency": "recency",
        "Avg_Frequency": "frequency",
        "Avg_Monetary": "monetary",
        "Avg_Order_Value": "avg_order_value",
        "Avg_Lifespan": "customer_lifespan",
    }
    return labelled.groupBy(cluster).agg(
        *[rounded(F.avg(c), 2).alias(n) for n, c in means.items()],
        F.count("customer_id").alias("Customer_Count"),
    )


def cluster_name(cluster: Column | str, k: int) -> Column:
    """Display name of a cluster id: fixed names for k of 4 and 5, else ``Cluster_i``."""
    value = F.col(cluster) if isinstance(cluster, str) else cluster
    names = CLUSTER_NAMES.get(k)
    if names is None:
        return F.concat(F.lit("Cluster_"), value.cast("string"))
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), (value + 1).cast("int"))


def rfm_crosstab(rfm: DataFrame) -> DataFrame:
    """Customers by (recency, frequency) score and monetary score.

    The score values are listed, so no extra job looks for them.
    """
    counts = (
        rfm.groupBy("recency_score", "frequency_score").pivot("monetary_score", [1, 2, 3, 4, 5]).count()
    )
    counts = counts.na.fill(0)
    return counts.select(
        "recency_score", "frequency_score", *[F.col(str(i)).alias(f"monetary_{i}") for i in range(1, 6)]
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value, most frequent first.

    There may be many values, so the total is a row count of the input: a scan without
    columns instead of a window over all values.
    """
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", share("n", total)).orderBy(F.desc("n"), "value")


def hierarchy_rollup(df: DataFrame, levels: Sequence[str], measure: str) -> DataFrame:
    """Sums down a hierarchy of columns with the grouping level."""
    return df.rollup(*levels).agg(
        money_sum(measure).alias(f"{measure}_sum"), F.grouping_id().cast("bigint").alias("level")
    )


def executive_kpis(orders: DataFrame, run_day: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """The one KPI row of a day.

    Lifetime totals are computed for the customers of that day only; the day filter is a
    range on the raw column. ``extra`` replaces the three constant measures.
    """
    today = orders.where(whole_day("order_date", run_day))
    buyers = today.select("customer_id").distinct()
    metrics = (
        orders.join(buyers, "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_order"), F.sum(cents("amount")).alias("total_spent"))
    )
    per_customer = (
        today.groupBy("customer_id")
        .agg(
            F.sum(cents("amount")).alias("c"),
            F.countDistinct("order_id").alias("orders"),
            F.count("amount").alias("n"),
        )
        .join(metrics, "customer_id")
    )
    day = F.lit(run_day).cast("date")
    constants = {
        "customer_acquisition_cost": F.lit(0.0),
        "churn_rate": F.lit(0.0),
        "conversion_rate": F.lit(0.0),
        **(extra or {}),
    }
    return per_customer.agg(
        (F.sum("c") / F.lit(100.0)).alias("total_revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.count_if(F.to_date("first_order") == day).alias("new_customers"),
        F.count_if(F.to_date("first_order") < day).alias("returning_customers"),
        rounded(F.sum("c") / F.lit(100.0) / F.sum("n"), 4).alias("avg_order_value"),
        rounded(F.sum(F.col("total_spent") * F.col("n")) / F.lit(100.0) / F.sum("n"), 4).alias(
            "customer_lifetime_value"
        ),
        F.count(F.lit(1)).alias("monthly_active_users"),
    ).withColumns({"report_date": day, **constants})


def fact_customer_metrics(orders: DataFrame, as_of: str) -> DataFrame:
    """The per-customer fact of one day: metrics, lifetime value, scores and segment."""
    return fact_of_metrics(customer_metrics(orders, as_of), as_of)


def fact_of_metrics(base: DataFrame, as_of: str) -> DataFrame:
    """The fact from rows of ``customer_metrics``, which are read more than once."""
    years = F.greatest(F.col("customer_lifetime_days") / F.lit(365.0), F.lit(1.0 / 365.0))
    clv = rounded(F.col("total_spent") * (F.col("total_orders") / years) * 2, 2)
    scored = rfm_scores(base, "customer_id", "days_since_last_order", "total_orders", "total_spent")
    return scored.select(
        "customer_id",
        F.lit(as_of).cast("date").alias("metric_date"),
        "total_orders",
        F.col("total_spent").alias("total_revenue"),
        "avg_order_value",
        "days_since_last_order",
        clv.alias("lifetime_value"),
        "recency_score",
        "frequency_score",
        "monetary_score",
        segment_of("rfm_score").alias("rfm_segment"),
    )
