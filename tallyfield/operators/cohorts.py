"""Cohort retention, lifetime value, tiers and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.buckets import at_least
from tallyfield.functions.dates import days_between, month_start, months_crossed
from tallyfield.functions.numbers import cents, floored_divisor, mean_gap, ratio, rounded, share
from tallyfield.operators.joins import with_own_base
from tallyfield.operators.ordering import global_percentiles
from tallyfield.session import durable

# Tier names from the highest quantile down.
TIER_QUANTILES = [0.8, 0.6, 0.4, 0.2]
CLV_TIERS = ["High Value", "Medium-High Value", "Medium Value", "Medium-Low Value", "Low Value"]
FREQUENCY_TIERS = ["Very Frequent", "Frequent", "Moderate", "Occasional", "Rare"]


def registrations(orders: DataFrame) -> DataFrame:
    """First order of any status as the registration day, for sources without one."""
    return orders.groupBy("customer_id").agg(F.min("order_date").alias("registration_date"))


def cohort_activity(completed: DataFrame, registered: DataFrame, customer: str = "customer_id",
                    order: str = "order_id", amount: str = "amount", day: str = "order_date",
                    since: str = "registration_date") -> DataFrame:
    """One row per (customer, active month) with cohort month and period.

    Orders shrink to months before the join. A period may be negative and is kept.
    """
    monthly = completed.groupBy(customer, month_start(day).alias("order_month")).agg(
        F.countDistinct(order).alias("orders"),
        F.sum(cents(amount)).alias("cents"),
        F.count(amount).alias("amounts"),
    )
    return monthly.join(registered.select(customer, month_start(since).alias("cohort_month")), customer).withColumn(
        "period_number", months_crossed("cohort_month", "order_month")
    )


def cohort_table(activity: DataFrame) -> DataFrame:
    """Customers, revenue, orders and retention per (cohort, period).

    A customer has one activity row per month, so distinct customers are plain counts.
    """
    cells = activity.groupBy("cohort_month", "period_number").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum("cents") / F.lit(100.0)).alias("revenue"),
        F.sum("orders").alias("orders"),
        rounded(F.sum("cents") / F.lit(100.0) / F.sum("amounts"), 4).alias("avg_order_value"),
    )
    return with_own_base(cells, "cohort_month", "period_number", "customers", "cohort_size").withColumns(
        {
            "retention_rate": share("customers", "cohort_size"),
            "revenue_per_customer": rounded(F.col("revenue") / F.col("customers"), 4),
            "orders_per_customer": rounded(F.col("orders") / F.col("customers"), 6),
        }
    )


def cohort_mart(metrics: DataFrame, run_day: str) -> DataFrame:
    """The daily mart: one period per cohort, so its retention is 1 by construction."""
    grouped = (
        metrics.withColumn("cohort_month", month_start("first_order"))
        .withColumn("period_number", months_crossed("cohort_month", F.lit(run_day).cast("date")))
        .groupBy("cohort_month", "period_number")
        .agg(
            F.count("customer_id").alias("customers_count"),
            F.sum(cents("total_spent")).alias("_cents"),
        )
    )
    return ratio_to_first(grouped, "cohort_month", "period_number", "customers_count", "retention_rate").select(
        "cohort_month",
        "period_number",
        "customers_count",
        "retention_rate",
        rounded(F.col("_cents") / F.lit(100.0) / F.col("customers_count"), 4).alias("avg_revenue_per_user"),
        (F.col("_cents") / F.lit(100.0)).alias("cumulative_revenue"),
    )


def ratio_to_first(small: DataFrame, key: str, order: str, measure: str, out: str) -> DataFrame:
    """Measure over its first value in the key, on rows that are already aggregated."""
    first = F.first_value(measure).over(Window.partitionBy(key).orderBy(order))
    return small.withColumn(out, share(measure, first))


def running_revenue(table: DataFrame) -> DataFrame:
    """Cumulative revenue by period within each cohort (months per cohort, so small)."""
    along = Window.partitionBy("cohort_month").orderBy("period_number").rowsBetween(Window.unboundedPreceding, 0)
    return table.select(
        "cohort_month", "period_number", (F.sum(cents("revenue")).over(along) / F.lit(100.0)).alias("cumulative_revenue")
    )


def clv_metrics(completed: DataFrame, customer: str = "customer_id", order: str = "order_id",
                amount: str = "amount", day: str = "order_date") -> DataFrame:
    """Purchase frequency per year and two-year value per customer.

    The factors 365 and 1/365 of the published formula cancel and are left out.
    """
    base = completed.groupBy(customer).agg(
        F.min(day).alias("first_purchase"),
        F.max(day).alias("last_purchase"),
        F.countDistinct(order).alias("total_orders"),
        (F.sum(cents(amount)) / F.lit(100.0)).alias("total_revenue"),
        rounded(F.sum(cents(amount)) / F.lit(100.0) / F.count(amount), 4).alias("avg_order_value"),
    )
    span = days_between("first_purchase", "last_purchase").cast("double")
    years = floored_divisor(F.col("customer_lifespan") / F.lit(365.0), 1.0 / 365)
    frequency = F.col("total_orders") / years  # rounded for output only
    return (
        base.withColumn("customer_lifespan", span)
        .withColumn("avg_days_between_orders", rounded(mean_gap("customer_lifespan", "total_orders"), 6))
        .withColumn("purchase_frequency", rounded(frequency, 6))
        .withColumn("predicted_clv", rounded(F.col("total_revenue") * frequency * 2, 2))
    )


def quantile_tiers(metrics: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Value and frequency tiers by exact quantile limits; limits are inclusive."""
    metrics = durable(metrics)
    limits = global_percentiles(
        metrics,
        {"clv": F.col("predicted_clv"), "frequency": F.col("purchase_frequency")},
        TIER_QUANTILES,
        customer,
    )
    return metrics.withColumns(
        {
            "clv_segment": at_least("predicted_clv", limits["clv"], CLV_TIERS),
            "frequency_segment": at_least("purchase_frequency", limits["frequency"], FREQUENCY_TIERS),
        }
    )


def retention_matrix(table: DataFrame) -> DataFrame:
    """Cohorts by period columns, one for every period of the table, negative ones too.

    The table holds one row per (cohort, period); it is written once, because the periods are looked up first.
    """
    cells = durable(table.select("cohort_month", "period_number", "retention_rate"))
    periods = sorted(r[0] for r in cells.select("period_number").distinct().collect() if r[0] is not None)
    wide = cells.groupBy("cohort_month").pivot("period_number", periods).agg(F.first("retention_rate"))
    return wide.select("cohort_month", *[F.col(f"`{p}`").alias(f"Period_{p}") for p in periods])


def retention_lines(table: DataFrame) -> DataFrame:
    """Cohorts with all their periods in one row each, in order; no period is looked up, so no column depends on the data."""
    rate = F.coalesce(F.rint(F.col("retention_rate") * 1_000_000).cast("bigint").cast("string"), F.lit("-"))
    cells = F.array_sort(F.collect_list(F.struct("period_number", rate.alias("rate"))))
    rows = table.groupBy("cohort_month").agg(cells.alias("c"))
    line = lambda field: F.array_join(F.transform("c", lambda x: x[field].cast("string")), ",")
    return rows.select("cohort_month", line("period_number").alias("periods"), line("rate").alias("rates"))


def melt_table(table: DataFrame) -> DataFrame:
    """The filled cells of the matrix in long form, straight from the table."""
    period = F.concat(F.lit("Period_"), F.col("period_number").cast("string")).alias("period")
    return table.where(F.col("retention_rate").isNotNull()).select("cohort_month", period, "retention_rate")


def cohort_report(table: DataFrame, metrics: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Headline numbers: retention after 1, 6 and 12 months, CLV, revenue of the top fifth."""
    metrics = durable(metrics)
    found = global_percentiles(metrics, {"clv": F.col("predicted_clv")}, [0.5, 0.8], customer)["clv"]
    retention = table.agg(
        F.struct(
            *[
                rounded(F.avg(F.when(F.col("period_number") == p, F.col("customers") / F.col("cohort_size"))), 6).alias(
                    f"retention_month_{p}"
                )
                for p in (1, 6, 12)
            ]
        ).alias("r")
    ).scalar()
    top = F.sum(F.when(F.col("predicted_clv") >= F.lit(found[1]), cents("total_revenue")))
    return metrics.agg(
        F.count(F.lit(1)).alias("total_customers"),
        (F.sum(cents("total_revenue")) / F.lit(100.0)).alias("total_revenue"),
        rounded(F.sum(cents("predicted_clv")) / F.lit(100.0) / F.count("predicted_clv"), 2).alias("avg_clv"),
        share(top, F.sum(cents("total_revenue"))).alias("top_fifth_revenue_share"),
    ).select(
        "*",
        rounded(F.lit(found[0]), 2).alias("median_clv"),
        *[retention.getField(f"retention_month_{p}").alias(f"retention_month_{p}") for p in (1, 6, 12)],
    )


def monthly_revenue(table: DataFrame) -> DataFrame:
    """Revenue per calendar month from cohort month plus period."""
    month = F.add_months("cohort_month", F.col("period_number")).alias("order_month")
    sums = table.groupBy(month).agg((F.sum(cents("revenue")) / F.lit(100.0)).alias("total_revenue"))
    return sums.where(F.col("order_month").isNotNull())


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins; the largest value falls into the last bin.

    The bounds need a pass of their own, so the column is written once first.
    """
    df = durable(df.select(value))
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    spot = F.floor((F.col(value) - low) * bins / F.nullif(high - low, F.lit(0.0)))
    slot = F.least(F.greatest(F.coalesce(spot, F.lit(0)), F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(value).isNotNull()).groupBy((slot + 1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def five_numbers(small: DataFrame, key: str, value: str) -> DataFrame:
    """Box-plot numbers per key, for a frame with one row per (cohort, key)."""
    names = ["low", "lower_quartile", "median", "upper_quartile", "high"]
    found = F.percentile(value, F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return small.groupBy(key).agg(found.alias("q"), F.count(value).alias("n")).select(
        key, "n", *[rounded(F.col("q")[i], 4).alias(n) for i, n in enumerate(names)]
    )


def linear_trend(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line of y on x."""
    return df.agg(
        F.regr_count(y, x).alias("n"),
        rounded(F.regr_slope(y, x), 3).alias("slope"),
        rounded(F.regr_intercept(y, x), 1).alias("intercept"),
        rounded(F.regr_r2(y, x), 6).alias("r2"),
    )


def active_months(orders: DataFrame) -> DataFrame:
    """One row per (customer, month) with revenue in cents."""
    return orders.groupBy("customer_id", month_start("order_date").alias("month")).agg(
        F.sum(cents("amount")).alias("cents")
    )


def recurring_revenue(orders: DataFrame) -> DataFrame:
    """Revenue per month from customers who were also active in the month before.

    Rows per customer are months, so the window stays small for any customer.
    """
    before = F.lag("month").over(Window.partitionBy("customer_id").orderBy("month"))
    marked = active_months(orders).withColumn("_stays", before == F.add_months("month", -1))
    return marked.groupBy("month").agg(
        F.coalesce(F.sum(F.when(F.col("_stays"), F.col("cents"))) / F.lit(100.0), F.lit(0.0)).alias("mrr"),
        F.count_if(F.coalesce("_stays", F.lit(False))).alias("recurring_customers"),
    )


def monthly_churn(orders: DataFrame) -> DataFrame:
    """Of the customers active in a month, the share not active in the next one."""
    after = F.lead("month").over(Window.partitionBy("customer_id").orderBy("month"))
    rows = active_months(orders).withColumn("_stays", F.coalesce(after == F.add_months("month", 1), F.lit(False)))
    return rows.groupBy(F.add_months("month", 1).alias("month")).agg(
        F.count(F.lit(1)).alias("active_before"),
        F.count_if(~F.col("_stays")).alias("churned"),
        share(F.count_if(~F.col("_stays")), F.count(F.lit(1))).alias("churn_rate"),
    )


def growth(small: DataFrame, keys: Sequence[str], period: str, measure: str, out: str = "growth_rate") -> DataFrame:
    """(now - previous) / previous per key, on one row per key and period."""
    before = F.lag(measure).over(Window.partitionBy(*keys).orderBy(period))
    return small.withColumn(out, rounded(ratio(F.col(measure) - before, before), 6))

