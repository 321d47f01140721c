"""Churn survival: prepared durations and the product-limit curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.dates import days_between
from tallyfield.functions.numbers import cents, rounded

Z95 = 1.959963984540054


def survival_data(completed: DataFrame, as_of: str, idle_days: int = 90, customer: str = "customer_id",
                  order: str = "order_id", amount: str = "amount", day: str = "order_date") -> DataFrame:
    """Churn flag and duration per customer.

    A churned customer's time ends at the last order, so churned one-time buyers have
    time 0 and drop out, as in the reference.
    """
    today = F.lit(as_of).cast("date")
    return (
        completed.groupBy(customer)
        .agg(
            F.min(day).alias("first_purchase"),
            F.max(day).alias("last_purchase"),
            F.countDistinct(order).alias("total_orders"),
            (F.sum(cents(amount)) / F.lit(100.0)).alias("total_revenue"),
        )
        .withColumn("churned", F.when(days_between("last_purchase", today) > idle_days, 1).otherwise(0))
        .withColumn("time_to_last_purchase", days_between("first_purchase", "last_purchase"))
        .withColumn(
            "survival_time",
            F.when(F.col("churned") == 1, F.col("time_to_last_purchase")).otherwise(
                days_between("first_purchase", today)
            ),
        )
        .where(F.col("survival_time") > 0)
    )


def kaplan_meier(durations: DataFrame, time: str = "survival_time", event: str = "churned") -> DataFrame:
    """Survival curve with Greenwood variance and a log-scale 95 % interval.

    Rows are first grouped to whole days. The ordered windows then run over one row per
    distinct day - at most a few ten thousand in a century - whatever the input size.
    """
    days = durations.groupBy(F.col(time).alias("time")).agg(
        F.count(F.lit(1)).alias("leaving"), F.sum(F.col(event).cast("bigint")).alias("n_event")
    )
    onward = Window.orderBy("time").rowsBetween(0, Window.unboundedFollowing)
    upto = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    d, n = F.col("n_event").cast("double"), F.col("n_risk").cast("double")
    left = days.withColumn("n_risk", F.sum("leaving").over(onward)).withColumn(
        "n_censor", F.col("leaving") - F.col("n_event")
    )
    # ln(0) is NULL and would drop out of the sum, so the end of the curve is set apart.
    over = F.max(F.when(d == n, 1).otherwise(0)).over(upto) == 1
    logs = F.sum(F.when(d < n, F.log1p(-d / n))).over(upto)
    greenwood = F.sum(F.when(d < n, d / (n * (n - d)))).over(upto)
    curve = left.select(
        "time", "n_risk", "n_event", "n_censor",
        F.when(over, 0.0).otherwise(F.exp(logs)).alias("_s"),
        F.when(~over, greenwood).alias("_g"),
    )
    s, reach = F.col("_s"), F.lit(Z95) * F.sqrt("_g")
    return curve.select(
        "time", "n_risk", "n_event", "n_censor",
        rounded(s, 6).alias("survival"),
        rounded(s * s * F.col("_g"), 8).alias("variance"),
        rounded(s * F.exp(-reach), 6).alias("lower"),
        rounded(F.when(reach.isNotNull(), F.least(s * F.exp(reach), F.lit(1.0))), 6).alias("upper"),
    )
