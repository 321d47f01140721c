"""The daily warehouse run: check, transform, score, load, marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.buckets import AGE_GROUP, cut
from tallyfield.functions.dates import age_in_365_day_years, calendar_parts
from tallyfield.functions.text import full_name
from tallyfield.operators import cohorts as H
from tallyfield.operators import customers as C
from tallyfield.operators import learners as L
from tallyfield.operators import quality as Q
from tallyfield.operators.frames import stage_customers
from tallyfield.session import durable, stored
from tallyfield.sources import lake
from tallyfield.sources.schemas import schema

# The accepted range of an order amount.
AMOUNT_RANGE = (0, 100000)


def check(customers: DataFrame, orders: DataFrame, amounts: tuple[float, float] = AMOUNT_RANGE) -> DataFrame:
    """The two suites of the run as one report."""
    return Q.report(
        [
            Q.suite(customers, "customer_id", [Q.matches("email")], ["email"]).drop("success"),
            Q.suite(orders, "order_id", [Q.between("amount", *amounts)], ["amount"]).drop("success"),
        ]
    )


def transform_customers(customers: DataFrame, as_of: str) -> DataFrame:
    age = age_in_365_day_years("date_of_birth", F.lit(as_of).cast("date"))
    return customers.withColumns(
        {"full_name": full_name("first_name", "last_name"), "age": age}
    ).withColumn("age_group", cut("age", *AGE_GROUP))


def transform_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumns(calendar_parts("order_date"))


def customer_fact(metrics: DataFrame, as_of: str) -> DataFrame:
    """The customer fact of one run with its declared columns and types, churn probability included.

    ``metrics`` are the customer metrics of the run; only orders up to the run date are known to them.
    """
    fact = durable(C.fact_of_metrics(metrics, as_of))
    churn = L.churn_probabilities(metrics).select("customer_id", "churn_probability")
    return declared(fact.join(churn, "customer_id", "left"), "analytics", "fact_customer_metrics")


def declared(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Columns by name in the declared order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema(layer, table)])


def run_daily(customers: DataFrame, orders: DataFrame, root: str, as_of: str, kpis: Mapping[str, Column] | None = None,
              amounts: tuple[float, float] = AMOUNT_RANGE) -> dict[str, str]:
    """Gate the inputs, build staging, facts and marts under ``root``, and return their folders.

    Facts and marts are partitioned by the run date: a run replaces its own day and leaves every
    other day as it is, so it can be repeated. Staging holds the last run. ``kpis`` gives the measures of the
    executive row that come from other sources, ``amounts`` the range of an order that the gate accepts.
    """
    Q.gate(check(customers, orders, amounts))
    paths = {name: f"{root}/{name}" for name in ("stg_customers", "stg_orders", "fact_customer_metrics", "dm_executive_kpis", "dm_customer_cohorts")}
    transform_customers(stage_customers(customers, as_of).drop("age"), as_of).write.mode("overwrite").parquet(paths["stg_customers"])
    transform_orders(orders).write.mode("overwrite").parquet(paths["stg_orders"])
    staged = orders.sparkSession.read.parquet(paths["stg_orders"]).select(*orders.columns)
    known = staged.where(F.col("order_date") < F.date_add(F.lit(as_of).cast("date"), 1))
    # orders are added up by customer once: scores, the churn model and the cohorts all read this table
    metrics = stored(C.customer_metrics(known, as_of), "customer-metrics")
    lake.write_partition(customer_fact(metrics, as_of), paths["fact_customer_metrics"], "metric_date")
    lake.write_partition(declared(C.executive_kpis(known, as_of, kpis), "mart", "dm_executive_kpis"), paths["dm_executive_kpis"], "report_date")
    cohorts = declared(H.cohort_mart(metrics, as_of), "mart", "dm_customer_cohorts")
    lake.write_partition(cohorts.withColumn("run_date", F.lit(as_of).cast("date")), paths["dm_customer_cohorts"], "run_date")
    return paths
