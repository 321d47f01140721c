import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfield.functions.traffic import TRAFFIC_SCHEMA
from tallyfield.operators import customers as C
from tallyfield.operators.quality import QualityError
from tallyfield.plans.daily import run_daily
from tallyfield.sources import lake, messages, schemas
from tallyfield.sources.warehouse import Warehouse
from tests.conftest import rows

day = dt.date.fromisoformat


def test_partition_rewrite_leaves_other_days(spark, folder):
    first = spark.createDataFrame([(1, day("2001-01-01")), (2, day("2001-01-02"))], "v int, date date")
    lake.write_partition(first, folder)
    lake.write_partition(spark.createDataFrame([(9, day("2001-01-02"))], first.schema), folder)
    assert rows(spark.read.parquet(folder), "v") == [(1,), (9,)]
    scan = lake.scan_partition(spark, folder, "2001-01-02")
    assert rows(scan, "v") == [(9,)]
    assert "PartitionFilters: [isnotnull(date" in scan._jdf.queryExecution().toString()


def test_copy_into_takes_only_new_files(spark, folder):
    w = Warehouse(spark, f"{folder}/wh", "copytest_")
    incoming = f"{folder}/in"
    spark.range(3).write.parquet(incoming)
    w.copy_into("staging", "t", incoming)
    w.copy_into("staging", "t", incoming)
    assert w.table("staging", "t").count() == 3
    spark.range(3, 5).write.mode("append").parquet(incoming)
    w.copy_into("staging", "t", incoming)
    assert rows(w.table("staging", "t"), "id") == [(i,) for i in range(5)]


def test_loads_read_neither_the_target_nor_old_files(spark, folder, monkeypatch):
    w = Warehouse(spark, f"{folder}/wh", "manifest_")
    incoming = f"{folder}/in"
    spark.range(3).coalesce(1).write.parquet(incoming)
    assert len(w.copy_into("staging", "t", incoming)) == 1 and w.copy_into("staging", "t", incoming) == []
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(incoming)
    target = w.name("staging", "t")
    monkeypatch.setattr(type(w), "table", lambda *_: pytest.fail("the target was read"))
    before = spark.table(target).inputFiles()
    new = w.copy_into("staging", "t", incoming)
    assert len(new) == 1 and rows(spark.read.parquet(*new), "id") == [(3,), (4,)]
    assert len(spark.table(target).inputFiles()) == len(before) + 1


@pytest.mark.parametrize("committed", [True, False])
def test_a_load_that_was_cut_off(spark, folder, committed):
    """Cut off after its rows were written it counts as done, before that it runs again."""
    w = Warehouse(spark, f"{folder}/wh", f"cut_{int(committed)}_")
    w.create("mart", "m", spark.range(1).schema)
    enter = w.manifest._enter

    def broken(target, sources, batch, state, files):
        if state == "done" or not committed:
            raise RuntimeError("lost")
        enter(target, sources, batch, state, files)

    frame = spark.range(7, 9).coalesce(1)
    w.manifest._enter = broken
    with pytest.raises(RuntimeError):
        w.insert_select("mart", "m", frame, "2001-01-01")
    w.manifest._enter = enter
    assert w.table("mart", "m").count() == (2 if committed else 0)
    for _ in range(2):
        w.insert_select("mart", "m", frame, "2001-01-01")
        assert rows(w.table("mart", "m"), "id") == [(7,), (8,)]
    assert w.insert_select("mart", "m", frame, "2001-01-02") and w.table("mart", "m").count() == 4
    w.replace("mart", "m", spark.range(0))
    assert w.insert_select("mart", "m", frame, "2001-01-01") and w.table("mart", "m").count() == 2


def test_a_table_from_before_the_manifest(spark, folder):
    w, incoming = Warehouse(spark, f"{folder}/wh", "older_"), f"{folder}/in"
    spark.range(3).coalesce(1).write.parquet(incoming)
    spark.read.parquet(incoming).withColumn("source_file", F.col("_metadata.file_path")).write.saveAsTable(w.name("staging", "t"))
    assert w.copy_into("staging", "t", incoming) == [] and w.table("staging", "t").count() == 3


def test_malformed_messages(spark):
    raw = spark.createDataFrame(
        [(1, '{"sensor_id":"S1","measurements":{"average_speed":4.9}}'), (2, '{"sensor_id":"S'), (3, '{"sensor_id":"S3"}')],
        "id int, value string",
    )
    parsed = messages.parse_json(raw, TRAFFIC_SCHEMA, keep=["id"])
    assert rows(parsed.select("id", "sensor_id", "measurements.average_speed")) == [(1, "S1", 4.9), (2, None, None), (3, "S3", None)]
    other = raw.union(spark.createDataFrame([(4, '["a list"]'), (5, '{"sensor_id":"S5","measurements":{"average_speed":"fast"}}'), (6, None)], raw.schema))
    assert rows(messages.rejected(other, TRAFFIC_SCHEMA, keep=["id"]), "id") == [(2,), (4,), (5,), (6,)]
    good = messages.parse_checked(other, TRAFFIC_SCHEMA, keep=["id"]).where("rejected is null")
    assert rows(good, "id", "sensor_id") == [(1, "S1"), (3, "S3")]


def test_topics_and_kafka_options(spark):
    alerts = spark.createDataFrame([("S1", 1.5, None)], "sensor_id string, speed double, note string")
    row = messages.as_messages(alerts, messages.TRAFFIC_ALERTS, "sensor_id").first()
    assert (row["topic"], row["key"], row["value"]) == ("traffic-alerts", "S1", '{"sensor_id":"S1","speed":1.5}')
    assert messages.kafka_options("h:1", messages.TRAFFIC_TOPIC, 10) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "traffic-sensors", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10",
    }


def test_expired_state_is_left_out(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([(1, "a", at(1), 5), (2, "a", at(9), 7), (3, "b", at(0), 1), (4, "a", at(9), 8)], "id int, k string, t timestamp_ntz, v int")
    out = messages.latest_state(df, F.col("k"), "t", "id", ["v"], messages.ROAD_TTL, F.lit(at(10)))
    assert rows(out, "key", "v") == [("a", 8)]


def people(spark, mails):
    return spark.createDataFrame(
        [(i, "Ann", "Lee", mail, "F", day("1970-01-01")) for i, mail in enumerate(mails)],
        "customer_id int, first_name string, last_name string, email string, gender string, date_of_birth date",
    )


def test_daily_run(spark, folder):
    orders = spark.createDataFrame(
        [(i, i % 6, day("2001-01-01") + dt.timedelta(i), 10.0 * i) for i in range(30)], "order_id int, customer_id int, order_date date, amount double"
    )
    customers = people(spark, [f"p{i}@x.org" for i in range(6)])
    for day_ in ("2001-01-20", "2001-01-30", "2001-01-20"):
        out = {n: spark.read.parquet(p) for n, p in run_daily(customers, orders, folder, day_).items()}
    fact = out["fact_customer_metrics"]
    assert rows(fact.groupBy("metric_date").count()) == [(day("2001-01-20"), 6), (day("2001-01-30"), 6)]
    assert rows(fact.groupBy("metric_date").agg(F.sum("total_orders"))) == [(day("2001-01-20"), 20), (day("2001-01-30"), 30)]
    assert fact.where("churn_probability between 0 and 1").count() == 12
    kpis = {r["report_date"]: r for r in out["dm_executive_kpis"].collect()}[day("2001-01-30")]
    assert (kpis["total_orders"], float(kpis["total_revenue"]), kpis["new_customers"]) == (1, 290.0, 0)
    assert {float(r["retention_rate"]) for r in out["dm_customer_cohorts"].collect()} == {1.0}
    assert out["stg_orders"].count() == 30
    with pytest.raises(QualityError):
        run_daily(people(spark, ["no-mail"]), orders, folder, "2001-01-30")


def test_a_daily_run_adds_up_customers_once(spark, folder, monkeypatch):
    calls, plain = [], C.customer_metrics
    monkeypatch.setattr(C, "customer_metrics", lambda *args: calls.append(args) or plain(*args))
    orders = spark.createDataFrame(
        [(i, i % 6, day("2001-01-01") + dt.timedelta(i), 10.0 * i) for i in range(30)], "order_id int, customer_id int, order_date date, amount double"
    )
    out = run_daily(people(spark, [f"p{i}@x.org" for i in range(6)]), orders, folder, "2001-01-20")
    assert len(calls) == 1
    assert rows(spark.read.parquet(out["fact_customer_metrics"]).agg(F.sum("total_orders"))) == [(20,)]


def test_bundle_and_csv(spark, folder):
    paths = lake.export_bundle({"a": spark.range(2), "b": spark.range(3)}, folder)
    assert {n: d.count() for n, d in lake.read_bundle(spark, paths).items()} == {"a": 2, "b": 3}
    lake.write_csv(spark.range(2), f"{folder}/csv")
    assert spark.read.option("header", True).csv(f"{folder}/csv").count() == 2


def test_declared_tables_and_keys(spark, folder):
    w = Warehouse(spark, f"{folder}/wh", "declaretest_")
    schemas.declare(w)
    schemas.declare(w)
    assert w.table("mart", "dm_executive_kpis").columns[0] == "report_date"
    assert dict(w.table("raw", "orders").dtypes)["total_amount"] == "decimal(12,2)"
    customers = spark.createDataFrame([("a",), ("a",), ("b",)], "customer_id string")
    orders = spark.createDataFrame([("1", "a"), ("2", "z")], "order_id string, customer_id string")
    lines = schemas.key_report({"customers": customers, "orders": orders})
    assert rows(lines, "check_name", "failed") == [
        ("customers.customer_id unique", 2), ("orders.customer_id in customers", 1), ("orders.order_id unique", 0),
    ]
