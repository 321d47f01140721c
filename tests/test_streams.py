import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.operators import learners as L
from tallyfield.operators.isolation import fit_isolation_forest, path_constant
from tallyfield.streaming import flows as S
from tallyfield.streaming import jobs as J
from tallyfield.streaming import scoring as G
from tallyfield.streaming import state
from tallyfield.sources.messages import file_stream
from tests.conftest import rows

SCHEMA = "event_id long, ts timestamp, road_id string, average_speed double, vehicle_count int, occupancy double"


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 12, 0) + dt.timedelta(minutes=minute, seconds=second)


def write(spark, folder, data):
    spark.createDataFrame([(i, t, r, s, 1, 0.5) for i, t, r, s in data], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


def test_late_rows_and_repeats_are_dropped(spark, folder):
    source, out, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/ck"
    flow = lambda: S.without_repeats(S.timed(stream(spark, source), "ts"), ["event_id"])
    write(spark, source, [(1, at(0), "a", 5.0), (2, at(30), "a", 6.0)])
    J.finish(J.start(flow(), checkpoint, None, folder=out))
    write(spark, source, [(2, at(30), "a", 6.0), (3, at(3), "a", 7.0), (4, at(28), "a", 8.0)])
    J.finish(J.start(flow(), checkpoint, None, folder=out))
    assert rows(spark.read.parquet(out), "event_id") == [(1,), (2,), (4,)]


def test_window_updates_over_two_batches(spark, folder):
    source, out = f"{folder}/in", f"{folder}/out"
    write(spark, source, [(1, at(0), "a", 10.0), (2, at(1), "b", 1.0)])
    write(spark, source, [(3, at(4), "a", 20.0), (4, at(5), "a", 30.0)])
    metrics = S.window_metrics(S.timed(stream(spark, source), "ts"), "ts", "5 minutes", ["road_id"])
    J.finish(J.start(metrics, f"{folder}/ck", None, "update", each=J.append_batches(out)))
    got = J.latest_rows(spark, out, ["road_id", "window_start", "window_end"])
    assert rows(got, "road_id", "readings", "avg_speed") == [("a", 1, 30.0), ("a", 2, 15.0), ("b", 1, 1.0)]


def test_a_repeated_batch_adds_nothing(spark, folder):
    write_batch = J.history_append(folder, "ts")
    batch = spark.createDataFrame([(1, at(0))], "id int, ts timestamp")
    for batch_id in (0, 0, 1):
        write_batch(batch, batch_id)
    assert spark.read.parquet(folder).count() == 2


def test_errors_fail_the_batch(spark, folder):
    source = f"{folder}/in"
    write(spark, source, [(1, at(0), "a", 10.0)])

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        J.finish(J.start(stream(spark, source), f"{folder}/ck", None, each=J.fan_out({"x": broken})))


def test_silent_keys_are_forgotten(spark, folder):
    source, out = f"{folder}/in", f"{folder}/out"
    flow = lambda: state.expiring_latest(stream(spark, source), "road_id", "ts", "event_id", ["average_speed"], "1 minute")
    write(spark, source, [(1, at(5), "a", 10.0), (2, at(1), "a", 1.0), (3, at(0), "b", None), (4, at(5), "a", 11.0)])
    write(spark, source, [(5, at(2), "a", 20.0), (6, at(9), "c", 30.0)])
    with state.timers(spark):
        first = J.finish(J.start(flow(), f"{folder}/ck", None, "update", each=J.append_batches(out)))
    newest = lambda: rows(J.latest_rows(spark, out, ["road_id"]), "road_id", "average_speed", "is_expired")
    assert newest() == [("a", 11.0, False), ("b", None, False), ("c", 30.0, False)]
    assert first.lastProgress["stateOperators"][0]["numRowsTotal"] >= 3
    write(spark, source, [(7, at(17), "c", 31.0), (8, at(17), None, 1.0)])
    with state.timers(spark):
        second = J.finish(J.start(flow(), f"{folder}/ck", None, "update", each=J.append_batches(out)))
    # the watermark stands at minute 16: silent since minutes 5 and 0 for ten minutes and more
    assert newest() == [("a", 11.0, True), ("b", None, True), ("c", 31.0, False), (None, 1.0, False)]
    write(spark, source, [(9, at(18), "a", 5.0)])
    with state.timers(spark):
        J.finish(J.start(flow(), f"{folder}/ck", None, "update", each=J.append_batches(out)))
    assert newest()[0] == ("a", 5.0, False)
    assert spark.conf.get(state.PROVIDER) != state.ROCKS and second.exception() is None


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    frame = spark.range(5000).select(F.lit("a").alias("k"), F.timestamp_micros(F.col("id") % 1000).alias("t"), F.col("id").alias("i")).coalesce(1)
    got = state.combined(frame, "k", "t", "i").collect()
    assert len(got) <= 2 and max(r["i"] for r in got) == 4999


def test_a_hot_key_is_combined_across_small_batches(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 100)
    try:
        frame = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 3).alias("k"), F.timestamp_micros(F.col("id") % 1000).alias("t"), F.col("id").alias("i")).coalesce(1)
        got = rows(state.combined(frame, "k", "t", "i"), "k", "i")
    finally:
        spark.conf.set(size, before)
    newest = {}
    for i in range(5000):
        newest[f"k{i % 3}"] = max(newest.get(f"k{i % 3}", (-1, -1)), (i % 1000, i))
    assert got == sorted((k, i) for k, (_, i) in newest.items())


def test_sessions_open_at_the_end_come_out(spark, folder):
    source, out = f"{folder}/in", f"{folder}/out"
    write(spark, source, [(1, at(0), "a", 1.0), (2, at(10), "a", 1.0)])
    write(spark, source, [(3, at(60), "a", 1.0), (4, at(61), "b", 1.0)])
    flow = lambda events: S.session_metrics(S.timed(events, "ts"), "ts", "road_id", kind="road_id")
    got = rows(J.drain_closed(stream(spark, source), "ts", flow, "1 HOUR", out), "road_id", "session_start", "pages_viewed")
    assert got == [("a", at(0), 2), ("a", at(60), 1), ("b", at(61), 1)]
    empty = f"{folder}/none"
    spark.createDataFrame([], SCHEMA).write.parquet(empty)
    assert J.drain_closed(stream(spark, empty), "ts", flow, "1 HOUR", f"{folder}/left").count() == 0


def test_intervals_of_a_stream_leave_the_state(spark, folder):
    incidents, readings, out = f"{folder}/incidents", f"{folder}/readings", f"{folder}/out"
    for day in range(8):
        start = at(day * 1440)
        spark.createDataFrame([(day * 10 + i, start + dt.timedelta(minutes=i), start + dt.timedelta(minutes=60 + i), "a") for i in range(3)], "incident_id long, started timestamp, ended timestamp, road_id string").coalesce(1).write.mode("append").parquet(incidents)
        write(spark, readings, [(day * 100 + i, at(day * 1440 + 5 * i), "a" if i % 2 else "b", 1.0) for i in range(40)])
    schema = spark.read.parquet(incidents).schema
    lasting = S.timed(file_stream(spark, incidents, schema, files_per_trigger=1), "started")
    flow = S.within_intervals(S.timed(stream(spark, readings), "ts"), lasting, "road_id", "ts", "started", "ended", "2 HOURS")
    done = J.finish(J.start(flow, f"{folder}/ck", None, folder=out))
    want = sum(1 for day in range(8) for i in range(40) if i % 2 for k in range(3) if k <= 5 * i <= 60 + k)
    assert spark.read.parquet(out).count() == want > 100
    # 24 incidents and 320 readings went through; the last day's are what is left
    assert done.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 * 43


def test_progress(spark, folder):
    source = f"{folder}/in"
    write(spark, source, [(1, at(0), "a", 10.0), (2, at(1), "a", 10.0)])
    with J.progress_totals(spark) as totals:
        done = J.finish(J.start(stream(spark, source), f"{folder}/ck", None, folder=f"{folder}/out", name="named"))
        row = totals.report(spark, done).first()
    assert (row["name"], row["processed_messages"]) == ("named", 2)
    assert row["batches"] >= 1 and row["average_processing_millis"] > 0 and row["messages_per_second"] > 0


def test_traffic_flow_uses_the_given_clock(spark):
    raw = spark.createDataFrame([('{"sensor_id":"S1","timestamp":"2024-01-06T03:00:00","measurements":{"average_speed":20.0,"vehicle_count":3,"occupancy":0.0}}',)], "value string")
    r = S.traffic_flow(raw, F.lit(at(0)).cast("timestamp")).first()
    assert (r["congestion_level"], r["traffic_density"], r["hour"], r["day_of_week"], r["is_weekend"]) == ("Moderate", None, 3, 7, 1)
    assert r["processing_time"] == at(0)


def test_stored_models_score_a_stream_as_they_do_a_table(spark, folder):
    source = f"{folder}/in"
    schema = SCHEMA + ", queue_length double"
    data = [(i, at(i % 50), "a", float(20 + i % 30 - (i % 7)), i % 40, i % 20 / 20, float(i % 13)) for i in range(400)] + [(900, at(3), "a", None, None, None, None)]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(source)
    table = spark.read.parquet(source)
    rows_ = G.with_features(table, "ts").withColumn("heavy", (F.col("feature_average_speed") < 30).cast("double"))
    regression, classifier = L.fit_sensor_models(rows_, "feature_average_speed", "heavy", G.INPUTS)
    forest = fit_isolation_forest(rows_, G.FEATURES, "event_id", trees=10, sample=64)
    G.SensorModels(regression, classifier, forest, "v7").save(spark, f"{folder}/models")
    models = G.SensorModels.load(spark, f"{folder}/models")
    live = file_stream(spark, source, table.schema)
    J.finish(J.start(G.scored(live, "ts", models), f"{folder}/ck", None, folder=f"{folder}/out"))
    got = {r["event_id"]: r for r in spark.read.parquet(f"{folder}/out").collect()}
    assert len(got) == 401 and {r["model_version"] for r in got.values()} == {"v7"}
    # each score again from the coefficients and trees
    scaler, line = models.regression.stages[1], models.regression.stages[2]
    logit = models.classifier.stages[2]
    for r in rows_.select("event_id", *G.INPUTS, *[c for c in G.FEATURES if c not in G.INPUTS]).collect()[::37]:
        x = np.array([r[c] for c in G.INPUTS])
        z = np.where(scaler.std.toArray() > 0, (x - scaler.mean.toArray()) / np.where(scaler.std.toArray() > 0, scaler.std.toArray(), 1), 0)
        own = got[r["event_id"]]
        assert own["predicted_traffic"] == pytest.approx(line.coefficients.dot(z) + line.intercept)
        assert own["congestion_probability"] == pytest.approx(1 / (1 + np.exp(-(logit.coefficients.dot(z) + logit.intercept))))
        point, depth = [r[c] for c in forest.columns], 0.0
        for tree in forest.trees:
            node = 0
            while tree["feature"][node] >= 0:
                node = tree["left" if point[tree["feature"][node]] < tree["split"][node] else "right"][node]
                depth += 1
            depth += tree["rest"][node]
        assert own["anomaly_score"] == pytest.approx(-(2 ** (-depth / len(forest.trees) / path_constant(forest.sample))) - forest.offset)
