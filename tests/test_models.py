"""Cohorts, survival, evaluation and fitted models on small frames."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfield.operators import boosting as B
from tallyfield.operators import cohorts as H
from tallyfield.operators import customers as C
from tallyfield.operators import encoding as N
from tallyfield.operators import evaluation as V
from tallyfield.operators import kmeans as KM
from tallyfield.operators import learners as L
from tallyfield.operators.isolation import anomaly_scores, fit_isolation_forest, path_constant
from tallyfield.operators import resample
from tallyfield.operators.survival import kaplan_meier, survival_data
from tests.conftest import rows

day = dt.date.fromisoformat
quick = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def order_frame(spark, data):
    return spark.createDataFrame(
        [(i, c, day(d), float(a)) for i, (c, d, a) in enumerate(data)], "order_id int, customer_id string, order_date date, amount double"
    )


def test_cohort_without_period_zero(spark):
    orders = order_frame(spark, [("a", "2001-01-05", 10), ("a", "2001-03-05", 30), ("b", "2001-02-09", 5), ("c", "2000-12-31", 7)])
    registered = spark.createDataFrame([("a", day("2001-01-01")), ("b", day("2001-01-31")), ("c", day("2001-02-01"))], "customer_id string, registration_date date")
    table = H.cohort_table(H.cohort_activity(orders, registered))
    assert rows(table, "cohort_month", "period_number", "customers", "cohort_size", "retention_rate") == [
        (day("2001-01-01"), 0, 1, 1, 1.0), (day("2001-01-01"), 1, 1, 1, 1.0), (day("2001-01-01"), 2, 1, 1, 1.0),
        (day("2001-02-01"), -2, 1, None, None),
    ]


def test_one_order_customer_value(spark):
    r = H.clv_metrics(order_frame(spark, [("a", "2001-01-05", 10)])).first()
    assert (r["customer_lifespan"], r["avg_days_between_orders"], r["purchase_frequency"], r["predicted_clv"]) == (0.0, None, 365.0, 7300.0)


def test_segments_follow_the_first_list(spark):
    codes = ["555", "155", "115", "543", "111", "332", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    assert [r[0] for r in df.select(C.segment_of("code")).collect()] == [
        "Champions", "At Risk", "At Risk", "Loyal Customers", "Lost", "Need Attention", "Lost",
    ]


def test_churned_one_time_buyers_leave_the_survival_data(spark):
    orders = order_frame(spark, [("gone", "2001-01-01", 1), ("new", "2001-05-01", 1), ("back", "2001-01-01", 1), ("back", "2001-01-20", 1)])
    got = rows(survival_data(orders, "2001-05-10"), "customer_id", "churned", "survival_time")
    assert got == [("back", 1, 19), ("new", 0, 9)]


@quick
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 1)), min_size=1, max_size=40))
def test_survival_curve_is_the_product(spark, data):
    df = spark.createDataFrame(data, "survival_time int, churned int")
    held, last = 1.0, 1.0
    for r in kaplan_meier(df).orderBy("time").collect():
        at_risk = sum(1 for t, _ in data if t >= r["time"])
        events = sum(1 for t, e in data if t == r["time"] and e)
        held *= 1 - events / at_risk
        assert (r["n_risk"], r["n_event"]) == (at_risk, events)
        assert r["survival"] == pytest.approx(held, abs=1e-6)
        assert 0 <= r["survival"] <= last
        last = r["survival"]
        if r["variance"] is not None:
            assert r["lower"] <= r["survival"] <= r["upper"] <= 1


@quick
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=40))
def test_auc_counts_pairs_and_ignores_scale(spark, data):
    def area(scale):
        df = spark.createDataFrame([(y, scale(s)) for y, s in data], "label int, score double")
        return V.roc_auc(V.score_curve(df)).first()["auc"]

    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    got = area(float)
    if not pos or not neg:
        assert got is None
        return
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(pairs, abs=1e-8)
    assert area(lambda s: math.exp(s / 3)) == got


def test_f2_without_positives_and_value_without_alerts(spark):
    none = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    assert V.f2_optimum(V.score_curve(none)).first()["threshold"] is None
    r = V.intervention_value(none).first()
    assert (r["roi"], r["patients_flagged"], r["net_value"]) == (0.0, 0, 0.0)


def test_scaling_and_codes(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0, "b"), (2, 3.0, 3.0, "a"), (3, None, 3.0, None)], "id int, x double, y double, c string")
    assert rows(N.standardise(df, ["x", "y"]), "id", "x_z", "y_z") == [(1, -1.0, 0.0), (2, 1.0, 0.0), (3, None, 0.0)]
    wide = N.one_hot_or_index(df, "c")
    assert rows(wide, "id", "c_b", "c_nan") == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]
    coded = N.one_hot_or_index(df, "c", limit=1)
    assert rows(coded, "id", "c") == [(1, 1), (2, 0), (3, 2)]


def test_split_keeps_the_class_ratio(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "id long, y int")
    got = rows(N.stratified_split(df, "y", "id").groupBy("y", "is_train").count())
    assert got == [(0, 0, 36), (0, 1, 144), (1, 0, 4), (1, 1, 16)]


def test_oversampling_in_one_and_in_many_blocks(spark, monkeypatch):
    pick = np.random.default_rng(5)
    data = [(i, int(i >= 300), [float(x) for x in pick.normal(10 if i >= 300 else 0, 1, 3)]) for i in range(390)]
    df = spark.createDataFrame(data, "id long, y int, f array<double>")
    low, high = np.min([d[2] for d in data if d[1]], axis=0), np.max([d[2] for d in data if d[1]], axis=0)
    for block in (2048, 25):
        monkeypatch.setattr(resample, "BLOCK_ROWS", block)
        out = resample.smote_balance(df, "y", "f", "id").collect()
        made = [r for r in out if r["is_synthetic"]]
        assert len(made) == 210 and all(r["y"] == 1 for r in made)
        assert all((low <= r["f"]).all() and (r["f"] <= high).all() for r in made)
        uses = [sum(r["id"] == i for r in made) for i in range(300, 390)]
        assert max(uses) - min(uses) <= 1


def test_oversampled_rows_lie_between_neighbours(spark):
    """Each synthetic row is on the line from its own row to one of its five nearest of the class."""
    pick = np.random.default_rng(11)
    points = pick.normal(0, 1, (60, 3))
    data = [(i, 1, [float(x) for x in p]) for i, p in enumerate(points)] + [(100 + i, 0, [9.0, 9.0, float(i)]) for i in range(200)]
    made = [r for r in resample.smote_balance(spark.createDataFrame(data, "id long, y int, f array<double>"), "y", "f", "id").collect() if r["is_synthetic"]]
    assert len(made) == 140
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    np.fill_diagonal(apart, np.inf)
    shares = []
    for r in made:
        own, new = points[r["id"]], np.array(r["f"])
        reach = [(new - own) @ (points[j] - own) / apart[r["id"], j] ** 2 for j in np.argsort(apart[r["id"]])[:5]]
        off = [np.abs(own + g * (points[j] - own) - new).max() for g, j in zip(reach, np.argsort(apart[r["id"]])[:5])]
        at = int(np.argmin(off))
        assert off[at] < 1e-9 and -1e-9 <= reach[at] < 1
        shares.append(reach[at])
    assert 0.3 < np.mean(shares) < 0.7 and len({round(s, 6) for s in shares}) > 100


def test_least_columns_are_those_of_a_stable_sort():
    pick = np.random.default_rng(4)
    for values in (pick.normal(size=(50, 30)), pick.integers(0, 4, (50, 30)).astype(float), np.zeros((5, 9)), np.full((3, 7), np.inf)):
        for take in (1, 3, 5):
            assert (resample.least_columns(values, take) == np.argsort(values, axis=1, kind="stable")[:, :take]).all()


def test_isolation_forest_finds_the_outliers(spark):
    pick = np.random.default_rng(1)
    data = [(i, float(x), float(y)) for i, (x, y) in enumerate(pick.normal(0, 1, (400, 2)))] + [(400, 30.0, 30.0), (401, -40.0, 9.0)]
    df = spark.createDataFrame(data, "id long, x double, y double")
    model = fit_isolation_forest(df, ["x", "y"], "id", trees=40, sample=64)
    scored = df.select("id", model.decision().alias("s")).orderBy("s").collect()
    assert {r["id"] for r in scored[:2]} == {400, 401}
    assert 35 <= sum(r["s"] < 0 for r in scored) <= 45


def test_models_separate_and_clusters_repeat(spark):
    pick = random.Random(2)
    data = [(i, i % 2, pick.gauss(3.0 * (i % 2), 1), pick.gauss(0, 1)) for i in range(400)]
    df = spark.createDataFrame(data, "id long, label int, a double, b double")
    features = L.scaled_vectors(df, ["a", "b"], ["id", "label"])
    folds = L.cross_validate(features, L.classifiers(400, "label")["logistic"], "label", "id", folds=2)
    assert len(folds) == 2 and min(folds) > 0.9
    forest = L.train(features, "label", ["random_forest"], trees=5)["random_forest"]
    scored = L.probabilities(forest, features, ["id"]).agg(F.min("score"), F.max("score")).first()
    assert 0 <= scored[0] <= scored[1] <= 1
    assert L.feature_importance(spark, forest, ["a", "b"]).first()["feature"] == "a"
    labels = [rows(L.kmeans_clusters(df, 2, "id", ["a", "b"], restarts=2), "id", "cluster") for _ in range(2)]
    assert labels[0] == labels[1] and {c for _, c in labels[0]} == {0, 1}


def test_a_fold_is_balanced_once_for_all_models(spark):
    pick = random.Random(3)
    data = [(i, int(i % 3 == 0), pick.gauss(3.0 * (i % 3 == 0), 1), pick.gauss(0, 1)) for i in range(300)]
    features = L.scaled_vectors(spark.createDataFrame(data, "id long, label int, a double, b double"), ["a", "b"], ["id", "label"])
    calls = []

    def balance(df, label):
        calls.append(df.count())
        return resample.smote_vectors("id")(df, label)

    models = L.classifiers(300, "label", trees=2)
    got = L.cross_validate_each(features, {k: models[k] for k in ("logistic", "random_forest")}, "label", "id", 2, balance)
    assert calls == [150, 150] and list(got) == ["logistic", "random_forest"]
    assert all(len(folds) == 2 and min(folds) > 0.9 for folds in got.values())


def test_vector_width(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id int, x double")
    assert L.scaled_vectors(df, ["x"], ["id"]).select(F.size(vector_to_array("features"))).first()[0] == 1


def test_anomaly_scores_are_the_decisions(spark):
    """The scores that the offset was taken from are handed on; a path is walked as node by node, NULL and NaN included."""
    rng = random.Random(5)
    data = [(i, rng.random() if i % 7 else None, float("nan") if i % 11 == 0 else rng.gauss(0, 1), f"k{i}") for i in range(600)]
    df = spark.createDataFrame(data, "id int, x double, y double, kept string").coalesce(1)
    model, scored = anomaly_scores(df, ["x", "y"], "id", ["kept"], trees=20, sample=64)
    want = {r["id"]: (r["kept"], r["s"]) for r in df.select("id", "kept", model.decision().alias("s")).collect()}
    assert {r["id"]: (r["kept"], r["anomaly_score"]) for r in scored.collect()} == want
    assert sum(s < 0 for _, s in want.values()) == 60
    for i, x, y, _ in data[:50]:
        depth = 0.0
        for tree in model.trees:
            at, steps = 0, 0.0
            while tree["feature"][at] >= 0:
                at = tree["left" if (x or 0.0, y)[tree["feature"][at]] < tree["split"][at] else "right"][at]
                steps += 1
            depth += steps + tree["rest"][at]
        assert want[i][1] + model.offset == pytest.approx(-(2.0 ** (-depth / 20 / path_constant(64))), abs=1e-12)
    # one piece of a file is scored by many tasks
    assert scored.rdd.getNumPartitions() > 1


def test_a_fit_has_even_partitions_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "FIT_ROWS", 100)
    df = spark.range(3000).coalesce(2)
    sizes = [r["count"] for r in L.dealt(df, 3000).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 30 and max(sizes) <= 110
    assert L.dealt(df, 700) is df


def test_vectors_compute_their_source_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def passed(x):
        seen.add(1)
        return float(x)

    made = L.scaled_vectors(spark.range(50).select("id", passed("id").alias("x")), ["x"], ["id"])
    assert made.count() == 50 and seen.value == 50


def test_all_starts_of_all_k_share_their_passes(spark):
    """The jobs do not follow from the number of starts and sizes; costs and silhouettes are those of Spark's fit."""
    pick = random.Random(4)
    data = [(i, pick.gauss((0, 9, 40)[i % 3], 1), pick.gauss((0, 9, 40)[i % 3], 1)) for i in range(600)]
    df = spark.createDataFrame(data, "id long, a double, b double")
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    begun = jobs()
    got = L.choose_k(spark, df, "id", ["a", "b"], largest=4).collect()
    assert jobs() - begun < 100 and [r["k"] for r in got] == [2, 3, 4] and sum(r["is_best"] for r in got) == 1
    features = L.scaled_vectors(df, ["a", "b"], ["id"])
    for r in got[:2]:
        fits = [KMeans(k=r["k"], seed=s).fit(features) for s in range(5)]
        model = min(fits, key=lambda m: m.summary.trainingCost)
        assert r["inertia"] == pytest.approx(model.summary.trainingCost, rel=1e-3)
        assert r["silhouette"] == pytest.approx(ClusteringEvaluator().evaluate(model.transform(features)), abs=1e-3)


def test_cluster_figures_are_those_of_the_labels(spark):
    """A cluster of one row, an unused centre and equally near centres: labels, costs and silhouettes as counted row by row and by Spark."""
    data = [(i, float(i % 4), float(i % 3)) for i in range(60)] + [(60, 50.0, 50.0)]
    rows_ = spark.createDataFrame(data, "id long, x double, y double").repartition(3)
    centres = np.array([[0.0, 0.0], [2.0, 0.0], [50.0, 50.0], [900.0, 900.0]])
    points = np.array([r[1:] for r in data])
    apart = ((points[:, None, :] - centres) ** 2).sum(axis=2)
    label = apart.argmin(axis=1)
    [found] = KM.moments(rows_, ["x", "y"], [centres])
    assert found[:, 0].tolist() == [(label == i).sum() for i in range(4)] and KM.cost(centres, found) == pytest.approx(apart.min(axis=1).sum())
    marked = KM.labelled(rows_, ["x", "y"], "id", centres)
    assert [c for _, c in sorted(map(tuple, marked.collect()))] == label.tolist()
    scored = L.vectors(rows_.join(marked, "id"), ["x", "y"]).withColumn("prediction", F.col("cluster").cast("double"))
    assert KM.silhouettes(rows_, ["x", "y"], [(centres, found)])[0] == pytest.approx(ClusteringEvaluator().evaluate(scored), abs=1e-9)


def test_clusters_of_few_different_rows(spark):
    schema = "id long, a double, b double"
    alike = spark.createDataFrame([(i, 2.0, None) for i in range(5)], schema)
    assert [(r["k"], r["inertia"], r["silhouette"], r["is_best"]) for r in L.choose_k(spark, alike, "id", ["a", "b"], 3).collect()] == [(2, 0.0, None, False), (3, 0.0, None, False)]
    two = spark.createDataFrame([(i, float(i % 2), 0.0) for i in range(6)], schema)
    assert [(r["inertia"], r["silhouette"]) for r in L.choose_k(spark, two, "id", ["a", "b"], 3).collect()] == [(pytest.approx(0.0), pytest.approx(1.0))] * 2
    none = spark.createDataFrame([], schema)
    assert L.choose_k(spark, none, "id", ["a", "b"], 3).collect() == [] and L.kmeans_clusters(none, 2, "id", ["a", "b"]).collect() == []


def test_clusters_do_not_depend_on_where_rows_lie(spark):
    pick = random.Random(6)
    df = spark.createDataFrame([(i, pick.random(), pick.random()) for i in range(300)], "id long, a double, b double")
    labels = [rows(L.kmeans_clusters(d, 5, "id", ["a", "b"], restarts=3), "id", "cluster") for d in (df.coalesce(1), df.repartition(7).orderBy(F.desc("id")))]
    assert labels[0] == labels[1] and {c for _, c in labels[0]} == set(range(5))


def boosted_rows(spark, n, seed):
    """Rows with a feature of few values, one of many, one without signal and a constant one; a third of them positive."""
    pick = np.random.default_rng(seed)
    few, wide, noise = pick.integers(0, 7, n), pick.normal(size=n), pick.normal(size=n)
    label = (few - 3 + wide + pick.normal(size=n) > 1).astype(int)
    data = [(i, int(label[i]), float(few[i]), float(wide[i]), float(noise[i]), 1.0) for i in range(n)]
    df = spark.createDataFrame(data, "id long, label int, a double, b double, c double, d double").repartition(3)
    return L.scaled_vectors(df, ["a", "b", "c", "d"], ["id", "label"])


def scores_of(model, df):
    return {r["id"]: (r["score"], r["prediction"]) for r in L.probabilities(model, df, ["id"]).collect()}


def test_boosted_trees_are_those_of_spark(spark):
    """Parts of different rows are fitted in the same passes; each has the trees that Spark fits to it alone."""
    parts = [boosted_rows(spark, 25_000, 1), boosted_rows(spark, 400, 2)]  # thresholds of the first come from drawn rows
    models = B.BoostedTrees("label", 2, 7).fit_each(parts)
    for part, model in zip(parts, models):
        plain = GBTClassifier(maxIter=2, seed=7, labelCol="label", weightCol="weight").fit(L.balanced(part, "label"))
        want, got = scores_of(plain, part), scores_of(model, part)
        assert got.keys() == want.keys()
        assert max(abs(got[i][0] - want[i][0]) for i in want) < 1e-9
        assert all(got[i][1] == want[i][1] for i in want)
        assert L.auc(model.transform(part), "label") == pytest.approx(L.auc(plain.transform(part), "label"), abs=1e-9)


def test_boosted_trees_of_all_folds_share_their_passes(spark):
    """More folds need no more passes, and the model of all rows comes out of the same ones."""
    features = boosted_rows(spark, 300, 3)
    models = {"gradient_boosting": L.classifiers(300, "label", trees=2)["gradient_boosting"]}
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    spent = []
    for folds in (2, 4):
        begun = jobs()
        scores, fitted = L.fit_and_cross_validate(features, models, "label", "id", folds)
        spent.append(jobs() - begun)
        assert len(scores["gradient_boosting"]) == folds and min(scores["gradient_boosting"]) > 0.6
        assert len(scores_of(fitted["gradient_boosting"], features)) == 300
    # what is left for a fold is its own scoring
    assert spent[1] - spent[0] < 2 * 12


def test_boosted_trees_do_not_depend_on_blocks(spark, monkeypatch):
    part = boosted_rows(spark, 500, 4)
    want = scores_of(B.BoostedTrees("label", 2).fit(part), part)
    monkeypatch.setattr(B, "WRITTEN", 1)
    got = scores_of(B.BoostedTrees("label", 2).fit(part.repartition(7).orderBy(F.desc("id"))), part)
    assert max(abs(got[i][0] - want[i][0]) for i in want) < 1e-9


def test_boosted_trees_of_one_class_and_of_no_rows(spark):
    part = boosted_rows(spark, 60, 5)
    scores = scores_of(B.BoostedTrees("label", 2).fit(part.where("label = 0")), part)
    assert len(scores) == 60 and all(s < 0.2 and p == 0 for s, p in scores.values())
    with pytest.raises(ValueError):
        B.BoostedTrees("label", 2).fit(part.where("label = 7"))
