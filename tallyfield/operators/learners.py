"""Clustering and supervised models on Spark ML, with seeded folds and exact AUC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import AFTSurvivalRegression, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.operators import kmeans
from tallyfield.operators.boosting import BoostedTrees
from tallyfield.operators.encoding import fold_of, standardise, stratified_folds
from tallyfield.operators.evaluation import confusion
from tallyfield.session import durable, stored

CLUSTER_FEATURES = ["recency", "frequency", "monetary", "avg_order_value", "customer_lifespan", "active_months"]
SEED = 42
#: Fits that run side by side; each is a Spark job of its own.
PARALLEL = 4
#: Rows of a partition for a fit. A forest of 100 trees keeps some 600 bytes of each row, which a task reads in every pass.
FIT_ROWS = 100_000


def side_by_side(work: Callable, items: Sequence) -> list:
    """Results of independent fits in order; Spark shares its executors among their jobs."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(work, items))


def vectors(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def scaled_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """NULL to 0 and population standardisation, under the same names.

    The columns are written before: their moments and their values are two reads, and ``df`` is computed once.
    """
    filled = stored(df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in columns]), "features")
    scaled = standardise(filled, [f"_x_{c}" for c in columns], "_z")
    return scaled.select(*keep, *[F.col(f"_x_{c}_z").alias(f"_z_{c}") for c in columns])


def scaled_vectors(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The standardised columns as one vector; written once for the fits."""
    return durable(vectors(scaled_columns(df, columns, keep), [f"_z_{c}" for c in columns]).select(*keep, "features"))


def cluster_points(df: DataFrame, columns: Sequence[str], row_id: str) -> tuple[DataFrame, list[str]]:
    """Standardised columns of every row, written in even partitions of about ``FIT_ROWS`` rows at most, and their names.

    A pass over them keeps all cores busy to its end: there are as many partitions for each.
    """
    scaled, cores = scaled_columns(df, columns, [row_id]), df.sparkSession.sparkContext.defaultParallelism
    pieces = cores * max(1, -(-scaled.count() // (cores * FIT_ROWS)))
    return durable(scaled.repartition(pieces, row_id)), [f"_z_{c}" for c in columns]


def kmeans_clusters(df: DataFrame, k: int, row_id: str, columns: Sequence[str] = CLUSTER_FEATURES,
                    seed: int = SEED, restarts: int = 10) -> DataFrame:
    """Add a ``cluster`` label to every row: the best of several seeded starts by within-cluster cost. Label numbers carry no meaning."""
    points, names = cluster_points(df, columns, row_id)
    fits = kmeans.fit(points, names, row_id, [k], seed, restarts)
    if not fits:
        return df.withColumn("cluster", F.lit(None).cast("int"))
    return df.join(kmeans.labelled(points, names, row_id, fits[k][0]), row_id)


def choose_k(spark: SparkSession, df: DataFrame, row_id: str, columns: Sequence[str] = CLUSTER_FEATURES,
             largest: int = 10, seed: int = SEED, restarts: int = 10) -> DataFrame:
    """Cost and mean silhouette for k of 2 and more; the best silhouette is marked.

    The silhouette uses squared distances as Spark's does, so its values differ from the plain one. All starts of all k are
    fitted in the same passes. No rows give no row; rows that are all alike have no silhouette.
    """
    points, names = cluster_points(df, columns, row_id)
    fits = kmeans.fit(points, names, row_id, range(2, largest + 1), seed, restarts)
    values = kmeans.silhouettes(points, names, list(fits.values())) if fits else []
    best = max((v for v in values if v is not None), default=None)
    marked = values.index(best) if best is not None else -1
    return spark.createDataFrame(
        [(k, kmeans.cost(*fits[k]), value, i == marked) for i, (k, value) in enumerate(zip(fits, values))],
        "k int, inertia double, silhouette double, is_best boolean",
    )


def balanced(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Weight rows / (classes * class rows), from the class counts of this frame only."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    pairs = [F.lit(float(x)) for value, n in counts.items() for x in (value, total / (len(counts) * n))]
    return df.withColumn(weight, F.element_at(F.create_map(*pairs), F.col(label).cast("double")))


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """The frame of ``rows`` rows in even partitions of at most ``FIT_ROWS``, whatever the number of shuffle partitions."""
    wanted = -(-rows // FIT_ROWS)
    return df.repartition(wanted) if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def classifiers(rows: int, label: str, trees: int = 100) -> dict[str, Estimator | BoostedTrees]:
    """The model set: L2 logistic, forest and boosted trees.

    The logistic penalty 1/n matches an unscaled unit penalty on the summed loss. Boosted trees balance the classes themselves.
    """
    common = {"labelCol": label, "featuresCol": "features", "weightCol": "weight"}
    return {
        "logistic": LogisticRegression(maxIter=1000, elasticNetParam=0.0, regParam=1.0 / max(rows, 1), **common),
        "random_forest": RandomForestClassifier(numTrees=trees, seed=SEED, **common),
        "gradient_boosting": BoostedTrees(label, trees, SEED),
    }


def fit_each(estimators: Mapping[str, Estimator | BoostedTrees], parts: Sequence[DataFrame], label: str) -> list[dict[str, Model]]:
    """The fitted models of every part, on balanced weights. Boosted trees of all parts are fitted in the same passes."""
    single = [name for name, e in estimators.items() if not isinstance(e, BoostedTrees)]
    weighted = side_by_side(lambda df: balanced(dealt(df, df.count()), label), parts) if single else []
    jobs = [(name, None) for name in estimators if name not in single] + [(name, i) for name in single for i in range(len(parts))]

    def fit(job: tuple[str, int | None]) -> list[Model]:
        name, part = job
        return estimators[name].fit_each(parts) if part is None else [estimators[name].fit(weighted[part])]

    found: dict[str, list[Model]] = {name: [] for name in estimators}
    for (name, _), models in zip(jobs, side_by_side(fit, jobs)):
        found[name] += models
    return [{name: models[i] for name, models in found.items()} for i in range(len(parts))]


def auc(scored: DataFrame, label: str) -> float:
    """Area under the curve without binning."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0).evaluate(scored)


def cross_validate(df: DataFrame, estimator: Estimator, label: str, row_id: str, folds: int = 5,
                   balance: Callable[[DataFrame, str], DataFrame] | None = None) -> list[float]:
    """AUC per fold of stratified folds; see ``cross_validate_each``."""
    return cross_validate_each(df, {"model": estimator}, label, row_id, folds, balance)["model"]


def cross_validate_each(df: DataFrame, estimators: Mapping[str, Estimator | BoostedTrees], label: str, row_id: str, folds: int = 5,
                        balance: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, list[float]]:
    """AUC of every estimator per fold of stratified folds; see ``fit_and_cross_validate``."""
    return _cross_validated(df, estimators, label, row_id, folds, balance, [])[0]


def fit_and_cross_validate(df: DataFrame, estimators: Mapping[str, Estimator | BoostedTrees], label: str, row_id: str, folds: int = 5,
                           balance: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[dict[str, list[float]], dict[str, Model]]:
    """AUC of every estimator per fold of stratified folds, and the models of all rows, fitted beside those of the folds.

    Classes are balanced inside each training part, so nothing leaks: by weights, or by
    ``balance``, which may add rows (see ``resample.smote_vectors``). A part is balanced and written once;
    all estimators are fitted on that copy. The models of all rows are balanced by weights.
    """
    scores, models = _cross_validated(df, estimators, label, row_id, folds, balance, [df])
    return scores, models[0]


def _cross_validated(df: DataFrame, estimators: Mapping[str, Estimator | BoostedTrees], label: str, row_id: str, folds: int,
                     balance: Callable[[DataFrame, str], DataFrame] | None, beside: list[DataFrame]) -> tuple[dict[str, list[float]], list[dict[str, Model]]]:
    marked = durable(stratified_folds(df, label, row_id, folds, SEED, "_fold"))

    def part(fold: int) -> DataFrame:
        rows = marked.where(F.col("_fold") != fold).drop("_fold")
        return durable(balance(rows, label)) if balance else rows

    models = fit_each(estimators, [*side_by_side(part, range(folds)), *beside], label)

    def score(job: tuple[str, int]) -> float:
        name, fold = job
        return auc(models[fold][name].transform(marked.where(F.col("_fold") == fold)), label)

    scores = side_by_side(score, [(name, fold) for name in estimators for fold in range(folds)])
    return {name: scores[i * folds : (i + 1) * folds] for i, name in enumerate(estimators)}, models[folds:]


def train(df: DataFrame, label: str, names: Sequence[str] | None = None, trees: int = 100) -> dict[str, Model]:
    """Fit the named models on balanced weights, side by side."""
    chosen = {name: e for name, e in classifiers(df.count(), label, trees).items() if names is None or name in names}
    return fit_each(chosen, [df], label)[0]


def probabilities(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Positive-class probability and 0/1 prediction."""
    scored = model.transform(df)
    return scored.select(
        *keep, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction")
    )


def churn_probabilities(metrics: DataFrame, customer: str = "customer_id", idle_days: int = 90, folds: int = 5) -> DataFrame:
    """Churn probability of every customer from a model fitted on the other folds.

    The label is a last order of more than ``idle_days`` ago; the features do not hold it. With one class only the
    probability is the label.
    """
    columns = ["total_orders", "total_spent", "avg_order_value", "customer_lifetime_days"]
    rows = metrics.withColumn("label", (F.col("days_since_last_order") > idle_days).cast("int"))
    data = durable(stratified_folds(scaled_vectors(rows, columns, [customer, "label"]), "label", customer, folds, SEED, "_fold"))
    if len(data.select("label").distinct().take(2)) < 2:
        return data.select(customer, "label", F.col("label").cast("double").alias("churn_probability"), F.col("label").alias("prediction"))

    def score(fold: int) -> DataFrame:
        model = train(data.where(F.col("_fold") != fold), "label", ["logistic"])["logistic"]
        return probabilities(model, data.where(F.col("_fold") == fold), [customer, "label"])

    parts = side_by_side(score, range(folds))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("score", "churn_probability")


def feature_importance(spark: SparkSession, model: Model, columns: Sequence[str], top: int = 20) -> DataFrame:
    """Importance per feature, largest first; one row per column of the vector."""
    values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(name, float(abs(values[i]))) for i, name in enumerate(columns)]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )


def clinical_rates(scored: DataFrame, label: str) -> dict[str, float | None]:
    """Sensitivity, specificity, precision and F1 at one half, as one driver row."""
    r = confusion(scored, 0.5, label).first()
    return {"sensitivity": r["recall_1"], "specificity": r["recall_0"], "precision": r["precision_1"], "f1_score": r["f1_1"]}


def model_comparison(spark: SparkSession, results: Mapping[str, tuple[Sequence[float], float, Mapping[str, float | None]]]) -> DataFrame:
    """Per model the mean and deviation of the fold AUC, the test AUC and the clinical
    rates; the model with the best test AUC is marked."""
    rows = []
    best = max(results, key=lambda name: results[name][1])
    for name, (folds, test, rates) in results.items():
        mean = sum(folds) / len(folds)
        spread = (sum((x - mean) ** 2 for x in folds) / len(folds)) ** 0.5
        rows.append((name, mean, spread, float(test), *rates.values(), name == best))
    return spark.createDataFrame(
        rows,
        "model string, cv_auc_mean double, cv_auc_std double, test_auc double, sensitivity double, specificity double,"
        " precision double, f1_score double, is_best boolean",
    )


def stay_regression(df: DataFrame, label: str, columns: Sequence[str], row_id: str, rounds: int = 20) -> DataFrame:
    """Boosted regression of the stay; error and fit on a held-out fifth."""
    data = durable(vectors(df.fillna(0, list(columns)), columns).select(row_id, label, "features"))
    held = F.col("_fold") == 0
    marked = data.withColumn("_fold", fold_of(row_id, 5, SEED))
    model = GBTRegressor(labelCol=label, maxIter=rounds, seed=SEED).fit(marked.where(~held))
    scored = model.transform(marked.where(held))
    metric = lambda m: float(RegressionEvaluator(labelCol=label, metricName=m).evaluate(scored))
    return scored.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(metric("mae")).alias("mae"), F.lit(metric("r2")).alias("r2")
    )


def hazard_model(df: DataFrame, time: str, event: str, columns: Sequence[str], row_id: str) -> DataFrame:
    """Accelerated-failure-time risk: a parametric stand-in for proportional hazards."""
    data = vectors(df.fillna(0, list(columns)), columns).select(
        row_id, F.col(time).cast("double").alias("label"), F.col(event).cast("double").alias("censor"), "features"
    )
    model = AFTSurvivalRegression(censorCol="censor", quantileProbabilities=[0.5], quantilesCol="median").fit(data)
    return model.transform(data).select(
        row_id, F.col("prediction").alias("expected_time"), vector_to_array("median")[0].alias("median_time")
    )


def fit_sensor_models(df: DataFrame, speed: str, heavy: str, columns: Sequence[str]) -> tuple[PipelineModel, PipelineModel]:
    """Speed regression and congestion classifier over the same feature vector."""
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
    ]
    regression = Pipeline(stages=[*stages, LinearRegression(labelCol=speed, predictionCol="predicted_traffic")]).fit(df)
    classifier = Pipeline(stages=[*stages, LogisticRegression(labelCol=heavy, maxIter=50)]).fit(df)
    return regression, classifier


def score_sensors(df: DataFrame, regression: PipelineModel, classifier: PipelineModel) -> DataFrame:
    """Add predicted traffic and congestion probability; works on streams as well."""
    predicted = regression.transform(df).drop("raw_features", "features")
    scored = classifier.transform(predicted)
    return scored.withColumn("congestion_probability", vector_to_array("probability")[1]).drop(
        "raw_features", "features", "rawPrediction", "probability", "prediction"
    )
