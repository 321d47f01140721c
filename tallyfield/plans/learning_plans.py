"""Fitted-model and forecast queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import clinical as K
from tallyfield.functions import traffic as R
from tallyfield.functions.dates import clock_parts
from tallyfield.functions.numbers import rounded
from tallyfield.operators import affinity as A
from tallyfield.operators import arima as AR
from tallyfield.operators import cohorts as H
from tallyfield.operators import customers as C
from tallyfield.operators import encoding as N
from tallyfield.operators import forecasting as FC
from tallyfield.operators import hazards as Z
from tallyfield.operators import learners as L
from tallyfield.operators.isolation import anomaly_scores, fit_isolation_forest
from tallyfield.operators.resample import smote_balance, smote_vectors
from tallyfield.operators.survival import survival_data
from tallyfield.operators import traffic as T
from tallyfield.plans.bindings import AS_OF, LINES_SQL, SENSORS_SQL, lines, orders, per_order, readings
from tallyfield.plans.cohort_plans import SURVIVAL_SQL, TABLE_SQL, table
from tallyfield.plans.customer_plans import EXTRACT_SQL, completed
from tallyfield.plans.history_plans import NEXT_SQL, labelled_stays
from tallyfield.plans.registry import Tables, query
from tallyfield.plans.stream_plans import drain, live
from tallyfield.session import durable, stored, work_folder
from tallyfield.sources import lake
from tallyfield.streaming import jobs as J
from tallyfield.streaming import scoring as G

STAY_FEATURES = ["length_of_stay", "severity", "amount", "q", "q_max", "d", "x", "r", "a", "f"]


def rfm_features(t: Tables) -> DataFrame:
    return C.segmentation_extract(completed(t), AS_OF).withColumns(
        {
            "recency": F.col("days_since_last_order"),
            "frequency": F.col("total_orders"),
            "monetary": F.col("total_revenue"),
        }
    )


def stay_rows(t: Tables) -> DataFrame:
    rows = labelled_stays(t).withColumn("severity", K.severity_rank()).join(per_order(t), "admission_id", "left")
    return rows.fillna(0, STAY_FEATURES).select("admission_id", F.col("readmitted_30d").alias("label"), *STAY_FEATURES)


def stay_vectors(t: Tables) -> DataFrame:
    """Standardised feature vectors with the readmission label, written once."""
    return L.scaled_vectors(stay_rows(t), STAY_FEATURES, ["admission_id", "label"])


def split(data: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = durable(N.stratified_split(data, "label", "admission_id"))
    return marked.where("is_train = 1"), marked.where("is_train = 0")


@query("kmeans_clusters")
def kmeans_clusters(t: Tables) -> DataFrame:
    labelled = L.kmeans_clusters(rfm_features(t), 4, "customer_id")
    return C.cluster_summary(labelled).withColumn("cluster_name", C.cluster_name("cluster", 4))


@query("kmeans_nearest", f"WITH {EXTRACT_SQL} SELECT customer_id, TRUE AS is_nearest, 4 AS clusters FROM extract")
def kmeans_nearest(t: Tables) -> DataFrame:
    """Whether each customer's label names the nearest of the clusters' means; a hundredth of the distance is left to unfinished steps."""
    rows = durable(rfm_features(t).select("customer_id", *L.CLUSTER_FEATURES))
    scaled = N.standardise(rows, L.CLUSTER_FEATURES)
    x = [f"{c}_z" for c in L.CLUSTER_FEATURES]
    labelled = durable(L.kmeans_clusters(rows, 4, "customer_id").select("customer_id", "cluster").join(scaled.select("customer_id", *x), "customer_id"))
    centres = labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in x]).agg(F.collect_list(F.struct("cluster", *x)).alias("c"))
    apart = lambda m: F.sqrt(sum(((F.col(c) - m[c]) * (F.col(c) - m[c]) for c in x), F.lit(0.0)))
    marked = labelled.withColumn("_c", centres.select("c").scalar())
    own = F.filter("_c", lambda m: m["cluster"] == F.col("cluster"))
    nearest = F.array_min(F.transform("_c", apart))
    return marked.select(
        "customer_id", (F.element_at(F.transform(own, apart), 1) <= nearest * 1.01 + 1e-9).alias("is_nearest"), F.size("_c").alias("clusters")
    )


@query("choose_k")
def choose_k(t: Tables) -> DataFrame:
    return L.choose_k(t.spark, rfm_features(t), "customer_id")


@query(
    "smote_balance",
    f"""WITH {NEXT_SQL}, c AS (SELECT readmitted_30d AS label, COUNT(*) AS n FROM labelled GROUP BY 1)
    SELECT label, 0 AS is_synthetic, n FROM c UNION ALL SELECT label, 1, (SELECT MAX(n) FROM c) - n FROM c WHERE n < (SELECT MAX(n) FROM c)""",
)
def smote(t: Tables) -> DataFrame:
    """Class sizes before and after; both classes end equal."""
    data = stay_vectors(t).select("admission_id", "label", vector_to_array("features").alias("features"))
    return smote_balance(data, "label", "features", "admission_id").groupBy("label", "is_synthetic").agg(
        F.count(F.lit(1)).alias("n")
    )


def _scored(t: Tables, name: str, trees: int) -> DataFrame:
    fit_on, test = split(stay_vectors(t))
    return L.probabilities(L.train(fit_on, "label", [name], trees)[name], test, ["admission_id", "label"])


@query("fit_logistic")
def fit_logistic(t: Tables) -> DataFrame:
    return _scored(t, "logistic", 1)


@query(
    "logistic_equations",
    f"""WITH {NEXT_SQL}, c AS (SELECT readmitted_30d, (COUNT(*) * 8 + 5) // 10 AS kept FROM labelled GROUP BY 1)
    SELECT term, CAST((SELECT SUM(kept) FROM c) AS BIGINT) AS rows, TRUE AS holds FROM (SELECT unnest({['intercept', *STAY_FEATURES]}) AS term)""",
)
def logistic_equations(t: Tables) -> DataFrame:
    """The score equations of the fitted logistic model: each weighted sum of residuals balances its penalty."""
    fit_on, _ = split(stay_vectors(t))
    model = L.train(fit_on, "label", ["logistic"])["logistic"]
    scored = model.transform(L.balanced(fit_on, "label")).select("weight", (vector_to_array("probability")[1] - F.col("label")).alias("off"), vector_to_array("features").alias("x"))
    k = len(STAY_FEATURES)
    column = lambda i: F.element_at("x", i + 1)
    total, n = F.sum("weight"), F.count(F.lit(1))
    means = [F.sum(F.col("weight") * column(i)) / total for i in range(k)]
    # the penalty is on weights of standardised features; their scale is the weighted deviation
    spread = [F.sum(F.col("weight") * column(i) * column(i)) / total - means[i] * means[i] for i in range(k)]
    left = [F.sum(F.col("weight") * F.col("off")) / total, *[F.sum(F.col("weight") * F.col("off") * column(i)) / total for i in range(k)]]
    penalty = [F.lit(0.0), *[F.lit(float(model.coefficients[i])) / n * spread[i] for i in range(k)]]
    terms = ["intercept", *STAY_FEATURES]
    lines_ = F.array(*[F.struct(F.lit(c).alias("term"), (F.abs(a + b) < 1e-4).alias("holds")) for c, a, b in zip(terms, left, penalty)])
    return scored.agg(n.alias("rows"), lines_.alias("l")).select("rows", F.explode("l").alias("x")).select("x.term", "rows", "x.holds")


@query("fit_forest")
def fit_forest(t: Tables) -> DataFrame:
    return _scored(t, "random_forest", 100)


@query("fit_boosted")
def fit_boosted(t: Tables) -> DataFrame:
    return _scored(t, "gradient_boosting", 100)


@query("cross_validate")
def cross_validate(t: Tables) -> DataFrame:
    data = stay_vectors(t)
    scores = L.cross_validate(data, L.classifiers(data.count(), "label")["logistic"], "label", "admission_id")
    lines_ = [F.struct(F.lit(i).alias("fold"), F.lit(s).alias("auc")) for i, s in enumerate(scores)]
    return data.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.explode(F.array(*lines_)).alias("x")).select("rows", "x.*")


@query("feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    fit_on, _ = split(stay_vectors(t))
    return L.feature_importance(t.spark, L.train(fit_on, "label", ["random_forest"])["random_forest"], STAY_FEATURES)


@query("model_comparison")
def model_comparison(t: Tables) -> DataFrame:
    fit_on, test = split(stay_vectors(t))
    folds, models = L.fit_and_cross_validate(fit_on, L.classifiers(fit_on.count(), "label"), "label", "admission_id", balance=smote_vectors("admission_id"))
    results = {
        name: (
            folds[name],
            L.auc(model.transform(test), "label"),
            L.clinical_rates(L.probabilities(model, test, ["admission_id", "label"]), "label"),
        )
        for name, model in models.items()
    }
    return L.model_comparison(t.spark, results)


@query(
    "model_store",
    f"""WITH {NEXT_SQL}, c AS (SELECT readmitted_30d, COUNT(*) - (COUNT(*) * 8 + 5) // 10 AS held FROM labelled GROUP BY 1)
    SELECT CAST(SUM(held) AS BIGINT) AS rows, CAST(SUM(held) AS BIGINT) AS equal_scores FROM c""",
)
def model_store(t: Tables) -> DataFrame:
    """A model is saved, loaded and used; both give the same scores."""
    fit_on, test = split(stay_vectors(t))
    model = L.train(fit_on, "label", ["logistic"])["logistic"]
    folder = work_folder(t.spark, "models")
    lake.save_models({"logistic": model}, folder)
    kept = L.probabilities(model, test, ["admission_id"]).withColumnRenamed("score", "before")
    loaded = L.probabilities(lake.load_model(folder, "logistic"), test, ["admission_id"])
    return kept.join(loaded, "admission_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") == F.col("score")).alias("equal_scores")
    )


def revenue_months(t: Tables) -> DataFrame:
    """Revenue of each market segment and nation by month. Orders shrink to customer-months before the join."""
    return (
        H.active_months(completed(t))
        .join(t.customer, F.col("customer_id") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.col("month").alias("order_month"))
        .agg((F.sum("cents") / F.lit(100.0)).alias("total_revenue"))
    )


@query("revenue_forecast")
def revenue_forecast(t: Tables) -> DataFrame:
    """A forecast for each market segment and nation."""
    return FC.forecast(revenue_months(t), ["segment", "nation"], "order_month", "total_revenue")


@query("revenue_arima")
def revenue_arima(t: Tables) -> DataFrame:
    """The same series by models with differences and moving-average terms."""
    return AR.arima_forecast(revenue_months(t), ["segment", "nation"], "order_month", "total_revenue")


@query(
    "seasonal_naive_forecast",
    f"""WITH {TABLE_SQL}, m AS (SELECT CAST(cohort_month + to_months(period_number) AS DATE) AS order_month,
      CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS v FROM cells GROUP BY 1),
    g AS (SELECT CAST(x AS DATE) AS order_month FROM (SELECT unnest(generate_series((SELECT MIN(order_month) FROM m), (SELECT MAX(order_month) FROM m), INTERVAL 1 MONTH)) AS x))
    SELECT 'revenue' AS series, CAST(g.order_month + INTERVAL 12 MONTH AS DATE) AS order_month, COALESCE(v, 0) AS forecast FROM g LEFT JOIN m ON m.order_month = g.order_month
    WHERE g.order_month > (SELECT MAX(order_month) FROM m) - INTERVAL 12 MONTH""",
)
def seasonal_naive_forecast(t: Tables) -> DataFrame:
    monthly = H.monthly_revenue(table(t)).withColumn("series", F.lit("revenue"))
    return FC.seasonal_naive(monthly, ["series"], "order_month", "total_revenue")


def product_units(t: Tables) -> DataFrame:
    """Units per product and month."""
    months = lines(t).groupBy("product_id", F.trunc("ship_date", "month").alias("month"))
    return months.agg(F.sum(F.col("quantity").cast("bigint")).cast("double").alias("units"))


def monthly_units(t: Tables) -> DataFrame:
    """Units per brand and month. Lines shrink to products before the join."""
    return (
        product_units(t).join(t.part, F.col("product_id") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("brand"), "month")
        .agg(F.sum("units").alias("units"))
    )


@query(
    "demand_lag_coefficients",
    f"""WITH {LINES_SQL}, m AS (SELECT product_id, CAST(date_trunc('month', ship_date) AS DATE) AS month, CAST(SUM(quantity) AS DOUBLE) AS units
      FROM line GROUP BY 1, 2), b AS (SELECT product_id, MIN(month) AS lo, MAX(month) AS hi FROM m GROUP BY 1),
    g AS (SELECT product_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
    s AS (SELECT product_id, COALESCE(units, 0) AS y, LAG(COALESCE(units, 0)) OVER (PARTITION BY product_id ORDER BY month) AS x
      FROM g LEFT JOIN m USING (product_id, month)),
    c AS (SELECT product_id, COUNT(*) AS months, COUNT(DISTINCT x) > 1 AS sound, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM s GROUP BY 1)
    SELECT product_id, months, CASE WHEN sound THEN round_even(a, 6) END AS intercept, CASE WHEN sound THEN round_even(b, 6) END AS slope FROM c""",
)
def demand_lag_coefficients(t: Tables) -> DataFrame:
    """Each product's units regressed on those of the month before, by the solver that forecasts."""
    found = FC.lag_coefficients(product_units(t), ["product_id"], "month", "units")
    return found.select("product_id", "months", rounded("intercept", 6).alias("intercept"), rounded("slope", 6).alias("slope"))


@query("demand_forecast")
def demand_forecast(t: Tables) -> DataFrame:
    """A forecast for each product: one bounded monthly series per product."""
    return FC.forecast(product_units(t), ["product_id"], "month", "units")


@query(
    "product_seasonal_naive",
    f"""WITH {LINES_SQL}, m AS (SELECT product_id, CAST(date_trunc('month', ship_date) AS DATE) AS month, CAST(SUM(quantity) AS DOUBLE) AS units
      FROM line GROUP BY 1, 2), b AS (SELECT product_id, MIN(month) AS lo, MAX(month) AS hi FROM m GROUP BY 1),
    g AS (SELECT product_id, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
    SELECT g.product_id, CAST(g.month + INTERVAL 12 MONTH AS DATE) AS month, COALESCE(units, 0) AS forecast
    FROM g LEFT JOIN m ON m.product_id = g.product_id AND m.month = g.month WHERE g.month > hi - INTERVAL 12 MONTH""",
)
def product_seasonal_naive(t: Tables) -> DataFrame:
    return FC.seasonal_naive(product_units(t), ["product_id"], "month", "units")


@query(
    "demand_seasonal_naive",
    f"""WITH {LINES_SQL}, m AS (SELECT p_brand AS brand, CAST(date_trunc('month', ship_date) AS DATE) AS month, CAST(SUM(quantity) AS DOUBLE) AS units
      FROM line JOIN part ON p_partkey = product_id GROUP BY 1, 2), b AS (SELECT brand, MIN(month) AS lo, MAX(month) AS hi FROM m GROUP BY 1),
    g AS (SELECT brand, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
    SELECT g.brand, CAST(g.month + INTERVAL 12 MONTH AS DATE) AS month, COALESCE(units, 0) AS forecast
    FROM g LEFT JOIN m ON m.brand = g.brand AND m.month = g.month WHERE g.month > hi - INTERVAL 12 MONTH""",
)
def demand_seasonal_naive(t: Tables) -> DataFrame:
    return FC.seasonal_naive(monthly_units(t), ["brand"], "month", "units")


def sensor_features(t: Tables) -> DataFrame:
    base = readings(t).withColumns(
        {
            **clock_parts("ts"),
            "temperature": F.lit(None).cast("double"),
            "humidity": F.lit(None).cast("double"),
            "precipitation": F.lit(None).cast("double"),
        }
    )
    filled = base.select("event_id", "sensor_id", *[F.col(c).cast("double").alias(c) for c in R.FEATURE_DEFAULTS])
    return filled.fillna(R.FEATURE_DEFAULTS)


@query("feature_vector_score")
def feature_vector_score(t: Tables) -> DataFrame:
    rows = sensor_features(t).withColumn("heavy", (F.col("average_speed") < 15).cast("double"))
    inputs = [c for c in R.FEATURE_DEFAULTS if c != "average_speed"]
    held = N.fold_of("event_id", 5, L.SEED) == 0
    regression, classifier = L.fit_sensor_models(rows.where(~held), "average_speed", "heavy", inputs)
    return L.score_sensors(rows.withColumn("is_held_out", held), regression, classifier).select(
        "event_id", "sensor_id", "is_held_out", "predicted_traffic", "congestion_probability"
    )


@query("isolation_forest")
def isolation_forest(t: Tables) -> DataFrame:
    _, scored = anomaly_scores(sensor_features(t), list(R.FEATURE_DEFAULTS), "event_id", ["sensor_id"])
    return scored.withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("int"))


@query("churn_model")
def churn_model(t: Tables) -> DataFrame:
    """Churn probability per customer, scored by a model that was not fitted on that customer."""
    return L.churn_probabilities(C.customer_metrics(orders(t), AS_OF))


NEIGHBOUR_SQL = """basket AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS item FROM lineitem),
  held AS (SELECT item, COUNT(*) AS n FROM basket GROUP BY 1),
  pair AS (SELECT x.item, y.item AS other, COUNT(*) AS together FROM basket x JOIN basket y ON x.o = y.o AND x.item <> y.item GROUP BY 1, 2),
  near AS (SELECT pair.item, other, CAST(floor(together / sqrt(CAST(a.n * b.n AS DOUBLE)) * 1000000) AS BIGINT) AS similarity
    FROM pair JOIN held a ON a.item = pair.item JOIN held b ON b.item = other
    QUALIFY ROW_NUMBER() OVER (PARTITION BY pair.item ORDER BY similarity DESC, other) <= 10)"""


def bought(t: Tables) -> DataFrame:
    sold = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("part"))
    return sold.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("customer")), F.col("l_orderkey") == F.col("o_orderkey"))


@query("item_neighbours", f"WITH {NEIGHBOUR_SQL} SELECT item, other, similarity FROM near")
def item_neighbours(t: Tables) -> DataFrame:
    """The ten closest others of each product."""
    return A.neighbour_lists(t.lineitem, "l_orderkey", "l_partkey")


@query(
    "item_recommendations",
    f"""WITH {NEIGHBOUR_SQL}, owned AS (SELECT DISTINCT o_custkey AS customer, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    tie AS (SELECT customer, other AS part, similarity, item FROM owned JOIN near USING (item)
      WHERE (customer, other) NOT IN (SELECT (customer, item) FROM owned)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY customer, other ORDER BY similarity DESC, item) = 1)
    SELECT customer, CAST(ROW_NUMBER() OVER (PARTITION BY customer ORDER BY similarity DESC, part) AS INTEGER) AS place, part,
      similarity / 1000000 AS score, item AS because FROM tie QUALIFY place <= 5""",
)
def item_recommendations(t: Tables) -> DataFrame:
    """Five products for each customer, from the neighbour lists of what the customer bought."""
    near = A.neighbour_lists(t.lineitem, "l_orderkey", "l_partkey")
    return A.recommend(bought(t), near, "customer", "part")


@query("stay_regression")
def stay_regression(t: Tables) -> DataFrame:
    """From what is known at admission; counts of lines, which are the stay, are left out."""
    return L.stay_regression(stay_rows(t), "length_of_stay", ["severity", "amount"], "admission_id", 50)


@query("mortality_survival")
def mortality_survival(t: Tables) -> DataFrame:
    rows = survival_data(completed(t), AS_OF)
    return L.hazard_model(rows, "survival_time", "churned", ["total_orders", "total_revenue"], "customer_id")


def newton_sql(steps: int = 8) -> str:
    """Newton's steps for one covariate x of rows (t, x, churned), one after the other; b{steps} holds the weight."""
    parts = ["b0 AS MATERIALIZED (SELECT CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS info)"]
    for i in range(steps):
        parts.append(f"""e{i} AS (SELECT t, SUM(exp(b * x)) AS s, SUM(x * exp(b * x)) AS s1, SUM(x * x * exp(b * x)) AS s2, SUM(churned) AS d, SUM(churned * x) AS own,
          SUM(churned * exp(b * x)) AS ds, SUM(churned * x * exp(b * x)) AS ds1, SUM(churned * x * x * exp(b * x)) AS ds2 FROM xs, b{i} GROUP BY t),
        r{i} AS (SELECT d, own, ds, ds1, ds2, SUM(s) OVER w AS s, SUM(s1) OVER w AS s1, SUM(s2) OVER w AS s2 FROM e{i} WINDOW w AS (ORDER BY t DESC)),
        l{i} AS (SELECT l, own, s - l / d * ds AS s, s1 - l / d * ds1 AS s1, s2 - l / d * ds2 AS s2
          FROM (SELECT *, CAST(unnest(range(CAST(d AS BIGINT))) AS DOUBLE) AS l FROM r{i} WHERE d > 0)),
        b{i + 1} AS MATERIALIZED (SELECT ANY_VALUE(b) + SUM(CASE WHEN l = 0 THEN own ELSE 0 END - s1 / s) / SUM(s2 / s - s1 * s1 / (s * s)) AS b,
          SUM(s2 / s - s1 * s1 / (s * s)) AS info FROM l{i}, b{i})""")
    return ",\n".join(parts)


SURVIVORS_SQL = SURVIVAL_SQL + ", xs AS (SELECT survival_time AS t, churned, total_orders - (SELECT AVG(total_orders) FROM surv) AS x FROM surv)"


@query(
    "hazard_ratio",
    f"""WITH {SURVIVORS_SQL}, {newton_sql()}
    SELECT 'total_orders' AS covariate, round_even(b, 6) AS coefficient, round_even(exp(b), 6) AS hazard_ratio, round_even(1 / sqrt(info), 6) AS std_error FROM b8""",
)
def hazard_ratio(t: Tables) -> DataFrame:
    """Proportional hazards of churn by the number of orders."""
    rows = survival_data(completed(t), AS_OF)
    found = Z.fit_hazards(rows, "survival_time", "churned", ["total_orders"]).table(rows)
    return found.select("covariate", *[rounded(c, 6).alias(c) for c in ("coefficient", "hazard_ratio", "std_error")])


@query(
    "concordance",
    f"""WITH {SURVIVAL_SQL}, p AS (SELECT COUNT(*) AS pairs, COUNT(*) FILTER (a.total_revenue > b.total_revenue) AS concordant,
      COUNT(*) FILTER (a.total_revenue = b.total_revenue) AS tied FROM surv a JOIN surv b ON b.survival_time > a.survival_time WHERE a.churned = 1)
    SELECT *, (concordant + 0.5 * tied) / nullif(CAST(pairs AS DOUBLE), 0) AS c_index FROM p""",
)
def concordance(t: Tables) -> DataFrame:
    """How well the revenue of customers orders their times until churn."""
    return Z.concordance(survival_data(completed(t), AS_OF), "survival_time", "churned", "total_revenue")


@query("hazard_model")
def hazard_model(t: Tables) -> DataFrame:
    """Hazard ratios fitted on four fifths of the customers, with concordance and calibration on the rest."""
    rows = durable(survival_data(completed(t), AS_OF).withColumn("_fold", N.fold_of("customer_id", 5, L.SEED)))
    held = rows.where("_fold = 0")
    model = Z.fit_hazards(rows.where("_fold <> 0"), "survival_time", "churned", ["total_orders", "total_revenue"])
    found = Z.concordance(held.withColumn("risk", model.risk()), "survival_time", "churned", "risk")
    slope = Z.calibration_slope(held, "survival_time", "churned", model)
    return model.table(rows).withColumns({"c_index": found.select("c_index").scalar(), "calibration_slope": F.lit(slope)})


def sensor_models(t: Tables, version: str) -> G.SensorModels:
    """Models of the table's readings, fitted on four fifths of them, written to the shared folder and read from there."""
    rows = stored(G.with_features(readings(t), "ts").withColumn("heavy", (F.col("feature_average_speed") < 15).cast("double")).select("event_id", "heavy", *G.FEATURES), "sensor-features")
    fit_on = rows.where(N.fold_of("event_id", 5, L.SEED) != 0)
    regression, classifier = L.fit_sensor_models(fit_on, "feature_average_speed", "heavy", G.INPUTS)
    folder = work_folder(t.spark, "sensor-models")
    G.SensorModels(regression, classifier, fit_isolation_forest(fit_on, G.FEATURES, "event_id"), version).save(t.spark, folder)
    return G.SensorModels.load(t.spark, folder)


@query("stream_model_alerts")
def stream_model_alerts(t: Tables) -> DataFrame:
    """The event stream scored by stored models: history and the three alerts come from one batch, with the model's version."""
    root = work_folder(t.spark, "model-alerts")
    keep = ["event_id", "sensor_id", "road_id", "model_version"]
    scores = G.scored(readings(live(t)), "ts", sensor_models(t, "r1"))
    write = J.append_batches(f"{root}/alerts")

    def alerts(batch: DataFrame, batch_id: int) -> None:
        write(T.all_alerts([T.sensor_anomalies(batch, keep), T.high_congestion(batch, keep), T.potential_incidents(batch, keep)]), batch_id)

    each = J.fan_out({"history": J.history_append(f"{root}/history", "ts"), "alerts": alerts})
    J.finish(J.start(scores, f"{root}/checkpoint", None, each=each))
    return t.spark.read.parquet(f"{root}/alerts").drop(J.BATCH)


@query(
    "incident_alerts_fitted",
    f"""WITH {SENSORS_SQL}, f AS (SELECT event_id, sensor_id, road_id, CAST(COALESCE(average_speed, 0) AS DOUBLE) AS y, CAST(vehicle_count AS DOUBLE) AS a, queue_length AS b FROM readings),
    m AS (SELECT AVG(y) AS y, AVG(a) AS a, AVG(b) AS b, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS "by" FROM f),
    w AS (SELECT *, (ay * bb - "by" * ab) / (aa * bb - ab * ab) AS wa, ("by" * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m),
    p AS (SELECT event_id, sensor_id, road_id, f.y AS speed, w.y + wa * (f.a - w.a) + wb * (f.b - w.b) AS predicted FROM f, w)
    SELECT 'potential_incident' AS type, event_id, sensor_id, road_id, 'r1' AS model_version, speed AS current_speed, round_even(predicted, 6) AS predicted_speed,
      CASE WHEN speed < 5 THEN 'high' ELSE 'medium' END AS severity FROM p WHERE speed < predicted * 0.3""",
)
def incident_alerts_fitted(t: Tables) -> DataFrame:
    """Speeds on the stream far below what a stored regression on traffic volume and queue expects."""
    inputs = ["feature_vehicle_count", "feature_queue_length"]
    rows = G.with_features(readings(t), "ts").withColumn("heavy", (F.col("feature_average_speed") < 15).cast("double"))
    regression, _ = L.fit_sensor_models(rows, "feature_average_speed", "heavy", inputs)
    folder = work_folder(t.spark, "speed-model")
    lake.save_models({"regression": regression}, folder)
    ready = G.with_features(readings(live(t)), "ts")
    predicted = lake.load_model(folder, "regression").transform(ready).withColumn("model_version", F.lit("r1"))
    alerts = drain(t, T.potential_incidents(predicted, ["event_id", "sensor_id", "road_id", "model_version"]))
    return alerts.withColumn("predicted_speed", rounded("predicted_speed", 6))
