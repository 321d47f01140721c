"""Feature preparation and exact evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import clinical as K
from tallyfield.functions.numbers import rounded
from tallyfield.operators import customers as C
from tallyfield.operators import encoding as N
from tallyfield.operators import evaluation as V
from tallyfield.plans.customer_plans import EXTRACT_SQL, completed
from tallyfield.plans.bindings import AS_OF
from tallyfield.plans.history_plans import NEXT_SQL, labelled_stays
from tallyfield.plans.registry import Tables, query
from tallyfield.session import durable

SEVERITY_SQL = "CASE severity_of_illness WHEN 'Minor' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'Major' THEN 3 WHEN 'Extreme' THEN 4 ELSE 1 END"
SCORE_SQL = NEXT_SQL + f""", scored AS (SELECT admission_id, readmitted_30d AS label,
  round_even((length_of_stay * 3 + {SEVERITY_SQL} * 5 + patient_id % 17) / CAST(60 AS DOUBLE), 4) AS score FROM labelled)"""

CURVE_SQL = SCORE_SQL + """, pts AS (SELECT score, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS pos FROM scored GROUP BY 1),
curve AS (SELECT score, n, pos, CAST(SUM(n) OVER (ORDER BY score DESC) AS BIGINT) AS above, CAST(SUM(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
  (SELECT SUM(label) FROM scored) AS p, (SELECT COUNT(*) FROM scored) AS total FROM pts)"""


def scored_stays(t: Tables) -> DataFrame:
    """Readmission labels with a fixed linear score that has many ties."""
    raw = F.col("length_of_stay") * 3 + K.severity_rank() * 5 + F.col("patient_id") % 17
    return labelled_stays(t).select(
        "admission_id", F.col("readmitted_30d").alias("label"), rounded(raw / F.lit(60.0), 4).alias("score")
    )


#: The clustering features and the columns of the extract that hold them.
CLUSTER_SOURCES = {
    "recency": "days_since_last_order", "frequency": "total_orders", "monetary": "total_revenue",
    "avg_order_value": "avg_order_value", "customer_lifespan": "customer_lifespan", "active_months": "active_months",
}


def standard_sql() -> str:
    moments = ", ".join(f"AVG({c}) AS m_{n}, stddev_pop({c}) AS s_{n}" for n, c in CLUSTER_SOURCES.items())
    scores = ", ".join(f"round_even(COALESCE(({c} - m_{n}) / nullif(s_{n}, 0), 0), 6) + 0 AS {n}_z" for n, c in CLUSTER_SOURCES.items())
    return f"WITH {EXTRACT_SQL}, m AS (SELECT {moments} FROM extract) SELECT customer_id, {scores} FROM extract, m"


@query("standardise", standard_sql())
def standardise(t: Tables) -> DataFrame:
    """All six clustering features."""
    rows = durable(C.segmentation_extract(completed(t), AS_OF).select("customer_id", *[F.col(c).alias(n) for n, c in CLUSTER_SOURCES.items()]))
    out = N.standardise(rows, list(CLUSTER_SOURCES))
    return out.select("customer_id", *[(rounded(f"{n}_z", 6) + F.lit(0.0)).alias(f"{n}_z") for n in CLUSTER_SOURCES])


@query(
    "one_hot_or_index",
    """SELECT p_partkey, CAST(p_type = 'LARGE' AS INTEGER) AS "p_type_LARGE", CAST(p_type = 'MEDIUM' AS INTEGER) AS "p_type_MEDIUM",
    CAST(p_type = 'PROMO' AS INTEGER) AS "p_type_PROMO", CAST(p_type = 'SMALL' AS INTEGER) AS "p_type_SMALL",
    CAST(p_type = 'STANDARD' AS INTEGER) AS "p_type_STANDARD",
    CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand FROM part""",
)
def one_hot_or_index(t: Tables) -> DataFrame:
    """Six types become columns, 25 brands become codes."""
    return N.one_hot_or_index(N.one_hot_or_index(t.part.select("p_partkey", "p_type", "p_brand"), "p_type"), "p_brand")


@query(
    "anova_select_k",
    f"""WITH {NEXT_SQL}, x AS (SELECT readmitted_30d AS y, 'length_of_stay' AS feature, CAST(length_of_stay AS DOUBLE) AS v FROM labelled
      UNION ALL SELECT readmitted_30d, 'amount', amount FROM labelled UNION ALL SELECT readmitted_30d, 'severity', {SEVERITY_SQL} FROM labelled),
    g AS (SELECT feature, AVG(v) AS m, COUNT(*) AS n FROM x GROUP BY 1),
    c AS (SELECT feature, y, AVG(v) AS m, var_pop(v) AS s, COUNT(*) AS n FROM x GROUP BY 1, 2),
    s AS (SELECT feature, SUM(c.n * (c.m - g.m) * (c.m - g.m)) AS b, SUM(c.n * c.s) AS w, COUNT(*) AS k, ANY_VALUE(g.n) AS n FROM c JOIN g USING (feature) GROUP BY 1)
    SELECT feature, round_even((b / (k - 1)) / (w / (n - k)), 4) AS f_value FROM s ORDER BY 2 DESC LIMIT 2""",
)
def anova_select_k(t: Tables) -> DataFrame:
    rows = labelled_stays(t).withColumn("severity", K.severity_rank())
    scores = N.anova_f(rows, "readmitted_30d", ["length_of_stay", "amount", "severity"])
    return scores.orderBy(F.desc_nulls_last("f_value"), "feature").limit(2)


@query(
    "stratified_split",
    f"""WITH {NEXT_SQL}, r AS (SELECT admission_id, readmitted_30d, row_number() OVER (PARTITION BY readmitted_30d ORDER BY md5('42-' || CAST(admission_id AS VARCHAR)), admission_id) AS k,
      COUNT(*) OVER (PARTITION BY readmitted_30d) AS n FROM labelled)
    SELECT admission_id, readmitted_30d, CAST(k <= (n * 8 + 5) // 10 AS INTEGER) AS is_train FROM r""",
)
def stratified_split(t: Tables) -> DataFrame:
    return N.stratified_split(labelled_stays(t).select("admission_id", "readmitted_30d"), "readmitted_30d", "admission_id")


@query(
    "stratified_folds",
    f"""WITH {NEXT_SQL}, r AS (SELECT admission_id, readmitted_30d, row_number() OVER (PARTITION BY readmitted_30d ORDER BY md5('42-' || CAST(admission_id AS VARCHAR)), admission_id) AS k FROM labelled)
    SELECT admission_id, readmitted_30d, CAST((k - 1) % 5 AS INTEGER) AS fold FROM r""",
)
def stratified_folds(t: Tables) -> DataFrame:
    """The folds of the cross-validation."""
    return N.stratified_folds(labelled_stays(t).select("admission_id", "readmitted_30d"), "readmitted_30d", "admission_id")


@query(
    "class_weights",
    f"""WITH {NEXT_SQL}, c AS (SELECT readmitted_30d, COUNT(*) AS n FROM labelled GROUP BY 1)
    SELECT readmitted_30d, n, round_even((SELECT SUM(n) FROM c) / CAST((SELECT COUNT(*) FROM c) * n AS DOUBLE), 6) AS weight FROM c""",
)
def class_weights(t: Tables) -> DataFrame:
    return N.class_weights(labelled_stays(t), "readmitted_30d")


@query(
    "roc_auc",
    f"""WITH {SCORE_SQL}, r AS (SELECT label, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS mid FROM scored),
    k AS (SELECT SUM(label) AS p, COUNT(*) - SUM(label) AS n, SUM(mid) FILTER (label = 1) AS s FROM r)
    SELECT CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives,
    round_even((s - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * n), 8) AS auc FROM k""",
)
def roc_auc(t: Tables) -> DataFrame:
    return V.roc_auc(V.score_curve(scored_stays(t)))


@query(
    "roc_curve",
    f"""WITH {CURVE_SQL} SELECT score AS threshold, round_even(tp / CAST(p AS DOUBLE), 6) AS tpr,
    round_even((above - tp) / CAST(total - p AS DOUBLE), 6) AS fpr FROM curve""",
)
def roc_curve(t: Tables) -> DataFrame:
    return V.roc_curve(V.score_curve(scored_stays(t)))


@query(
    "pr_curve",
    f"""WITH {CURVE_SQL} SELECT score AS threshold, round_even(tp / CAST(above AS DOUBLE), 6) AS precision,
    round_even(tp / CAST(p AS DOUBLE), 6) AS recall FROM curve""",
)
def pr_curve(t: Tables) -> DataFrame:
    return V.pr_curve(V.score_curve(scored_stays(t)))


_CELLS_SQL = """COUNT(*) FILTER (label = 1 AND score >= {t}) AS tp, COUNT(*) FILTER (label = 0 AND score >= {t}) AS fp,
  COUNT(*) FILTER (label = 0 AND score < {t}) AS tn, COUNT(*) FILTER (label = 1 AND score < {t}) AS fn"""


@query(
    "confusion_and_report",
    f"""WITH {SCORE_SQL}, c AS (SELECT {_CELLS_SQL.format(t=0.5)} FROM scored)
    SELECT *, round_even(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 6) AS precision_1, round_even(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS recall_1,
    round_even(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 6) AS f1_1, tp + fn AS support_1,
    round_even(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 6) AS precision_0, round_even(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 6) AS recall_0,
    round_even(2 * tn / nullif(CAST(2 * tn + fp + fn AS DOUBLE), 0), 6) AS f1_0, tn + fp AS support_0,
    round_even((tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS accuracy FROM c""",
)
def confusion_and_report(t: Tables) -> DataFrame:
    return V.confusion(scored_stays(t), 0.5)


@query(
    "threshold_sweep",
    f"""WITH {SCORE_SQL}, c AS ({' UNION ALL '.join(f"SELECT CAST({x} AS DOUBLE) AS threshold, {_CELLS_SQL.format(t=x)} FROM scored" for x in V.THRESHOLDS)})
    SELECT *, round_even(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS sensitivity, round_even(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 6) AS specificity,
    round_even(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 6) AS ppv, round_even(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 6) AS npv,
    round_even(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 6) AS f1, round_even((tp + fp) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS alert_rate FROM c""",
)
def threshold_sweep(t: Tables) -> DataFrame:
    return V.threshold_sweep(scored_stays(t))


@query(
    "f2_optimum",
    f"""WITH {CURVE_SQL}, f AS (SELECT score AS threshold, tp / CAST(above AS DOUBLE) AS pr, tp / CAST(p AS DOUBLE) AS re FROM curve),
    g AS (SELECT *, round_even(5 * pr * re / nullif(4 * pr + re, 0), 9) AS f2 FROM f)
    SELECT threshold, round_even(pr, 6) AS precision, round_even(re, 6) AS recall, round_even(f2, 6) AS f2_score FROM g WHERE f2 IS NOT NULL
    ORDER BY f2 DESC, threshold LIMIT 1""",
)
def f2_optimum(t: Tables) -> DataFrame:
    return V.f2_optimum(V.score_curve(scored_stays(t)))


@query(
    "intervention_value",
    f"""WITH {SCORE_SQL}, c AS (SELECT {_CELLS_SQL.format(t=0.3)} FROM scored)
    SELECT tp * CAST(5250 AS DOUBLE) AS value_saved, (tp + fp) * CAST(1000 AS DOUBLE) AS intervention_cost,
    tp * CAST(5250 AS DOUBLE) - (tp + fp) * 1000 AS net_value,
    round_even(CASE WHEN tp + fp > 0 THEN (tp * CAST(5250 AS DOUBLE) - (tp + fp) * 1000) / ((tp + fp) * CAST(1000 AS DOUBLE)) ELSE 0 END, 6) AS roi,
    tp + fp AS patients_flagged, tp AS true_positives, fp AS false_positives, fn AS false_negatives, fn * 15000 AS missed_opportunity FROM c""",
)
def intervention_value(t: Tables) -> DataFrame:
    return V.intervention_value(scored_stays(t))
