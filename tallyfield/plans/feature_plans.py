"""Column-expression queries: cleaning, bins, calendar, risk flags, fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import buckets as B
from tallyfield.functions import clinical as K
from tallyfield.functions import dates as D
from tallyfield.functions import numbers as N
from tallyfield.functions import text as X
from tallyfield.functions import traffic as R
from tallyfield.functions.flags import any_true
from tallyfield.operators import frames
from tallyfield.plans.bindings import (
    AS_OF, CLINIC_SQL, ORDERS_SQL, PEOPLE_SQL, SENSORS_SQL, admissions, messages, orders, people, per_order, readings,
)
from tallyfield.plans.registry import Tables, query
from tallyfield.plans.source_plans import STAGED_SQL
from tallyfield.sources.messages import parse_json, rejected


@query("stg_clean", f"WITH {STAGED_SQL} SELECT customer_id, first_name, last_name, email FROM staged")
def stg_clean(t: Tables) -> DataFrame:
    return frames.stage_customers(people(t), AS_OF).select("customer_id", "first_name", "last_name", "email")


@query(
    "recode_category",
    f"""WITH {PEOPLE_SQL} SELECT customer_id, CASE WHEN upper(gender) IN ('M', 'MALE') THEN 'Male'
    WHEN upper(gender) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Other' END AS gender FROM people""",
)
def recode_category(t: Tables) -> DataFrame:
    return people(t).select("customer_id", X.recode("gender", X.GENDER_CODES).alias("gender"))


@query("email_filter", f"WITH {PEOPLE_SQL} SELECT customer_id, email FROM people WHERE email LIKE '%@%'")
def email_filter(t: Tables) -> DataFrame:
    return people(t).where(X.plausible_email("email")).select("customer_id", "email")


@query(
    "generation_bucket",
    f"""WITH {PEOPLE_SQL}, aged AS (SELECT customer_id, 2001 - year(date_of_birth) AS a FROM people)
    SELECT customer_id, CASE WHEN a < 25 THEN 'Gen Z' WHEN a < 40 THEN 'Millennial' WHEN a < 55 THEN 'Gen X'
    ELSE 'Baby Boomer' END AS generation FROM aged""",
)
def generation_bucket(t: Tables) -> DataFrame:
    age = D.years_crossed("date_of_birth", F.lit(AS_OF).cast("date"))
    return people(t).select("customer_id", B.below(age, *B.GENERATION).alias("generation"))


@query(
    "age_two_ways",
    f"""WITH {PEOPLE_SQL} SELECT customer_id, CAST(date_diff('year', date_of_birth, DATE '{AS_OF}') AS INTEGER) AS age_by_year,
    CAST(floor(date_diff('day', date_of_birth, DATE '{AS_OF}') / 365) AS INTEGER) AS age_by_days FROM people""",
)
def age_two_ways(t: Tables) -> DataFrame:
    today = F.lit(AS_OF).cast("date")
    return people(t).select(
        "customer_id",
        D.years_crossed("date_of_birth", today).alias("age_by_year"),
        D.age_in_365_day_years("date_of_birth", today).alias("age_by_days"),
    )


def _cut_sql(column: str, edges, labels) -> str:
    arms = [f"WHEN {column} <= {edges[0]} THEN NULL"]
    for upper, label in zip(edges[1:], labels):
        test = f"{column} IS NOT NULL" if upper == float("inf") else f"{column} <= {upper}"
        arms.append(f"WHEN {test} THEN '{label}'")
    return "CASE " + " ".join(arms) + " END"


@query(
    "cut_right_closed",
    f"""WITH {CLINIC_SQL}, base AS (SELECT admission_id, length_of_stay, 2001 - year(date_of_birth) AS age,
      CAST(length_of_stay AS DOUBLE) * 5 + 5 AS bmi FROM adm JOIN people ON patient_id = customer_id)
    SELECT admission_id, {_cut_sql('age', *B.AGE_GROUP)} AS age_group, {_cut_sql('age', *B.CLINICAL_AGE)} AS age_category,
    {_cut_sql('length_of_stay', *B.STAY)} AS los_category, {_cut_sql('bmi', *B.BMI_CLASS)} AS bmi_category FROM base""",
)
def cut_right_closed(t: Tables) -> DataFrame:
    ages = people(t).select(
        F.col("customer_id").alias("patient_id"),
        D.years_crossed("date_of_birth", F.lit(AS_OF).cast("date")).alias("age"),
    )
    return admissions(t).join(ages, "patient_id").select(
        "admission_id",
        B.cut("age", *B.AGE_GROUP).alias("age_group"),
        B.cut("age", *B.CLINICAL_AGE).alias("age_category"),
        B.cut("length_of_stay", *B.STAY).alias("los_category"),
        B.cut(F.col("length_of_stay").cast("double") * 5 + 5, *B.BMI_CLASS).alias("bmi_category"),
    )


@query(
    "calendar_parts",
    f"""WITH {ORDERS_SQL} SELECT order_id, CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month, CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    dayname(order_date) AS order_day_of_week FROM ord""",
)
def calendar_parts(t: Tables) -> DataFrame:
    return orders(t).select("order_id", *[c.alias(n) for n, c in D.calendar_parts("order_date").items()])


@query(
    "clock_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM events""",
)
def clock_parts(t: Tables) -> DataFrame:
    return t.events.select("event_id", *[c.alias(n) for n, c in D.clock_parts("ts").items()])


@query(
    "month_trunc",
    f"""WITH {ORDERS_SQL} SELECT customer_id, CAST(MIN(date_trunc('month', order_date)) AS DATE) AS first_month,
    COUNT(DISTINCT date_trunc('month', order_date)) AS active_months FROM ord GROUP BY 1""",
)
def month_trunc(t: Tables) -> DataFrame:
    months = orders(t).select("customer_id", D.month_start("order_date").alias("m")).distinct()
    return months.groupBy("customer_id").agg(
        F.min("m").alias("first_month"), F.count(F.lit(1)).alias("active_months")
    )


@query(
    "month_boundary_diff",
    f"WITH {ORDERS_SQL} SELECT order_id, CAST(date_diff('month', order_date, DATE '{AS_OF}') AS INTEGER) AS months FROM ord",
)
def month_boundary_diff(t: Tables) -> DataFrame:
    return orders(t).select("order_id", D.months_crossed("order_date", F.lit(AS_OF).cast("date")).alias("months"))


@query(
    "day_diffs",
    f"""WITH {ORDERS_SQL} SELECT customer_id, CAST(DATE '{AS_OF}' - MAX(order_date) AS INTEGER) AS days_since_last,
    CAST(MAX(order_date) - MIN(order_date) AS INTEGER) AS span FROM ord GROUP BY 1""",
)
def day_diffs(t: Tables) -> DataFrame:
    return orders(t).groupBy("customer_id").agg(
        D.days_between(F.max("order_date"), F.lit(AS_OF).cast("date")).alias("days_since_last"),
        D.days_between(F.min("order_date"), F.max("order_date")).alias("span"),
    )


@query(
    "density",
    f"""WITH {SENSORS_SQL} SELECT event_id, CASE WHEN occupancy = 0 THEN NULL ELSE vehicle_count / occupancy END AS traffic_density
    FROM readings""",
)
def density(t: Tables) -> DataFrame:
    return readings(t).select("event_id", R.density("vehicle_count", "occupancy").alias("traffic_density"))


LEVEL_SQL = """CASE WHEN average_speed < 15 THEN 'Heavy' WHEN average_speed < 30 THEN 'Moderate'
  WHEN average_speed < 50 THEN 'Light' ELSE 'Free Flow' END"""


@query(
    "congestion_level",
    f"""WITH {SENSORS_SQL} SELECT event_id, {LEVEL_SQL} AS congestion_level,
    CASE WHEN average_speed IS NULL THEN 'Unknown' ELSE {LEVEL_SQL} END AS strict_level FROM readings""",
)
def congestion_level(t: Tables) -> DataFrame:
    return readings(t).select(
        "event_id",
        R.congestion_level("average_speed").alias("congestion_level"),
        R.congestion_level("average_speed", unknown=True).alias("strict_level"),
    )


@query(
    "json_parse_flatten",
    f"""WITH {SENSORS_SQL}, cleaned AS (SELECT *, NOT (road_id = 'error' AND vehicle_count % 5 = 0) AS ok FROM readings)
    SELECT event_id, CASE WHEN ok THEN sensor_id END AS sensor_id, CASE WHEN ok THEN ts END AS "timestamp",
    CASE WHEN ok THEN road_id END AS road_id, CASE WHEN ok THEN vehicle_count END AS vehicle_count,
    CASE WHEN ok THEN average_speed END AS average_speed FROM cleaned""",
)
def json_parse_flatten(t: Tables) -> DataFrame:
    return parse_json(messages(t), R.TRAFFIC_SCHEMA, keep=["event_id"]).select(
        "event_id", "sensor_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "location.road_id",
        "measurements.vehicle_count", "measurements.average_speed",
    )


@query("json_rejects", f"WITH {SENSORS_SQL} SELECT event_id, 20 AS rejected_length FROM readings WHERE road_id = 'error' AND vehicle_count % 5 = 0")
def json_rejects(t: Tables) -> DataFrame:
    """The other side of ``json_parse_flatten``: messages that the schema refuses, with their text."""
    return rejected(messages(t), R.TRAFFIC_SCHEMA, keep=["event_id"]).select("event_id", F.length("rejected").alias("rejected_length"))


@query(
    "nested_access",
    f"""WITH {SENSORS_SQL} SELECT event_id, lane_id, vehicle_count AS cars, CAST(vehicle_count % 7 AS INTEGER) AS trucks,
    CAST(vehicle_count + vehicle_count % 7 AS INTEGER) AS vehicles FROM readings
    WHERE NOT (road_id = 'error' AND vehicle_count % 5 = 0)""",
)
def nested_access(t: Tables) -> DataFrame:
    parsed = parse_json(messages(t), R.TRAFFIC_SCHEMA, keep=["event_id"]).where(F.col("sensor_id").isNotNull())
    kinds = F.col("vehicle_classification")
    return parsed.select(
        "event_id",
        "location.lane_id",
        F.element_at(kinds, "car").alias("cars"),
        F.element_at(kinds, "truck").alias("trucks"),
        F.aggregate(F.map_values(kinds), F.lit(0), lambda a, x: a + x).alias("vehicles"),
    )


@query("ingest_time", f"SELECT event_id, TIMESTAMP '{AS_OF} 00:00:00' AS processing_time FROM events")
def ingest_time(t: Tables) -> DataFrame:
    """The clock is an argument; streaming jobs pass ``current_timestamp()``."""
    return t.events.select("event_id", F.lit(f"{AS_OF} 00:00:00").cast("timestamp_ntz").alias("processing_time"))


CLINICAL_SQL = CLINIC_SQL + """, risk AS (
  SELECT a.*, 2001 - year(date_of_birth) AS age, CAST(COALESCE(r, 0) AS INTEGER) AS charlson_comorbidity_index,
         a AS previous_admissions_30d, n * 4 AS total_previous_admissions,
         80 + q_max * 2.2 AS avg_systolic_bp, 40 + q / CAST(n AS DOUBLE) * 2 AS avg_heart_rate, 90 + d / CAST(n AS DOUBLE) AS avg_oxygen_saturation,
         q / CAST(n AS DOUBLE) / 2 AS hemoglobin, q / CAST(n AS DOUBLE) / 4 AS white_blood_count, x / CAST(n AS DOUBLE) * 0.3 AS creatinine,
         100 + q / CAST(n AS DOUBLE) * 1.4 AS sodium, 2 + d / CAST(n AS DOUBLE) * 0.5 AS potassium,
         n * 2 AS total_medications, f AS high_risk_medications, CASE WHEN k = 7 THEN 1 ELSE 0 END AS polypharmacy_flag,
         r AS lives_alone, f AS transportation_issues, CASE WHEN n > 3 THEN a END AS financial_hardship,
         CASE WHEN length_of_stay % 3 = 0 THEN '428' WHEN length_of_stay % 3 = 1 THEN '276' ELSE 'Z99' END || '.' || CAST(a.patient_id % 10 AS VARCHAR) AS diagnosis
  FROM adm a LEFT JOIN per_order p ON a.admission_id = p.admission_id JOIN people ON a.patient_id = customer_id)"""


def clinical(t: Tables) -> DataFrame:
    """Admissions with the clinical columns the risk expressions read; NULL where an order has no line."""
    mean = lambda c: F.col(c) / F.col("n").cast("double")
    ages = people(t).select(
        F.col("customer_id").alias("patient_id"),
        D.years_crossed("date_of_birth", F.lit(AS_OF).cast("date")).alias("age"),
    )
    stay = F.col("length_of_stay") % 3
    return (
        admissions(t, per_order(t))
        .join(ages, "patient_id")
        .withColumns(
            {
                "charlson_comorbidity_index": F.coalesce("r", F.lit(0)).cast("int"),
                "previous_admissions_30d": F.col("a"),
                "total_previous_admissions": F.col("n") * 4,
                "avg_systolic_bp": 80 + F.col("q_max") * 2.2,
                "avg_heart_rate": 40 + mean("q") * 2,
                "avg_oxygen_saturation": 90 + mean("d"),
                "hemoglobin": mean("q") / 2,
                "white_blood_count": mean("q") / 4,
                "creatinine": mean("x") * 0.3,
                "sodium": 100 + mean("q") * 1.4,
                "potassium": 2 + mean("d") * 0.5,
                "total_medications": F.col("n") * 2,
                "high_risk_medications": F.col("f"),
                "polypharmacy_flag": any_true(F.col("k") == 7),
                "lives_alone": F.col("r"),
                "transportation_issues": F.col("f"),
                "financial_hardship": F.when(F.col("n") > 3, F.col("a")),
                "diagnosis": F.concat(
                    F.when(stay == 0, "428").when(stay == 1, "276").otherwise("Z99"),
                    F.lit("."),
                    (F.col("patient_id") % 10).cast("string"),
                ),
            }
        )
    )


def _any_sql(*terms: str) -> str:
    return "CAST(" + " OR ".join(f"COALESCE({x}, FALSE)" for x in terms) + " AS INTEGER)"


@query(
    "risk_flags",
    f"""WITH {CLINICAL_SQL} SELECT admission_id,
    {_any_sql('age >= 65', 'charlson_comorbidity_index >= 3', 'previous_admissions_30d > 0', "severity_of_illness = 'Major'")} AS high_risk_patient,
    {_any_sql('avg_systolic_bp > 180', 'avg_systolic_bp < 90', 'avg_heart_rate > 120', 'avg_heart_rate < 50', 'avg_oxygen_saturation < 95')} AS vital_instability,
    {_any_sql('total_previous_admissions >= 3')} AS frequent_flyer, {_any_sql('previous_admissions_30d > 0')} AS recent_admission,
    {_any_sql('total_medications > 10', 'high_risk_medications > 0', 'polypharmacy_flag = 1')} AS high_med_burden FROM risk""",
)
def risk_flags(t: Tables) -> DataFrame:
    return clinical(t).select(
        "admission_id",
        K.high_risk_patient().alias("high_risk_patient"),
        K.vital_instability().alias("vital_instability"),
        K.frequent_admissions().alias("frequent_flyer"),
        K.recent_admission().alias("recent_admission"),
        K.medication_burden().alias("high_med_burden"),
    )


_LABS = {lab: f"COALESCE(CAST({lab} < {lo} OR {lab} > {hi} AS INTEGER), 0)" for lab, (lo, hi) in K.LAB_RANGES.items()}


@query(
    "abnormal_lab_count",
    f"""WITH {CLINICAL_SQL} SELECT admission_id, {', '.join(f'{e} AS {lab}_abnormal' for lab, e in _LABS.items())},
    {' + '.join(_LABS.values())} AS abnormal_labs_count FROM risk""",
)
def abnormal_lab_count(t: Tables) -> DataFrame:
    rows = clinical(t)
    flags = K.abnormal_lab_flags(rows.columns)
    flagged = rows.withColumns(flags)
    return flagged.select("admission_id", *flags, N.null_as_zero_sum(list(flags)).alias("abnormal_labs_count"))


@query(
    "null_safe_row_sum",
    f"""WITH {CLINICAL_SQL} SELECT admission_id, COALESCE(lives_alone, 0) + COALESCE(transportation_issues, 0)
    + COALESCE(financial_hardship, 0) AS social_risk_score FROM risk""",
)
def null_safe_row_sum(t: Tables) -> DataFrame:
    return clinical(t).select("admission_id", N.null_as_zero_sum(K.SOCIAL_RISKS).alias("social_risk_score"))


@query(
    "interactions",
    f"""WITH {CLINICAL_SQL} SELECT admission_id, CAST(age * charlson_comorbidity_index AS INTEGER) AS age_comorbidity_interaction,
    CAST(length_of_stay * CASE severity_of_illness WHEN 'Minor' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'Major' THEN 3
      WHEN 'Extreme' THEN 4 ELSE 1 END AS INTEGER) AS los_severity_interaction FROM risk""",
)
def interactions(t: Tables) -> DataFrame:
    return clinical(t).select(
        "admission_id",
        (F.col("age") * F.col("charlson_comorbidity_index")).alias("age_comorbidity_interaction"),
        (F.col("length_of_stay") * K.severity_rank()).alias("los_severity_interaction"),
    )


@query(
    "code_prefix_flag",
    f"""WITH {CLINICAL_SQL} SELECT admission_id, CAST(substring(diagnosis, 1, 3) IN ('428','584','038','486','599','276') AS INTEGER)
    AS high_risk_diagnosis FROM risk""",
)
def code_prefix_flag(t: Tables) -> DataFrame:
    return clinical(t).select("admission_id", X.prefix_in("diagnosis", K.HIGH_RISK_PREFIXES).alias("high_risk_diagnosis"))


@query(
    "bmi",
    f"""WITH b AS (SELECT p_partkey, p_retailprice / CAST(20 AS DOUBLE) AS w, (CAST(100 AS DOUBLE) + p_size * 2) / 100 AS m FROM part),
    v AS (SELECT p_partkey, w / (m * m) AS raw FROM b)
    SELECT p_partkey, round_even(raw, 6) AS bmi, {_cut_sql('raw', *B.BMI_CLASS)} AS bmi_category FROM v""",
)
def bmi(t: Tables) -> DataFrame:
    value = N.bmi(F.col("p_retailprice") / F.lit(20.0), F.lit(100.0) + F.col("p_size") * 2)
    return t.part.select(
        "p_partkey", N.rounded(value, 6).alias("bmi"), B.cut(value, *B.BMI_CLASS).alias("bmi_category")
    )


# Fixed binding: which line-derived test stands for each condition.
CONDITIONS = {
    "myocardial_infarction": "r >= 1", "congestive_heart_failure": "a >= 1", "peripheral_vascular_disease": "f >= 1",
    "cerebrovascular_disease": "n >= 2", "dementia": "n >= 3", "chronic_pulmonary_disease": "n >= 4",
    "rheumatic_disease": "n >= 5", "peptic_ulcer_disease": "n >= 6", "mild_liver_disease": "k >= 5",
    "diabetes_without_complications": "k >= 6", "diabetes_with_complications": "k >= 7",
    "hemiplegia_paraplegia": "q_max >= 45", "renal_disease": "q_max >= 48", "malignancy": "r >= 2",
    "moderate_severe_liver_disease": "d >= 30", "metastatic_solid_tumor": "x >= 30", "aids_hiv": "a >= 3",
}


@query(
    "comorbidity_score",
    f"""WITH {CLINIC_SQL} SELECT a.admission_id, CAST({' + '.join(f'COALESCE(CAST({c} AS INTEGER), 0) * {K.CHARLSON[n]}' for n, c in CONDITIONS.items())}
    AS INTEGER) AS charlson_comorbidity_index FROM adm a LEFT JOIN per_order p ON a.admission_id = p.admission_id""",
)
def comorbidity_score(t: Tables) -> DataFrame:
    flagged = admissions(t).select("admission_id").join(per_order(t), "admission_id", "left").withColumns(
        {name: F.expr(test).cast("int") for name, test in CONDITIONS.items()}
    )
    return flagged.select("admission_id", N.weighted_flags(K.CHARLSON).alias("charlson_comorbidity_index"))


@query(
    "deidentify",
    f"""WITH {PEOPLE_SQL} SELECT sha256('salt-1' || CAST(customer_id AS VARCHAR)) AS customer_id,
    CAST(year(date_of_birth) AS INTEGER) AS date_of_birth, gender, nation_key,
    CAST(CASE WHEN 2015 - year(date_of_birth) >= 90 THEN 90 ELSE 2015 - year(date_of_birth) END AS INTEGER) AS age FROM people""",
)
def deidentify(t: Tables) -> DataFrame:
    aged = people(t).withColumn("age", D.years_crossed("date_of_birth", F.lit("2015-01-01").cast("date")))
    return frames.deidentify(
        aged, "salt-1", ["customer_id"], ["date_of_birth"], "age", ["first_name", "last_name", "email", "balance"]
    )


@query(
    "round2",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_shipdate, round_even(l_extendedprice * (1 - l_discount), 2) AS net FROM lineitem",
)
def round2(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
        N.rounded(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net"),
    )


@query("select_except", f"WITH {PEOPLE_SQL} SELECT * EXCLUDE (first_name, last_name, email) FROM people")
def select_except(t: Tables) -> DataFrame:
    return frames.select_except(people(t), ["first_name", "last_name", "email"])


@query(
    "fill_constant",
    f"""WITH {SENSORS_SQL} SELECT event_id, COALESCE(average_speed, 0) AS average_speed, CAST(vehicle_count AS INTEGER) AS vehicle_count,
    CAST(20 AS DOUBLE) AS temperature FROM readings""",
)
def fill_constant(t: Tables) -> DataFrame:
    rows = readings(t).select("event_id", "average_speed", "vehicle_count", F.lit(None).cast("double").alias("temperature"))
    return frames.fill_constant(
        rows, {c: R.FEATURE_DEFAULTS[c] for c in ("average_speed", "vehicle_count", "temperature")}
    )


@query(
    "fill_median",
    f"""WITH {SENSORS_SQL} SELECT event_id, COALESCE(average_speed, (SELECT quantile_cont(average_speed, 0.5) FROM readings)) AS average_speed,
    COALESCE(CASE WHEN occupancy > 0.2 THEN occupancy END, (SELECT quantile_cont(occupancy, 0.5) FROM readings WHERE occupancy > 0.2)) AS occupancy
    FROM readings""",
)
def fill_median(t: Tables) -> DataFrame:
    rows = readings(t).select(
        "event_id", "average_speed", F.when(F.col("occupancy") > 0.2, F.col("occupancy")).alias("occupancy")
    )
    return frames.fill_median(rows, ["average_speed", "occupancy"], "event_id")


@query(
    "guarded_ratio",
    f"""WITH {ORDERS_SQL}, m AS (SELECT customer_id, COUNT(*) AS n, CAST(MAX(order_date) - MIN(order_date) AS INTEGER) AS span FROM ord GROUP BY 1)
    SELECT customer_id, round_even(CASE WHEN n > 1 THEN CAST(span AS DOUBLE) / (n - 1) END, 6) AS mean_gap,
    round_even(n / greatest(span / CAST(365 AS DOUBLE), CAST(1 AS DOUBLE) / 365), 6) AS frequency FROM m""",
)
def guarded_ratio(t: Tables) -> DataFrame:
    spans = orders(t).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), D.days_between(F.min("order_date"), F.max("order_date")).alias("span")
    )
    years = N.floored_divisor(F.col("span") / F.lit(365.0), 1.0 / 365)
    return spans.select(
        "customer_id",
        N.rounded(N.mean_gap(F.col("span").cast("double"), "n"), 6).alias("mean_gap"),
        N.rounded(F.col("n") / years, 6).alias("frequency"),
    )
