"""Clinical risk expressions on admission rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfield.functions.flags import any_true, ordinal, out_of_range

# Diagnosis code prefixes treated as high risk.
HIGH_RISK_PREFIXES = ["428", "584", "038", "486", "599", "276"]

# Severity order.
SEVERITY = {"Minor": 1, "Moderate": 2, "Major": 3, "Extreme": 4}

# Published Charlson weights.
CHARLSON = {
    "myocardial_infarction": 1,
    "congestive_heart_failure": 1,
    "peripheral_vascular_disease": 1,
    "cerebrovascular_disease": 1,
    "dementia": 1,
    "chronic_pulmonary_disease": 1,
    "rheumatic_disease": 1,
    "peptic_ulcer_disease": 1,
    "mild_liver_disease": 1,
    "diabetes_without_complications": 1,
    "diabetes_with_complications": 2,
    "hemiplegia_paraplegia": 2,
    "renal_disease": 2,
    "malignancy": 2,
    "moderate_severe_liver_disease": 3,
    "metastatic_solid_tumor": 6,
    "aids_hiv": 6,
}

# Our own defaults: the reference leaves the normal ranges to a helper it does not ship.
LAB_RANGES = {
    "hemoglobin": (12.0, 17.5),
    "white_blood_count": (4.0, 11.0),
    "creatinine": (0.6, 1.3),
    "sodium": (135.0, 145.0),
    "potassium": (3.5, 5.0),
}

SOCIAL_RISKS = ["lives_alone", "transportation_issues", "financial_hardship"]


def high_risk_patient() -> Column:
    """Old, multi-morbid, recently admitted, or of major (not extreme) severity."""
    return any_true(
        F.col("age") >= 65,
        F.col("charlson_comorbidity_index") >= 3,
        F.col("previous_admissions_30d") > 0,
        F.col("severity_of_illness") == "Major",
    )


def vital_instability() -> Column:
    return any_true(
        F.col("avg_systolic_bp") > 180,
        F.col("avg_systolic_bp") < 90,
        F.col("avg_heart_rate") > 120,
        F.col("avg_heart_rate") < 50,
        F.col("avg_oxygen_saturation") < 95,
    )


def frequent_admissions() -> Column:
    return any_true(F.col("total_previous_admissions") >= 3)


def recent_admission() -> Column:
    return any_true(F.col("previous_admissions_30d") > 0)


def medication_burden() -> Column:
    return any_true(
        F.col("total_medications") > 10,
        F.col("high_risk_medications") > 0,
        F.col("polypharmacy_flag") == 1,
    )


def abnormal_lab_flags(
    columns: Sequence[str], ranges: Mapping[str, tuple[float, float]] = LAB_RANGES
) -> dict[str, Column]:
    """One 0/1 column per lab that is present and has a range."""
    return {f"{lab}_abnormal": out_of_range(lab, *ranges[lab]) for lab in ranges if lab in columns}


def severity_rank(name: str = "severity_of_illness") -> Column:
    return ordinal(name, SEVERITY, 1)


def readmitted_within(next_day: str, discharge_day: str, days: int = 30) -> Column:
    limit = F.date_add(F.col(discharge_day), days)
    return F.when(F.col(next_day).isNotNull() & (F.col(next_day) <= limit), 1).otherwise(0)
