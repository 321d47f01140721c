"""Whole-frame feature steps: fills, drops, de-identification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.buckets import GENERATION, below
from tallyfield.functions.dates import years_crossed
from tallyfield.functions.text import GENDER_CODES, clean_lower, clean_upper, plausible_email, recode
from tallyfield.operators.ordering import global_percentiles


def stage_customers(raw: DataFrame, as_of: str) -> DataFrame:
    """The staging form of the customer table: cleaned text, recodes, age and generation."""
    today = F.lit(as_of).cast("date")
    return (
        raw.where(plausible_email("email"))
        .withColumns(
            {
                "first_name": clean_upper("first_name"),
                "last_name": clean_upper("last_name"),
                "email": clean_lower("email"),
                "gender": recode("gender", GENDER_CODES),
                "age": years_crossed(F.col("date_of_birth"), today),
            }
        )
        .withColumn("generation", below("age", *GENERATION))
    )


def select_except(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return df.drop(*excluded)


def fill_constant(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.fillna(dict(values))


def fill_median(df: DataFrame, columns: Sequence[str], tie: str) -> DataFrame:
    """NULL to the exact median of the column."""
    medians = global_percentiles(df, {c: F.col(c) for c in columns}, [0.5], tie)
    return df.fillna({c: medians[c][0] for c in columns if medians[c][0] is not None})


def deidentify(df: DataFrame, salt: str, ids: Sequence[str], dates: Sequence[str], age: str,
               drop: Sequence[str]) -> DataFrame:
    """Salted hashes for ids, years for dates, ages of 90 and over pooled, identifiers dropped."""
    return df.withColumns(
        {
            **{c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in ids},
            **{c: F.year(c) for c in dates},
            age: F.when(F.col(age) >= 90, 90).otherwise(F.col(age)),
        }
    ).drop(*drop)
