"""Data-quality checks: one shared scan for row rules, one report, one gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.text import EMAIL_PATTERN


@dataclass(frozen=True)
class Rule:
    """A named row rule: ``bad`` is true for rows that break it."""

    name: str
    bad: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column} not null", F.col(column).isNull())


def matches(column: str, pattern: str = EMAIL_PATTERN) -> Rule:
    return Rule(f"{column} matches pattern", F.col(column).isNotNull() & ~F.col(column).rlike(pattern))


def between(column: str, low: float, high: float) -> Rule:
    return Rule(f"{column} between", F.col(column).isNotNull() & ~F.col(column).between(low, high))


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Expected columns the frame lacks. No job runs."""
    return [c for c in columns if c not in df.columns]


def column_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: present or not, rows checked, rows that are not NULL."""
    absent = set(missing_columns(df, expected))
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(c not in absent).alias("present"), F.count(F.lit(1)).alias("checked"),
                 (F.lit(0).cast("bigint") if c in absent else F.count(c)).alias("filled"))
        for c in expected
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def broken_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check_name, checked, failed) for row rules, all from one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(F.coalesce(rule.bad, F.lit(False))).alias(f"r{i}") for i, rule in enumerate(rules)],
    )
    lines = [F.struct(F.lit(r.name).alias("check_name"), F.col(f"r{i}").alias("failed")) for i, r in enumerate(rules)]
    return counts.select("checked", F.explode(F.array(*lines)).alias("line")).select(
        "line.check_name", "checked", "line.failed"
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """Rows that share a non-NULL key with another row."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    groups = df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.lit(label or f"{', '.join(columns)} unique").alias("check_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
    )


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, label: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    Children are counted per key first, so a hot key crosses the shuffle as one row.
    """
    per_key = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(parent_key).alias("_k")).distinct().withColumn("_known", F.lit(True))
    return per_key.join(known, "_k", "left").agg(
        F.lit(label).alias("check_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
    )


def report(parts: Sequence[DataFrame]) -> DataFrame:
    """All check lines with a pass flag."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("success", F.col("failed") == 0)


class QualityError(ValueError):
    """Raised by the gate when a check failed."""


def gate(lines: DataFrame) -> None:
    """Raise when any check line failed; the driver sees one row per check."""
    failed = [f"{r['check_name']}: {r['failed']} of {r['checked']}" for r in lines.where(~F.col("success")).collect()]
    if failed:
        raise QualityError("; ".join(failed))


def suite(df: DataFrame, key: str, rules: Sequence[Rule], expected: Sequence[str] = ()) -> DataFrame:
    """The report of a table: expected columns, key rules and row rules."""
    absent = missing_columns(df, [key, *expected])
    if absent:
        raise QualityError(f"columns missing: {absent}")
    return report([broken_rows(df, [not_null(key), *rules]), duplicate_rows(df, [key])])


def declared_keys(tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Orphan counts for (child, child key, parent, parent key) declarations."""
    return report(
        [orphan_keys(tables[c], tables[p], ck, pk, f"{c}.{ck} in {p}") for c, ck, p, pk in references]
    )
