"""Feature preparation: scaling, category codes, F-test selection, splits, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions.numbers import rounded
from tallyfield.operators.ordering import exact_rank

ONE_HOT_LIMIT = 10


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0.

    One aggregate serves all columns; its single row enters the plan as a scalar subquery.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).alias("m")
    ).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": F.when(F.col(c).isNotNull(), F.coalesce(
                F.try_divide(F.col(c) - moments.getField(f"m_{c}"), moments.getField(f"s_{c}")), F.lit(0.0)))
            for c in columns
        }
    )


def one_hot_or_index(df: DataFrame, column: str, limit: int = ONE_HOT_LIMIT) -> DataFrame:
    """Few categories become 0/1 columns without the first sorted one, many become codes.

    Only ``limit + 1`` distinct values are ever fetched. Codes are exact ranks of the
    distinct values; a missing value is the category "nan", as in the reference.
    """
    seen = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(seen) <= limit:
        categories = sorted(seen)
        out = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in categories[1:]}
        if categories and df.where(F.col(column).isNull()).limit(1).count():
            out[f"{column}_nan"] = F.col(column).isNull().cast("int")
        return df.withColumns(out).drop(column) if out else df.drop(column)
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit("nan")))
    codes = exact_rank(filled.select(column).distinct(), [column], rank="_rank", size="_size")
    coded = codes.select(F.col(column).alias("_value"), (F.col("_rank") - 1).cast("int").alias("_code"))
    return (
        filled.join(coded, F.col(column) == F.col("_value"), "left")
        .withColumn(column, F.col("_code"))
        .drop("_value", "_code")
    )


def anova_f(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """One-way F statistic of each feature against the class."""
    cells = [
        F.struct(F.lit(f).alias("feature"), F.count(f).alias("n"), F.avg(f).alias("mean"), F.var_pop(f).alias("var"))
        for f in features
    ]
    per_class = df.groupBy(label).agg(F.array(*cells).alias("cells"))
    rows = per_class.select(label, F.explode("cells").alias("c")).select(label, "c.*").where(F.col("n") > 0)
    same = Window.partitionBy("feature")  # as many rows as there are classes
    grand = F.sum(F.col("n") * F.col("mean")).over(same) / F.sum("n").over(same)
    sums = rows.withColumn("_gap", F.col("mean") - grand).groupBy("feature").agg(
        F.sum(F.col("n") * F.col("_gap") * F.col("_gap")).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("total"),
    )
    f_value = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("total") - F.col("k"))
    )
    return sums.select("feature", rounded(f_value, 4).alias("f_value"))


def select_k_best(df: DataFrame, label: str, features: Sequence[str], k: int = 50) -> list[str]:
    """Names of the k features with the largest F."""
    top = anova_f(df, label, features).orderBy(F.desc_nulls_last("f_value"), "feature").limit(k)
    return [r["feature"] for r in top.collect()]


def stratified_split(df: DataFrame, label: str, row_id: str, seed: int = 42, train_tenths: int = 8) -> DataFrame:
    """Add ``is_train``: the first round(0.8 n) rows of each class in a seeded hash order.

    Ranks come from range pieces over (class, hash), so a class with most of the rows is
    spread over many tasks.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string"))))
    ranked = exact_rank(hashed, ["_hash", row_id], [label], "_rank", "_size")
    cut = F.floor((F.col("_size") * train_tenths + 5) / 10)
    return ranked.withColumn("is_train", (F.col("_rank") <= cut).cast("int")).drop("_hash", "_rank", "_size")


def stratified_folds(df: DataFrame, label: str, row_id: str, folds: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add a fold number dealt in turn over each class in a seeded hash order.

    Folds of a class differ by one row at most.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string"))))
    ranked = exact_rank(hashed, ["_hash", row_id], [label], "_rank", "_size")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % folds).cast("int")).drop("_hash", "_rank", "_size")


def fold_of(row_id: str, folds: int, seed: int = 42) -> Column:
    """Fold number from a seeded hash; within a class the folds are equal up to chance."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(folds)).cast("int")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy()  # one row per class
    weight = F.sum("n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n"))
    return counts.select(label, "n", rounded(weight, 6).alias("weight"))
