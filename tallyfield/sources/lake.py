"""Date-partitioned parquet folders and file exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_partition(spark: SparkSession, base: str, day: str, column: str = "date") -> DataFrame:
    """Rows of one partition; only its folder is listed and read."""
    return spark.read.parquet(base).where(F.col(column) == F.lit(day).cast("date"))


def write_partition(df: DataFrame, base: str, column: str = "date") -> None:
    """Write the partitions present in ``df``, replacing those and no others.

    The rebalance hint gives each partition few files and splits a partition that holds a
    large part of the rows over several tasks.
    """
    (
        df.hint("rebalance", F.col(column))
        .write.partitionBy(column)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(base)
    )


def write_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(folder)


def export_bundle(results: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One named output folder per result, as sheets of a workbook would be."""
    paths = {}
    for name, df in results.items():
        paths[name] = f"{folder}/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(paths[name])
    return paths


def read_bundle(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def save_models(models: Mapping[str, Transformer], folder: str) -> None:
    """Fitted stages, scalers and encoders, one folder each."""
    for name, model in models.items():
        fitted = model if isinstance(model, PipelineModel) else PipelineModel([model])
        writer: MLWriter = fitted.write()
        writer.overwrite().save(f"{folder}/{name}")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{name}")


def with_lineage(df: DataFrame, run_day: str, batch: str) -> DataFrame:
    """Source file, run date and batch id on every row of a file scan."""
    return df.withColumns(
        {
            "source_file": F.col("_metadata.file_name"),
            "run_date": F.lit(run_day).cast("date"),
            "batch_id": F.lit(batch),
        }
    )
