"""Layered tables: create, replace, append, bulk copy and views."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.sources.manifest import Manifest

LAYERS = ("raw", "staging", "analytics", "mart")


class Warehouse:
    """Four databases of parquet tables under one folder."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.prefix = spark, prefix
        self.manifest = Manifest(spark, f"{root}/load_manifest")
        for layer in LAYERS:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{root}/{layer}'")

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def read(self, sql: str) -> DataFrame:
        """SQL text to frame; ``{layer}.table`` marks name the layers."""
        return self.spark.sql(sql.format(**{layer: f"`{self.prefix}{layer}`" for layer in LAYERS}))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create(self, layer: str, table: str, schema: T.StructType) -> None:
        """An empty table with declared columns."""
        self.spark.createDataFrame([], schema).write.mode("ignore").saveAsTable(self.name(layer, table))

    def replace(self, layer: str, table: str, df: DataFrame) -> None:
        """Create or replace a table from a query; loads entered before no longer count."""
        df.write.mode("overwrite").saveAsTable(self.name(layer, table))
        if self.manifest.states(self.name(layer, table)):
            self.manifest.reset(self.name(layer, table))

    def _files(self, target: str) -> int:
        """How many files a table has, from its listing."""
        if not self.spark.catalog.tableExists(target):
            return 0
        self.spark.catalog.refreshTable(target)
        return len(self.spark.table(target).inputFiles())

    def insert_select(self, layer: str, table: str, df: DataFrame, run: str | None = None) -> bool:
        """Append a query result, matching columns by name; False if ``run`` is in the table already.

        ``run`` names the load, such as its date: a rerun adds nothing. Without it the rows are always added.
        """
        target = self.name(layer, table)
        rows = df.select(*self.spark.table(target).columns)
        if run is None:
            rows.write.insertInto(target)
            return True
        return bool(self.manifest.once(target, [run], lambda: self._files(target), lambda _: rows.write.insertInto(target)))

    def copy_into(self, layer: str, table: str, folder: str) -> list[str]:
        """Append the files of a folder that the table has not had yet, and return them.

        Each row keeps the name of its file. What the table has had stands in the manifest, so neither the table nor
        files loaded before are read. A table from before there was a manifest is read once.
        """
        target = self.name(layer, table)
        exists = self.spark.catalog.tableExists(target)
        if exists and "source_file" in self.spark.table(target).columns and not self.manifest.states(target):
            held = [r[0] for r in self.spark.table(target).select("source_file").distinct().collect()]
            if held:
                # rows name local files with one slash, listings with three
                self.manifest.adopt(target, [re.sub("^file:/+", "file:///", f) for f in held], self._files(target))

        def load(files: Sequence[str]) -> None:
            incoming = self.spark.read.parquet(*files).withColumn("source_file", F.col("_metadata.file_path"))
            if exists:
                incoming = incoming.select(*self.spark.table(target).columns)
            incoming.write.mode("append").saveAsTable(target)

        return self.manifest.once(target, self.spark.read.parquet(folder).inputFiles(), lambda: self._files(target), load)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return self.spark.table(name)
