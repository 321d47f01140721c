"""Session settings, table loading and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(app: str = "tallyfield", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def load(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One parquet table of the data folder."""
    return spark.read.parquet(f"{base}/{table}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; a cluster without the
    setting is an error, because another machine could not read what was written.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="tallyfield-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back from there.

    Used where a result is read several times, or where row placement must not change
    between two reads. The copy survives the loss of executors.
    """
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it from there.

    As ``durable``, but by columns: readers prune them, and joins see the size of the table.
    """
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
