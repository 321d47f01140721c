"""Fitted sensor models on a stream: stored once, loaded where the stream is planned, named on every record."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions import traffic as R
from tallyfield.functions.dates import clock_parts
from tallyfield.operators.isolation import IsolationForest
from tallyfield.operators.learners import score_sensors
from tallyfield.sources import lake

NODES = "tree int, node int, feature int, split double, left int, right int, rest double"


@dataclass
class SensorModels:
    """A speed regression, a congestion classifier and an anomaly forest under one version."""

    regression: PipelineModel
    classifier: PipelineModel
    forest: IsolationForest
    version: str

    def save(self, spark: SparkSession, folder: str) -> None:
        lake.save_models({"regression": self.regression, "classifier": self.classifier}, folder)
        rows = [
            (t, n, *(float(tree[c][n]) if c in ("split", "rest") else int(tree[c][n]) for c in ("feature", "split", "left", "right", "rest")))
            for t, tree in enumerate(self.forest.trees)
            for n in range(len(tree["feature"]))
        ]
        spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{folder}/forest")
        facts = [(self.version, self.forest.columns, self.forest.sample, float(self.forest.offset))]
        spark.createDataFrame(facts, "version string, columns array<string>, sample int, offset double").coalesce(1).write.mode("overwrite").parquet(f"{folder}/facts")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> SensorModels:
        """Models as stored; the forest's nodes are at most trees * 511 rows."""
        facts = spark.read.parquet(f"{folder}/facts").first()
        nodes = spark.read.parquet(f"{folder}/forest").toPandas().sort_values(["tree", "node"])
        trees = [{c: own[c].to_numpy() for c in ("feature", "split", "left", "right", "rest")} for _, own in nodes.groupby("tree")]
        forest = IsolationForest(list(facts["columns"]), trees, facts["sample"], float(np.float64(facts["offset"])))
        return cls(lake.load_model(folder, "regression"), lake.load_model(folder, "classifier"), forest, facts["version"])


def with_features(readings: DataFrame, ts: str) -> DataFrame:
    """The ten features of a reading beside its columns, defaults where one is missing."""
    parts = {**clock_parts(ts)}
    absent = {c: F.lit(None).cast("double") for c in R.FEATURE_DEFAULTS if c not in readings.columns and c not in parts}
    ready = readings.withColumns({**parts, **absent})
    return ready.withColumns({f"feature_{c}": F.coalesce(F.col(c).cast("double"), F.lit(d)) for c, d in R.FEATURE_DEFAULTS.items()})


FEATURES = [f"feature_{c}" for c in R.FEATURE_DEFAULTS]
INPUTS = [c for c in FEATURES if c != "feature_average_speed"]


def scored(readings: DataFrame, ts: str, models: SensorModels) -> DataFrame:
    """Readings with predicted traffic, congestion probability, anomaly score and model version; for streams as well as tables."""
    ready = with_features(readings, ts)
    found = score_sensors(ready, models.regression, models.classifier).withColumn("anomaly_score", models.forest.decision())
    kept = ["predicted_traffic", "congestion_probability", "anomaly_score"]
    return found.select(*readings.columns, *kept, F.lit(models.version).alias("model_version"))
