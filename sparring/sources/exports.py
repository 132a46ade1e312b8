"""Writing predictions, models and ensemble descriptions."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_predictions(wide: DataFrame, path: str) -> None:
    """Actual and predicted values as CSV with a header; a missing prediction is an empty field."""
    wide.write.option("header", True).option("nullValue", "").csv(path)


def saved_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, from their listing; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def save_ensemble(spark: SparkSession, description: Mapping, path: str) -> None:
    """An ensemble's description as one JSON object; values JSON lacks are written as text."""
    text = json.dumps(dict(description), default=str)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
