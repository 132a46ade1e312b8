"""Leaderboard, totals and the actual-versus-predicted table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.functions.columns import col
from sparring.operators.task import CLASSIFICATION, check_task

# Metric columns per task, in display order, and size units.
CLASSIFICATION_COLUMNS = ("accuracy", "f1", "recall", "precision", "roc_auc")
REGRESSION_COLUMNS = ("mse", "rmse", "mae", "r2")
SIZE_UNITS = ("KB", "MB", "GB", "TB", "PB")


def metric_columns(task: str) -> tuple[str, ...]:
    return CLASSIFICATION_COLUMNS if check_task(task) == CLASSIFICATION else REGRESSION_COLUMNS


def leaderboard(runs: DataFrame, metrics: DataFrame, task: str) -> DataFrame:
    """`place, model, <metrics>, train_time, model_size` in selection order."""
    return (
        runs.join(F.broadcast(metrics), "model", "left")
        .select("place", "model", *metric_columns(task), "train_time", "model_size")
        .orderBy("place")
    )


def totals(board: DataFrame) -> DataFrame:
    """One row with the summed train time and model size."""
    return board.agg(
        F.coalesce(F.sum("train_time"), F.lit(0.0)).alias("train_time"),
        F.coalesce(F.sum("model_size"), F.lit(0)).alias("model_size"),
    ).withColumn("size", human_size(F.col("model_size")))


def human_size(size: Column) -> Column:
    """Bytes as text: plain below 1024, then two decimals in the largest fitting unit; 0 is '-'."""
    text = F.format_string(f"%.2f {SIZE_UNITS[-1]}", size / F.lit(1024.0 ** len(SIZE_UNITS)))
    for power in range(len(SIZE_UNITS) - 1, 0, -1):
        shown = F.format_string(f"%.2f {SIZE_UNITS[power - 1]}", size / F.lit(1024.0**power))
        text = F.when(size < 1024.0 ** (power + 1), shown).otherwise(text)
    text = F.when(size < 1024, F.format_string("%.0f B", size.cast("double"))).otherwise(text)
    return F.when(size.isNull() | (size == 0), "-").otherwise(text)


def display(board: DataFrame, task: str) -> DataFrame:
    """The leaderboard as text: four decimals, three for seconds, '-' for what is missing."""
    return board.select(
        F.col("model").alias("Model"),
        *[F.when(F.col(m).isNull(), "-").otherwise(F.format_string("%.4f", F.col(m))).alias(m)
          for m in metric_columns(task)],
        F.format_string("%.3f", F.col("train_time")).alias("train_time(s)"),
        human_size(F.col("model_size")).alias("size"),
    )


def prediction_table(df: DataFrame, key: str, actual: str, predictions: Mapping[str, Column]) -> DataFrame:
    """`key, Actual` and one column per model; the outputs already share a row, so nothing is joined."""
    return df.select(col(key), col(actual).alias("Actual"), *[p.alias(m) for m, p in predictions.items()])
