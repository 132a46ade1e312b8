"""Deciding between classification and regression from the target column."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparring.functions.columns import col, numeric_columns, per_column, require_column

CLASSIFICATION = "classification"
REGRESSION = "regression"
TASKS = (CLASSIFICATION, REGRESSION)

# A numeric target with more distinct values than this is a regression target (fixed value).
MAX_NUMERIC_CLASSES = 15

# Sketch estimates above this are far beyond the limit, so no exact count is needed.
CLEARLY_MANY = 20 * MAX_NUMERIC_CLASSES


# The hash counts NULL as a value, which does not matter far from the limit.
SKETCH = "hll_sketch_estimate(hll_sketch_agg(xxhash64({c}), 10))"


def check_task(task: str) -> str:
    if task not in TASKS:
        raise ValueError(f"unknown task type {task!r}; expected one of {TASKS}")
    return task


def infer_tasks(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Task per column, with one sketch pass and an exact count only where the sketch is small.

    An exact distinct count shuffles every distinct value; the sketch shuffles a few
    kilobytes, and the columns it leaves over have a set of few values per task.
    """
    columns = df.columns if columns is None else columns
    numeric = [c for c in numeric_columns(df) if c in columns]
    tasks = {c: CLASSIFICATION for c in columns}
    if not numeric:
        return tasks
    estimates = per_column(df, numeric, {"n": SKETCH}).collect()
    unsure = [r["col"] for r in estimates if r["n"] <= CLEARLY_MANY]
    tasks.update({c: REGRESSION for c in numeric if c not in unsure})
    if unsure:
        exact = per_column(df, unsure, {"n": "size(collect_set({c}))"}).collect()
        tasks.update({r["col"]: REGRESSION for r in exact if r["n"] > MAX_NUMERIC_CLASSES})
    return tasks


def infer_task(df: DataFrame, target: str) -> str:
    require_column(df, target)
    return infer_tasks(df.select(col(target)), [target])[target]
