"""Comparing predictive models on a table with Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from sparring.operators.encode import Preprocessor, label_encode
from sparring.operators.ensemble import align_scores, mean_vote, one_hot_scores, soft_vote, vote_decision
from sparring.operators.leak import LeakThresholds, leak_report
from sparring.operators.metrics import compute_metrics
from sparring.operators.models import train
from sparring.operators.split import split
from sparring.operators.task import infer_task
from sparring.plans.experiment import prepare, run_experiment
from sparring.plans.pipeline_store import Pipeline, load_pipeline, save_pipeline
from sparring.sources.tables import preview, read_catalog_table, read_csv_table, read_parquet_table

# Functions sent to Python workers travel with their code, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "LeakThresholds",
    "Pipeline",
    "Preprocessor",
    "align_scores",
    "compute_metrics",
    "infer_task",
    "label_encode",
    "leak_report",
    "load_pipeline",
    "mean_vote",
    "one_hot_scores",
    "prepare",
    "preview",
    "read_catalog_table",
    "read_csv_table",
    "read_parquet_table",
    "run_experiment",
    "save_pipeline",
    "soft_vote",
    "split",
    "train",
    "vote_decision",
]
