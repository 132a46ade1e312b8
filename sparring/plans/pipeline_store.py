"""Fitted pipelines as folders: everything that scoring needs, to be loaded again by another session.

A folder holds the models in their own format, the preprocessor as tables and a manifest, which is written last: a
folder without one is not complete and cannot be loaded. Scores of a loaded pipeline equal those of the one that was saved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparring.functions.keys import ROW_KEY
from sparring.operators.encode import FittedPreprocessor
from sparring.operators.models import Fitted
from sparring.plans.experiment import combined_outputs, score_models
from sparring.plans.model_store import READERS, load_preprocessor, read_note, save_preprocessor, write_note
from sparring.plans.registry import models_for
from sparring.session import path_exists

FORMAT_VERSION = 1
MANIFEST = "manifest"


@dataclass
class Pipeline:
    """A fitted preprocessor and the models that take its features."""

    preprocessor: FittedPreprocessor
    fitted: dict[str, Fitted]

    @property
    def task(self) -> str:
        return self.preprocessor.task

    def features(self, df: DataFrame) -> DataFrame:
        """`row_key, features` of rows without target and split."""
        return self.preprocessor.transform_new(df)

    def scores(self, df: DataFrame) -> DataFrame:
        """`row_key` and the output of each model as `s_<name>`: class probabilities or a number."""
        return score_models(self.features(df), self.fitted).select(ROW_KEY, *[f"s_{name}" for name in self.fitted])

    def predict(self, df: DataFrame, selection: Sequence[str], weights: Sequence[float] | None = None) -> DataFrame:
        """`row_key` and the prediction of each selectable name, single model or ensemble."""
        registry = models_for(self.task)
        lacking = [m for m in selection if m not in registry or not set(registry[m]) <= set(self.fitted)]
        if lacking:
            raise ValueError(f"{lacking} need models that this pipeline lacks; it has {sorted(self.fitted)}")
        outputs = [combined_outputs(m, registry[m], self.fitted, self.task, self.preprocessor.classes, weights)[0] for m in selection]
        return self.scores(df).select(ROW_KEY, *[o.alias(m) for o, m in zip(outputs, selection)])


def save_pipeline(spark: SparkSession, pipeline: Pipeline, path: str, settings: Mapping | None = None) -> None:
    """Write a pipeline below `path`, which must not exist. `settings` are kept in the manifest as they are."""
    path = path.rstrip("/")
    unknown = sorted(set(pipeline.fitted) - set(READERS))
    if unknown:
        raise ValueError(f"{unknown} cannot be stored; only {sorted(READERS)} can")
    if path_exists(spark, path):
        raise ValueError(f"{path} exists; a pipeline is written to a new folder")
    save_preprocessor(spark, pipeline.preprocessor, f"{path}/preprocessor")
    for name, model in pipeline.fitted.items():
        model.write(spark, f"{path}/models/{name}")
    manifest = {
        "format_version": FORMAT_VERSION,
        "models": {n: {"train_time": m.train_time, "extra": m.extra} for n, m in pipeline.fitted.items()},
        "settings": dict(settings or {}),
    }
    write_note(spark, manifest, f"{path}/{MANIFEST}")


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a stored pipeline; an error if the folder is incomplete or of another format."""
    manifest = read_note(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if manifest["format_version"] != FORMAT_VERSION:
        raise ValueError(f"{path} has format {manifest['format_version']}; this library reads {FORMAT_VERSION}")
    return manifest


def load_pipeline(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> Pipeline:
    """A stored pipeline, with all of its models or the named ones."""
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    preprocessor = load_preprocessor(spark, f"{path}/preprocessor")
    wanted = list(manifest["models"]) if models is None else list(models)
    lacking = sorted(set(wanted) - set(manifest["models"]))
    if lacking:
        raise ValueError(f"{lacking} are not in {path}; it has {sorted(manifest['models'])}")
    fitted = {
        name: Fitted(
            name, preprocessor.task, preprocessor.classes, READERS[name].load(f"{path}/models/{name}"),
            manifest["models"][name]["train_time"], manifest["models"][name]["extra"],
        )
        for name in wanted
    }
    return Pipeline(preprocessor, fitted)
