"""Fitted preprocessors as folders of Parquet tables, and the classes that read stored models.

Numbers are stored in binary or as their shortest exact text, so features of a loaded preprocessor equal those of the
one that was saved. The note with its settings is written last.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import (
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparring.operators.encode import FittedPreprocessor, OneHot
from sparring.operators.forest import ForestModel
from sparring.operators.leak import FINDINGS
from sparring.session import local_frame, path_exists

#: The class that reads each kind of model; the network models are not stored.
READERS = {
    "linear_regression": LinearRegressionModel,
    "logistic_regression": LogisticRegressionModel,
    "random_forest": RandomForestClassificationModel,
    "random_forest_regressor": ForestModel,
    "mlp": MultilayerPerceptronClassificationModel,
}

COLUMNS = "kind string, place int, name string, mean double, std double, broadcast boolean, width int, null_seen boolean"


def _value_frame(spark: SparkSession, values: Sequence, texts: Sequence[str]) -> DataFrame:
    """(place, value, text), values in their own type."""
    kinds = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}
    kind = kinds[type(values[0])] if values else T.StringType()
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("value", kind), T.StructField("text", T.StringType())])
    return local_frame(spark, [(i, v, t) for i, (v, t) in enumerate(zip(values, texts))], schema)


def _column_rows(p: FittedPreprocessor) -> list[tuple]:
    rows = [("numeric", i, c, *p.stats[c], None, None, None) for i, c in enumerate(p.numeric)]
    rows += [("frequency", i, c, *p.stats[c], p.broadcast[c], None, None) for i, c in enumerate(p.frequency)]
    rows += [("array", i, c, None, None, None, w, None) for i, (c, w) in enumerate(zip(p.arrays, p.array_widths))]
    if p.onehot:
        rows += [("onehot", i, c, None, None, None, len(v), n) for i, (c, v, n) in enumerate(zip(p.onehot.columns, p.onehot.categories, p.onehot.null_seen))]
    return rows


def write_note(spark: SparkSession, content: dict, path: str) -> None:
    """A JSON object as a text file."""
    text = json.dumps(content, default=str)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)


def read_note(spark: SparkSession, path: str) -> dict:
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise ValueError(f"{path} is missing: its folder is not complete")
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def save_preprocessor(spark: SparkSession, p: FittedPreprocessor, path: str) -> None:
    def put(frame: DataFrame, name: str) -> None:
        frame.write.parquet(f"{path}/{name}")

    put(local_frame(spark, _column_rows(p), COLUMNS), "columns")
    put(local_frame(spark, [tuple(r) for r in p.report], FINDINGS), "leak_report")
    for i, name in enumerate(p.frequency):
        put(p.counts[name].select("hash", "n_rows"), f"counts/place={i}")
    if p.onehot:
        cells = [(i, j, v) for i, values in enumerate(p.onehot.categories) for j, v in enumerate(values)]
        put(local_frame(spark, cells, "place int, slot int, value string"), "categories")
    if p.vectors is not None:
        put(local_frame(spark, [(-1, p.singular_values.tolist()), *enumerate(p.vectors.tolist())], "slot int, loadings array<double>"), "vectors")
    if p.classes is not None:
        put(_value_frame(spark, p.classes, p.class_texts), "classes")
    note = {"target": p.target, "task": p.task, "missing": p.missing, "key_cols": list(p.key_cols), "n_train": p.n_train}
    write_note(spark, note, f"{path}/preprocessor")


def load_preprocessor(spark: SparkSession, path: str) -> FittedPreprocessor:
    """Counts stay tables; small tables are read here."""
    manifest = read_note(spark, f"{path}/preprocessor")

    def got(name: str, *order: str) -> list[Row]:
        return spark.read.parquet(f"{path}/{name}").orderBy(*order).collect()

    columns = got("columns", "kind", "place")
    of = {kind: [r for r in columns if r["kind"] == kind] for kind in ("numeric", "frequency", "array", "onehot")}
    counts = {r["name"]: spark.read.parquet(f"{path}/counts/place={r['place']}") for r in of["frequency"]}
    onehot = vectors = singular = None
    if of["onehot"]:
        values: list[list[str]] = [[] for _ in of["onehot"]]
        for r in got("categories", "place", "slot"):
            values[r["place"]].append(r["value"])
        onehot = OneHot([r["name"] for r in of["onehot"]], values, [r["null_seen"] for r in of["onehot"]])
        if path_exists(spark, f"{path}/vectors"):
            rows = got("vectors", "slot")
            singular, vectors = np.array(rows[0]["loadings"]), np.array([r["loadings"] for r in rows[1:]])
    classes = got("classes", "place") if path_exists(spark, f"{path}/classes") else None
    return FittedPreprocessor(
        target=manifest["target"],
        task=manifest["task"],
        report=got("leak_report", "col"),
        numeric=[r["name"] for r in of["numeric"]],
        frequency=[r["name"] for r in of["frequency"]],
        arrays=[r["name"] for r in of["array"]],
        array_widths=[r["width"] for r in of["array"]],
        counts=counts,
        broadcast={r["name"]: r["broadcast"] for r in of["frequency"]},
        n_train=manifest["n_train"],
        stats={r["name"]: (r["mean"], r["std"]) for kind in ("numeric", "frequency") for r in of[kind]},
        onehot=onehot,
        vectors=vectors,
        singular_values=singular,
        classes=classes and [r["value"] for r in classes],
        class_texts=classes and [r["text"] for r in classes],
        missing=manifest["missing"],
        key_cols=tuple(manifest["key_cols"]),
    )
