"""Single models: one `train` for all of them, one `Fitted` to score and save with."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparring.operators.encode import FEATURES, LABEL, Prepared
from sparring.operators.forest import ForestModel, fit_forest
from sparring.operators.nets import NetModel, NetPlan, conv_layers, dense_layers, head_of, lstm_layers, train_net
from sparring.operators.split import SPLIT, TRAIN
from sparring.operators.task import CLASSIFICATION, REGRESSION, check_task
from sparring.sources.exports import saved_size

# Trees without a depth limit grow as deep as the library allows.
DEEPEST = 30

# Default hyper-parameters of every model. `seed` is shared by all of them.
DEFAULTS: dict[str, dict] = {
    "linear_regression": {"fit_intercept": True},
    "logistic_regression": {"max_iter": 1000},
    "random_forest": {"n_estimators": 100, "max_depth": None, "max_bins": 32},
    "random_forest_regressor": {"n_estimators": 100, "max_depth": None, "max_bins": 32},
    "mlp": {"hidden_layer_sizes": (100,), "max_iter": 200},
    "mlp_regressor": {
        "hidden_layer_sizes": (100,), "max_iter": 200, "learning_rate_init": 0.001, "batch_size": 200,
        "alpha": 0.0001, "tol": 0.0001, "patience": 10, "scale_target": True,
    },
    "cnn": {
        "conv_filters": [32, 64], "kernel_size": 3, "pool_size": 2, "dense_units": 64, "learning_rate": 0.001,
        "epochs": 200, "batch_size": 32, "patience": 10, "validate_on_test": False, "scale_target": True,
    },
    "lstm": {
        "lstm_units": 64, "dense_units": 64, "learning_rate": 0.001,
        "epochs": 200, "batch_size": 32, "patience": 10, "validate_on_test": False, "scale_target": True,
    },
}

# Tasks each model supports.
TASKS_OF = {
    "linear_regression": (REGRESSION,),
    "logistic_regression": (CLASSIFICATION,),
    "random_forest": (CLASSIFICATION,),
    "random_forest_regressor": (REGRESSION,),
    "mlp": (CLASSIFICATION,),
    "mlp_regressor": (REGRESSION,),
    "cnn": (CLASSIFICATION, REGRESSION),
    "lstm": (CLASSIFICATION, REGRESSION),
}


def model_config(name: str, config: Mapping | None) -> dict:
    """Defaults, then known global settings, then the model's own section of the config."""
    known = {**DEFAULTS[name], "seed": 42}
    config = dict(config or {})
    shared = {k: v for k, v in config.items() if k in known and not isinstance(v, Mapping)}
    own = dict(config.get(name, {}))
    unknown = set(own) - set(known)
    if unknown:
        raise ValueError(f"unknown settings for {name}: {sorted(unknown)}; known: {sorted(known)}")
    return {**known, **shared, **own}


@dataclass
class Fitted:
    """A trained model with its class list, fit time and settings."""

    name: str
    task: str
    classes: list | None
    model: object
    train_time: float
    extra: dict = field(default_factory=dict)

    def score(self, df: DataFrame, output: str) -> DataFrame:
        """Add `output`: array<double> of probabilities in class order, or a predicted number."""
        if isinstance(self.model, NetModel):
            return df.withColumn(output, self.model.output(FEATURES))
        if isinstance(self.model, ForestModel):
            return self.model.transform(df, FEATURES, output)
        if self.task == REGRESSION:
            return self.model.copy({self.model.predictionCol: output}).transform(df)
        quiet = {self.model.predictionCol: "", self.model.rawPredictionCol: "", self.model.probabilityCol: "__p"}
        return self.model.copy(quiet).transform(df).withColumn(output, vector_to_array("__p")).drop("__p")

    def decision(self, scores: Column) -> Column:
        """Predicted class index from probabilities: two-class nets take the second class from 0.5 on."""
        if isinstance(self.model, NetModel) and self.model.plan.loss == "binary":
            return two_class_decision(scores)
        return best_class(scores)

    def save(self, df: DataFrame, path: str) -> int:
        """Write the model and return its size in bytes."""
        self.write(df.sparkSession, path)
        return saved_size(df.sparkSession, path)

    def write(self, spark: SparkSession, path: str) -> None:
        """Write the model below `path`."""
        if isinstance(self.model, NetModel | ForestModel):
            self.model.save(spark, path)
        else:
            self.model.write().overwrite().save(path)


def two_class_decision(scores: Column) -> Column:
    """1 if the second class has a probability of 0.5 or more, else 0."""
    return F.when(scores[1] >= 0.5, 1).otherwise(0)


def best_class(scores: Column) -> Column:
    """Position of the highest probability; ties go to the first class."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def train(name: str, prepared: Prepared, config: Mapping | None = None) -> Fitted:
    """Fit one model on the training rows of a prepared table."""
    if name not in DEFAULTS:
        raise ValueError(f"unknown model {name!r}; known: {sorted(DEFAULTS)}")
    if check_task(prepared.task) not in TASKS_OF[name]:
        raise ValueError(f"{name} does not support {prepared.task}")
    c = model_config(name, config)
    rows = prepared.frame.where(F.col(SPLIT) == TRAIN).select(LABEL, FEATURES)
    started = time.perf_counter()
    model = _FITTERS[name](prepared, rows, c)
    seconds = time.perf_counter() - started
    extra = dict(c)
    if isinstance(model, NetModel):
        extra.update(epochs_trained=model.epochs_trained, param_count=model.param_count)
    return Fitted(name, prepared.task, prepared.classes, model, seconds, extra)


def _linear(prepared: Prepared, rows: DataFrame, c: dict):
    # One pass of normal equations up to 4096 features, L-BFGS beyond; no regularisation.
    return LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, regParam=0.0, solver="auto", fitIntercept=c["fit_intercept"]
    ).fit(rows)


def _logistic(prepared: Prepared, rows: DataFrame, c: dict):
    # A unit L2 penalty on the summed loss is a penalty of 1/n on Spark's mean loss.
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=c["max_iter"], elasticNetParam=0.0,
        regParam=1.0 / prepared.n_train, standardization=False, tol=1e-4,
    ).fit(rows)


def _forest(prepared: Prepared, rows: DataFrame, c: dict):
    depth = DEEPEST if c["max_depth"] is None else c["max_depth"]
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=c["n_estimators"], maxDepth=depth,
        maxBins=c["max_bins"], featureSubsetStrategy="sqrt", seed=c["seed"], maxMemoryInMB=1024,
    ).fit(rows)


def _forest_regressor(prepared: Prepared, rows: DataFrame, c: dict) -> ForestModel:
    # All features at each node: the trees of Spark's own regressor, which takes too long without a depth limit.
    depth = DEEPEST if c["max_depth"] is None else c["max_depth"]
    return fit_forest(rows, LABEL, FEATURES, prepared.n_features, c["n_estimators"], depth, c["max_bins"], c["seed"])


def _perceptron(prepared: Prepared, rows: DataFrame, c: dict):
    widths = [prepared.n_features, *c["hidden_layer_sizes"], len(prepared.classes)]
    return MultilayerPerceptronClassifier(
        featuresCol=FEATURES, labelCol=LABEL, layers=widths, maxIter=c["max_iter"], seed=c["seed"]
    ).fit(rows)


def _perceptron_regressor(prepared: Prepared, rows: DataFrame, c: dict) -> NetModel:
    plan = NetPlan(
        layers=dense_layers(tuple(c["hidden_layer_sizes"]), 1), loss="squared", epochs=c["max_iter"],
        batch_size=c["batch_size"], learning_rate=c["learning_rate_init"], patience=c["patience"],
        seed=c["seed"], decay=c["alpha"], tolerance=c["tol"], holdout=0.0, scale_target=c["scale_target"],
    )
    return train_net(prepared, plan)


def _sequence_net(make_layers):
    def fit(prepared: Prepared, rows: DataFrame, c: dict) -> NetModel:
        units, loss = head_of(prepared.task, prepared.classes)
        plan = NetPlan(
            layers=make_layers(c, units, prepared.n_features), loss=loss, epochs=c["epochs"],
            batch_size=c["batch_size"], learning_rate=c["learning_rate"], patience=c["patience"], seed=c["seed"],
            validate_on_test=c["validate_on_test"], scale_target=c["scale_target"],
        )
        return train_net(prepared, plan)

    return fit


def _cnn_layers(c: dict, units: int, n_features: int) -> tuple:
    return conv_layers(c["conv_filters"], c["kernel_size"], c["pool_size"], c["dense_units"], units, n_features)


def _lstm_layers(c: dict, units: int, n_features: int) -> tuple:
    return lstm_layers(c["lstm_units"], c["dense_units"], units)


_FITTERS = {
    "linear_regression": _linear,
    "logistic_regression": _logistic,
    "random_forest": _forest,
    "random_forest_regressor": _forest_regressor,
    "mlp": _perceptron,
    "mlp_regressor": _perceptron_regressor,
    "cnn": _sequence_net(_cnn_layers),
    "lstm": _sequence_net(_lstm_layers),
}
