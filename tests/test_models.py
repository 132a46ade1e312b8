import numpy as np
import pytest
from pyspark.sql import functions as F
from test_nets import planted

from sparring.operators.models import model_config, train


@pytest.mark.parametrize("name, settings", [
    ("logistic_regression", {}), ("random_forest", {"n_estimators": 10, "max_depth": 6}), ("mlp", {"max_iter": 60}),
])
def test_classifiers_learn_a_planted_signal(spark, name, settings):
    prepared = planted(spark, 1500, "classification", [0, 1, 2])
    model = train(name, prepared, {name: settings})
    scored = model.score(prepared.frame.where("split = 'test'"), "s")
    hit, total = scored.select(
        F.avg((model.decision(F.col("s")) == F.col("label")).cast("double")),
        F.max(F.abs(F.aggregate("s", F.lit(0.0), lambda a, b: a + b) - 1)),
    ).first()
    base = prepared.frame.groupBy("label").count().agg(F.max("count")).first()[0] / 1500
    assert hit > base + 0.1
    assert total < 1e-9


def test_linear_regression_is_least_squares(spark):
    prepared = planted(spark, 800, "regression")
    model = train("linear_regression", prepared)
    assert model.model.intercept == pytest.approx(3)
    assert np.allclose(model.model.coefficients.toArray(), [20, 0, 10, -10], atol=1e-6)


def test_forest_regressor_beats_the_mean(spark):
    prepared = planted(spark, 1500, "regression")
    model = train("random_forest_regressor", prepared, {"random_forest_regressor": {"n_estimators": 10, "max_depth": 8}})
    scored = model.score(prepared.frame.where("split = 'test'"), "p")
    mse, var = scored.agg(F.avg(F.pow(F.col("p") - F.col("label"), 2)), F.var_pop("label")).first()
    assert mse < 0.3 * var


def test_penalty_equals_unit_c(spark):
    # With the penalty written on the summed loss, the gradient at the solution is minus the weights.
    prepared = planted(spark, 300, "classification", [0, 1])
    model = train("logistic_regression", prepared).model
    rows = prepared.frame.where("split = 'train'").select("label", "features").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows])
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.allclose(x.T @ (p - y) + w, 0, atol=0.1)


def test_config_layers_and_refusals(spark):
    config = {"seed": 1, "max_iter": 7, "mlp": {"max_iter": 9}}
    assert model_config("mlp", config)["max_iter"] == 9
    assert model_config("logistic_regression", config)["max_iter"] == 7
    assert model_config("cnn", config)["seed"] == 1
    with pytest.raises(ValueError, match="unknown settings"):
        model_config("mlp", {"mlp": {"learning_rate_init": 1}})
    with pytest.raises(ValueError, match="unknown model"):
        train("perceptron", None)
    with pytest.raises(ValueError, match="does not support"):
        train("linear_regression", planted(spark, 10, "classification", [0, 1]))
