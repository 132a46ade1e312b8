import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparring.functions import layers as L
from sparring.functions.keys import ROW_KEY
from sparring.operators import nets
from sparring.operators.encode import FEATURES, LABEL, Prepared
from sparring.operators.models import train
from sparring.operators.split import SPLIT

STACKS = {
    "dense": nets.dense_layers((5,), 3),
    "conv": nets.conv_layers([3, 2], 3, 2, 4, 3, 9),
    "even kernel": nets.conv_layers([2], 4, 3, 4, 3, 7),
    "lstm": nets.lstm_layers(3, 4, 3),
}


@pytest.mark.parametrize("loss", ["multi", "binary", "squared"])
@pytest.mark.parametrize("stack", STACKS)
def test_gradients_match_finite_differences(stack, loss):
    n_features = {"conv": 9, "even kernel": 7}.get(stack, 6)
    layers = STACKS[stack] if loss == "multi" else (*STACKS[stack][:-1], ("dense", 1))
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4, n_features))
    y = rng.integers(0, 3 if loss == "multi" else 2, 4).astype(float)
    params = [[p.astype(float) + rng.normal(size=p.shape) * 0.1 for p in own] for own in L.initial_params(layers, n_features, 1)]
    out, tapes = L.forward(layers, params, x)
    grads = L.backward(layers, params, tapes, L.loss_and_grad(loss, out, y)[1])

    def loss_at():
        return L.loss_and_grad(loss, L.forward(layers, params, x)[0], y)[0] / len(y)

    for own, own_grads in zip(params, grads):
        for p, g in zip(own, own_grads):
            for index in list(np.ndindex(p.shape))[:: max(1, p.size // 10)]:
                kept = p[index]
                p[index] = kept + 1e-5
                up = loss_at()
                p[index] = kept - 1e-5
                down = loss_at()
                p[index] = kept
                assert g[index] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_flatten_round_trip():
    params = L.initial_params(STACKS["conv"], 9, 1)
    again = L.unflatten(L.flatten(params), params)
    assert all(np.array_equal(a, b) for x, y in zip(params, again) for a, b in zip(x, y))


def planted(spark, n, task, classes=None):
    i = F.col("id")
    values = [((i * k + 13) % m) / m - 0.5 for k, m in ((7, 101), (11, 97), (5, 89), (3, 83))]
    signal = values[0] * 2 + values[2] - values[3]
    label = signal * 10 + 3 if task == "regression" else F.least(F.floor((signal + 2) / 4 * len(classes)), F.lit(len(classes) - 1))
    frame = spark.range(n).select(
        i.cast("string").alias(ROW_KEY), F.when(i % 5 == 0, "test").otherwise("train").alias(SPLIT),
        label.cast("double").alias("actual"), label.cast("double").alias(LABEL),
        array_to_vector(F.array(*values)).alias(FEATURES),
    )
    return Prepared(frame, "actual", task, classes, 4, n * 4 // 5)


@pytest.mark.parametrize("name", ["cnn", "lstm"])
def test_sequence_nets_learn_a_planted_signal(spark, name):
    prepared = planted(spark, 1500, "classification", [0, 1])
    model = train(name, prepared, {name: {"epochs": 12, "learning_rate": 0.01, "dense_units": 16}})
    scored = model.score(prepared.frame.where("split = 'test'"), "s")
    hits = scored.select(F.avg((model.decision(F.col("s")) == F.col("label")).cast("double"))).first()[0]
    assert hits > 0.8
    p = scored.select(F.min(F.col("s")[0] + F.col("s")[1]), F.max(F.col("s")[0] + F.col("s")[1])).first()
    assert p[0] == pytest.approx(1) and p[1] == pytest.approx(1)


@pytest.mark.parametrize("name, settings", [
    ("mlp_regressor", {"max_iter": 25, "learning_rate_init": 0.01}),
    ("cnn", {"epochs": 15, "learning_rate": 0.01}),
    ("lstm", {"epochs": 10, "learning_rate": 0.02, "lstm_units": 16}),
])
def test_regressors_beat_the_mean(spark, name, settings):
    prepared = planted(spark, 1500, "regression")
    model = train(name, prepared, {name: settings})
    scored = model.score(prepared.frame.where("split = 'test'"), "p")
    mse, var = scored.agg(F.avg(F.pow(F.col("p") - F.col("label"), 2)), F.var_pop("label")).first()
    assert mse < 0.3 * var


def test_averaging_over_many_partitions_is_repeatable(spark, monkeypatch):
    prepared = planted(spark, 4000, "regression")
    monkeypatch.setattr(nets, "partitions_for", lambda n: 9)
    settings = {"mlp_regressor": {"max_iter": 3, "hidden_layer_sizes": (8,)}}
    first = train("mlp_regressor", prepared, settings).model.weights
    assert np.allclose(first, train("mlp_regressor", prepared, settings).model.weights)
    shuffled = replace(prepared, frame=prepared.frame.repartition(5))
    assert np.allclose(first, train("mlp_regressor", shuffled, settings).model.weights)
    monkeypatch.setattr(nets, "AVERAGING_FAN_IN", 2)
    assert np.allclose(first, train("mlp_regressor", prepared, settings).model.weights)


def test_early_stopping_keeps_the_best_weights(spark):
    prepared = planted(spark, 600, "classification", [0, 1])
    noise = replace(prepared, frame=prepared.frame.withColumn(LABEL, F.pmod(F.xxhash64(ROW_KEY), F.lit(2)).cast("double")))
    model = train("cnn", noise, {"cnn": {"epochs": 60, "patience": 2, "learning_rate": 0.02}})
    assert model.extra["epochs_trained"] < 60
    assert model.extra["param_count"] == len(model.model.weights)


def test_too_few_features_for_the_pools(spark):
    with pytest.raises(ValueError, match="too few"):
        nets.conv_layers([32, 64], 3, 2, 64, 1, 3)


def test_partition_counts():
    assert nets.partitions_for(68) == 1
    assert nets.partitions_for(60_000) == 8
    assert nets.partitions_for(10**9) == math.ceil(10**9 / 100_000)


def test_outputs_of_an_empty_batch():
    layers = STACKS["conv"]
    params = L.initial_params(layers, 9, 1)
    parts = list(nets._chunked_forward(layers, params, np.zeros((0, 9), dtype=np.float32)))
    assert L.activate("multi", np.concatenate(parts)).shape == (0, 3)
