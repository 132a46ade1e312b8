"""Neural networks trained by Spark jobs: local mini-batch passes and averaged weights.

Local SGD with parameter averaging (Zinkevich et al. 2010, McMahan et al. 2017). One job per
epoch: every partition starts from the same weights, streams its Arrow batches once, and
returns its weights, row count and losses; the weighted mean of the weights is an aggregation
on the executors, so the driver receives one weight vector whatever the number of partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.functions import layers as L
from sparring.functions.keys import ROW_KEY, seeded_hash
from sparring.operators.encode import FEATURES, LABEL, Prepared
from sparring.operators.split import SPLIT, TRAIN
from sparring.operators.task import CLASSIFICATION
from sparring.session import local_frame

ROWS_PER_INFERENCE = 512
AVERAGING_FAN_IN = 64


@dataclass(frozen=True)
class NetPlan:
    """What to train: hidden layers, head, loss and the stopping rule."""

    layers: tuple
    loss: str
    epochs: int
    batch_size: int
    learning_rate: float
    patience: int
    seed: int = 42
    decay: float = 0.0
    tolerance: float = 0.0
    holdout: float = 0.1
    validate_on_test: bool = False
    scale_target: bool = True


def head_of(task: str, classes: list | None) -> tuple[int, str]:
    """Output units and loss: one sigmoid for two classes, softmax for more, linear for regression."""
    if task != CLASSIFICATION:
        return 1, "squared"
    return (1, "binary") if len(classes) <= 2 else (len(classes), "multi")


def dense_layers(hidden: tuple[int, ...], units: int) -> tuple:
    body = [step for width in hidden for step in (("dense", width), ("relu",))]
    return (*body, ("dense", units))


def conv_layers(filters: list[int], kernel: int, pool: int, dense: int, units: int, n_features: int) -> tuple:
    if n_features < pool ** len(filters):
        raise ValueError(
            f"{n_features} features are too few for {len(filters)} poolings of {pool}; "
            f"at least {pool ** len(filters)} are needed"
        )
    body = [step for f in filters for step in (("conv", f, kernel), ("relu",), ("pool", pool))]
    return (("sequence",), *body, ("flatten",), ("dense", dense), ("relu",), ("dense", units))


def lstm_layers(lstm: int, dense: int, units: int) -> tuple:
    return (("sequence",), ("lstm", lstm), ("dense", dense), ("relu",), ("dense", units))


def partitions_for(n_rows: int) -> int:
    """Local passes need enough rows to be worth averaging; large inputs get more partitions."""
    return max(1, min(n_rows // 2_000, max(8, math.ceil(n_rows / 100_000))))


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), width).astype(np.float32, copy=False)


def _chunked_forward(layers, params, x: np.ndarray) -> Iterator[np.ndarray]:
    if not len(x):
        yield np.zeros((0, layers[-1][1]), dtype=np.float32)
    for start in range(0, len(x), ROWS_PER_INFERENCE):
        yield L.forward(layers, params, x[start : start + ROWS_PER_INFERENCE])[0]


def _local_pass(plan: NetPlan, weights: np.ndarray, n_features: int, epoch: int, learn: bool):
    """The function one task runs over its partition's Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like = L.initial_params(plan.layers, n_features, plan.seed)
        start, params = L.unflatten(weights, like), L.unflatten(weights, like)
        optimizer = L.Adam(params, plan.learning_rate)
        rng = np.random.default_rng([plan.seed, epoch])
        seen = held = 0
        loss_seen = loss_held = 0.0
        for batch in batches:
            x, y = _matrix(batch.column("x"), n_features), batch.column("y").to_numpy()
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            if held_out.any():
                out = np.concatenate(list(_chunked_forward(plan.layers, start, x[held_out])))
                loss_held += L.loss_and_grad(plan.loss, out, y[held_out])[0]
                held += int(held_out.sum())
            mine = np.flatnonzero(~held_out)
            seen += len(mine)
            if not learn:
                continue
            order = rng.permutation(mine)
            for at in range(0, len(order), plan.batch_size):
                pick = order[at : at + plan.batch_size]
                out, tapes = L.forward(plan.layers, params, x[pick])
                loss, grad = L.loss_and_grad(plan.loss, out, y[pick])
                loss_seen += loss
                grads = L.backward(plan.layers, params, tapes, grad.astype(np.float32))
                optimizer.update(params, grads, plan.decay / len(pick))
        if seen or held:
            result = {
                "seen": [float(seen)], "loss_seen": [loss_seen], "held": [float(held)], "loss_held": [loss_held],
                "weights": [L.flatten(params)],
            }
            yield pa.RecordBatch.from_pydict(result, schema=_RESULT_ARROW)

    return run


_RESULT = "seen double, loss_seen double, held double, loss_held double, weights array<double>"
_RESULT_ARROW = pa.schema(
    [("seen", pa.float64()), ("loss_seen", pa.float64()), ("held", pa.float64()), ("loss_held", pa.float64()),
     ("weights", pa.list_(pa.float64()))]
)


def _average(local: DataFrame, n_partitions: int):
    """Row-weighted mean of the weights and summed losses, in two levels when there are many partitions."""
    sums = [F.sum(c).alias(c) for c in ("seen", "loss_seen", "held", "loss_held")]
    vectors = local.select("seen", "loss_seen", "held", "loss_held", array_to_vector("weights").alias("weights"))
    mean = Summarizer.mean(F.col("weights"), F.col("seen")).alias("weights")
    if n_partitions > AVERAGING_FAN_IN:
        group = F.pmod(F.spark_partition_id(), F.lit(math.isqrt(n_partitions)))
        vectors = vectors.groupBy(group).agg(mean, *sums)
    return vectors.agg(mean, *sums).first()


@dataclass
class NetModel:
    """Trained weights; scores rows with an Arrow function that carries them to the tasks."""

    plan: NetPlan
    n_features: int
    weights: np.ndarray
    epochs_trained: int
    target_mean: float = 0.0
    target_std: float = 1.0

    @property
    def param_count(self) -> int:
        return len(self.weights)

    def output(self, features: str = FEATURES) -> Column:
        """array<double> of class probabilities, or the predicted number for regression."""
        plan, n_features, weights = self.plan, self.n_features, self.weights
        mean, std = self.target_mean, self.target_std

        def predict(x: pa.Array) -> np.ndarray:
            params = L.unflatten(weights, L.initial_params(plan.layers, n_features, plan.seed))
            parts = [L.activate(plan.loss, out) for out in _chunked_forward(plan.layers, params, _matrix(x, n_features))]
            return np.concatenate(parts).astype(np.float64)

        if plan.loss == "squared":

            @F.arrow_udf("double")
            def numbers(x: pa.Array) -> pa.Array:
                return pa.array(predict(x) * std + mean)

            return numbers(vector_to_array(features, "float32"))

        @F.arrow_udf("array<double>")
        def probabilities(x: pa.Array) -> pa.Array:
            p = predict(x)
            offsets = np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()))

        return probabilities(vector_to_array(features, "float32"))

    def save(self, spark, path: str) -> None:
        """One Parquet row per layer: its position, description and parameters."""
        params = L.unflatten(self.weights, L.initial_params(self.plan.layers, self.n_features, self.plan.seed))
        rows = [
            (i, str(layer), L.flatten([own]).tolist() if own else [])
            for i, (layer, own) in enumerate(zip(self.plan.layers, params))
        ]
        local_frame(spark, rows, "position int, layer string, weights array<double>").coalesce(1).write.parquet(path)


def train_net(prepared: Prepared, plan: NetPlan) -> NetModel:
    """Run epochs until the plan's stopping rule fires.

    With held-out rows the rule is: stop after `patience` epochs without a lower held-out loss
    and keep the best weights. Without them: stop when the training loss has not fallen by
    `tolerance` for `patience` epochs and keep the last weights. The held-out loss of an
    epoch's weights is measured by the next epoch's job, in the same scan.
    """
    if plan.epochs < 1:
        raise ValueError("at least one epoch is needed")
    frame = prepared.frame
    if plan.validate_on_test:
        held_out = F.col(SPLIT) != TRAIN
    else:
        frame = frame.where(F.col(SPLIT) == TRAIN)
        part = F.conv(F.substring(seeded_hash(F.col(ROW_KEY), f"holdout|{plan.seed}"), 1, 8), 16, 10)
        held_out = part.cast("double") < plan.holdout * 2**32
    mean, std = 0.0, 1.0
    if plan.loss == "squared" and plan.scale_target:
        mean, std = frame.where(F.col(SPLIT) == TRAIN).agg(F.avg(LABEL), F.stddev_pop(LABEL)).first()
        std = std or 1.0
    n_partitions = partitions_for(prepared.n_train)
    rows = (
        frame.select(
            F.col(ROW_KEY),
            vector_to_array(FEATURES, "float32").alias("x"),
            ((F.col(LABEL) - mean) / std).alias("y"),
            held_out.alias("held_out"),
        )
        .repartition(n_partitions, ROW_KEY)
        .sortWithinPartitions(ROW_KEY)
        .select("x", "y", "held_out")
        .persist()
    )

    def run(weights: np.ndarray, epoch: int, learn: bool = True):
        local = rows.mapInArrow(_local_pass(plan, weights, prepared.n_features, epoch, learn), _RESULT)
        return _average(local, n_partitions)

    weights = L.flatten(L.initial_params(plan.layers, prepared.n_features, plan.seed))
    best, best_loss, waited, epoch = weights, math.inf, 0, 0
    try:
        for epoch in range(1, plan.epochs + 1):
            result = run(weights, epoch)
            watched_held_out = bool(result["held"])
            loss = result["loss_held"] / result["held"] if watched_held_out else result["loss_seen"] / result["seen"]
            # The held-out loss is that of the weights the epoch started from, untrained ones in the first.
            if epoch > 1 or not watched_held_out:
                if loss < best_loss - plan.tolerance:
                    best, waited = weights, 0
                else:
                    waited += 1
                best_loss = min(best_loss, loss)
            if waited >= plan.patience:
                epoch -= int(watched_held_out)
                break
            weights = result["weights"].toArray()
        else:
            if watched_held_out:
                last = run(weights, plan.epochs + 1, learn=False)
                if last["loss_held"] / last["held"] < best_loss:
                    best = weights
    finally:
        rows.unpersist()
    return NetModel(plan, prepared.n_features, best if watched_held_out else weights, epoch, mean, std)
