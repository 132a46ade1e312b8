"""Document quality from line labels of a linear-chain conditional random field.

Each line of a text is good or bad. A line's features describe it and its neighbours; two transition weights tie
adjacent labels. The field is trained on a bounded sample of labelled documents, whose lines all carry the document's
label; executors sum the gradients, so the lines of the sample may be any number. A document's quality is the mean of its lines' forward-backward marginals weighted by length, mapped to a
probability by logistic regression on the same sample.

Null and empty texts have one empty line. Very long texts are read whole; nothing is shared between rows, so repeated
ids or rows get repeated results, and an empty table gives an empty one. Without labelled rows every score is 0.5.
Labels that are null don't count; of several labels of one id the largest counts. Columns of the input pass through;
one named like an output column is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import fold, labelled_ids, slices
from sparring.session import materialize, release

#: Labelled documents of each class that are learned from, at most; a parameter of `fit`.
SAMPLE_PER_CLASS = 1500
#: Parts in which the sample is kept, and lines of it that a task works on at once (a longer document is a run of its own).
SAMPLE_PARTS, BLOCK_LINES = 8, 16_384
OWN = 16
FEATURES = 3 * OWN + 4


def line_features(line: str, copies: int) -> list[float]:
    """What one line looks like; `copies` is how often it stands in its document."""
    n = len(line)
    words = line.split()
    m = max(1, len(words))
    letters, digits = sum(map(str.isalpha, line)), sum(map(str.isdigit, line))
    spaces = line.count(" ")
    common = sum(map(line.count, ".,;:!?'-"))
    symbols = max(0, n - letters - digits - spaces - common)
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    top = max(Counter(words).values()) if words else 0
    marked = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:!?")
    return [
        1.0,
        float(n == 0),
        np.log1p(n) / 5,
        letters / max(1, n),
        digits / max(1, n),
        min(1.0, 10 * symbols / max(1, n)),
        min(1.0, 10 * line.count("|") / max(1, n)),
        sum(map(str.isupper, line)) / max(1, letters),
        adjacent / m,
        len(set(words)) / m,
        top / m if len(words) >= 8 else 0.0,
        marked / m,
        min(2.0, letters / m / 8),
        float(line.endswith((".", "!", "?"))),
        float(line[:1].isupper()),
        min(1.0, (copies - 1) / 3),
    ]


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with those of its neighbours, and the weight of each line (its length, at least 1)."""
    lines = (text or "").split("\n")
    copies = Counter(lines)
    known: dict[str, list[float]] = {}
    for line in copies:
        known[line] = line_features(line, copies[line])
    own = np.array([known[x] for x in lines])
    pad = np.zeros((1, OWN))
    n = len(lines)
    place = np.zeros((n, 4))
    place[0, 0], place[-1, 1], place[:, 2], place[:, 3] = 1, 1, float(n == 1), np.log1p(n) / 5
    x = np.hstack([own, np.vstack([pad, own[:-1]]), np.vstack([own[1:], pad]), place])
    return x, np.array([max(1.0, len(line)) for line in lines])


def scanned(steps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place the product of the 2x2 matrices (logarithms, [places, 2, 2]) from the last end on, in log space.

    A prefix scan by doubling: each round joins a place's product with the one before it, until it reaches an end.
    """
    out, whole, reach = steps.copy(), ends.copy(), 1
    while not whole.all():
        at = np.flatnonzero(~whole)
        before = at - reach
        left, right = out[before], out[at]
        joined = np.logaddexp(left[:, :, :1] + right[:, :1, :], left[:, :, 1:] + right[:, 1:, :])
        done = whole[before]
        out[at], whole[at] = joined, done
        reach *= 2
    return out


def marginals(unary: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over chains that follow each other: P(good) of each line, expected pair counts, summed log Z.

    `unary` scores label good against bad for every line; `transition` [2, 2] scores adjacent labels (bad 0, good 1). Takes
    rounds with the logarithm of the longest chain, and memory with the lines.
    """
    n = len(unary)
    last = np.cumsum(lengths) - 1
    first = last - lengths + 1
    starts, ends = np.zeros(n, bool), np.zeros(n, bool)
    starts[first], ends[last] = True, True
    score = np.stack([np.zeros(n), unary], 1)
    steps = np.where(starts[:, None, None], 0.0, transition) + score[:, None, :]
    alpha = scanned(steps, starts)[:, 0, :]
    # From the end: the step from each line to the next, transposed so that products run the same way.
    back = np.zeros((n, 2, 2))
    back[:-1] = (transition + score[1:, None, :]).transpose(0, 2, 1)
    # The end of a chain passes on what it gets.
    back[last] = np.where(np.eye(2, dtype=bool), 0.0, -np.inf)
    products = scanned(back[::-1], ends[::-1])[::-1]
    beta = np.logaddexp(products[:, 0, :], products[:, 1, :])
    both = alpha + beta
    log_z = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - log_z)
    inner = np.flatnonzero(~starts)
    joint = alpha[inner - 1][:, :, None] + transition + (score[inner] + beta[inner])[:, None, :] - log_z[inner][:, None, None]
    return good, np.exp(joint).sum(0), float(log_z[last].sum())


def evaluated(x: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weights: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Gradient of the log-likelihood by weights and transition, the log-likelihood and the lines, of chains of one label each."""
    unary = x @ weights
    good, pairs, log_z = marginals(unary, lengths, transition)
    y = np.repeat(labels, lengths)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels, labels), lengths - 1)
    value = float((y * unary).sum() + (seen * transition).sum() - log_z)
    return np.concatenate([(y - good) @ x, (seen - pairs).ravel(), [value, len(unary)]])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(features, lengths, labels, line weights) of runs of sampled documents, of about BLOCK_LINES lines."""
    for batch in batches:
        held, size = [], 0
        for label, x, weight in zip(*(batch.column(k).to_pylist() for k in range(3))):
            held.append((label, np.frombuffer(x, np.float32).reshape(-1, FEATURES), np.frombuffer(weight, np.float32)))
            size += len(held[-1][1])
            if size >= BLOCK_LINES:
                yield together(held)
                held, size = [], 0
        if held:
            yield together(held)


def together(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    labels, xs, weights = zip(*held)
    return np.concatenate(xs).astype(float), np.array([len(x) for x in xs]), np.array(labels), np.concatenate(weights).astype(float)


def train_field(sample: DataFrame, rounds: int = 40, penalty: float = 1e-2, tolerance: float = 1e-6) -> dict:
    """Weights that maximise the penalised likelihood of the lines of `sample` (label, x, weight).

    Each step is one job: tasks sum the gradient over their own chains, the driver gets FEATURES + 6 numbers from
    each and makes a quasi-Newton step (L-BFGS), halved until the likelihood grows.
    """

    def objective(theta: np.ndarray) -> tuple[float, np.ndarray]:
        weights, transition = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(FEATURES + 6)
            for x, lengths, labels, _ in blocks(batches):
                total += evaluated(x, lengths, labels, weights, transition)
            yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

        total = np.sum([r["total"] for r in sample.mapInArrow(run, "total array<double>").collect()], 0)
        return -total[-2] / total[-1] + penalty / 20 * theta @ theta, -total[:-2] / total[-1] + penalty / 10 * theta

    theta = np.zeros(FEATURES + 4)
    value, gradient = objective(theta)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, factors = gradient.copy(), []
        for s, y in reversed(past):
            factors.append((s @ step) / (s @ y))
            step -= factors[-1] * y
        if past:
            s, y = past[-1]
            step *= (s @ y) / (y @ y)
        for (s, y), factor in zip(past, reversed(factors)):
            step += s * (factor - (y @ step) / (s @ y))
        size = 1.0 if past else min(1.0, 1.0 / np.abs(gradient).sum())
        while True:
            new = theta - size * step
            new_value, new_gradient = objective(new)
            if new_value <= value - 1e-4 * size * (gradient @ step) or size < 1e-6:
                break
            size /= 2
        moved, turned = new - theta, new_gradient - gradient
        if moved @ turned > 1e-12:
            past = [*past[-9:], (moved, turned)]
        gained, theta, value, gradient = value - new_value, new, new_value, new_gradient
        if gained <= tolerance * abs(value):
            break
    return {"weights": theta[:FEATURES], "transition": theta[FEATURES:].reshape(2, 2)}


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Slope and offset of a one-variable logistic regression, by Newton steps."""
    z, w = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty * np.eye(2)
        w += np.clip(np.linalg.solve(h, z.T @ (y - p) - penalty * w), -5, 5)
    return w


def document_values(x: np.ndarray, lengths: np.ndarray, weight: np.ndarray, model: dict) -> np.ndarray:
    """The length-weighted mean of each document's line marginals."""
    good = marginals(x @ model["weights"], lengths, model["transition"])[0]
    first = np.cumsum(lengths) - lengths
    return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = SAMPLE_PER_CLASS) -> dict | None:
    """The model, learned from at most `per_class` labelled documents of each class; None without both classes.

    The features of their lines, however many, are written to the staging folder and stay on the executors.
    """
    ids = labelled_ids(labels, "quality", learn, per_class)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("label", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            parts = [document_features(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), *(pa.array([p[k].astype(np.float32).tobytes() for p in parts], pa.binary()) for k in (0, 1))],
                ["label", "x", "weight"],
            )

    sample = chosen.mapInArrow(rows, "label int, x binary, weight binary")
    # In an order of their own, so that sums do not depend on files or cores.
    sample = materialize(sample.repartition(SAMPLE_PARTS).sortWithinPartitions(F.xxhash64("x"), "label"), "quality-sample")
    if sample.select("label").distinct().count() < 2:
        release(sample)
        return None
    model = train_field(sample)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, lengths, labels, weight in blocks(batches):
            yield pa.record_batch([pa.array(labels, pa.int32()), pa.array(document_values(x, lengths, weight, model))], ["label", "value"])

    # One number for each document of the sample.
    found = sample.mapInArrow(values, "label int, value double").orderBy("value", "label").collect()
    release(sample)
    return model | {"scale": logistic(np.array([r["value"] for r in found]), np.array([r["label"] for r in found]))}


def score_quality(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """`docs` with score, the probability of label 1 (good)."""
    base = docs.drop("score")
    at = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            score = np.full(batch.num_rows, 0.5)
            if model:
                xs, weights = zip(*map(document_features, batch.column(at).to_pylist()))
                values = document_values(np.concatenate(xs), np.array([len(x) for x in xs]), np.concatenate(weights), model)
                score = 1 / (1 + np.exp(-np.clip(values * model["scale"][0] + model["scale"][1], -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    return base.mapInArrow(run, base.select("*", F.lit(None).cast("double").alias("score")).schema)


def predict_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, cut: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; learned from labels outside the fold `held_out`."""
    inside = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    scored = score_quality(docs.select("doc_id", "text"), fit(docs, labels, ~inside))
    return scored.select("doc_id", inside.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
