"""Combining model outputs. Every output is a column of the same row, so nothing is joined or shuffled."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.functions.columns import col
from sparring.operators.encode import label_decode
from sparring.operators.models import best_class


def one_hot_scores(prediction: Column, classes: Sequence) -> Column:
    """Scores of a model that only predicts a class: 1.0 for it, 0.0 for the others."""
    return F.array(*[F.when(prediction == F.lit(c), 1.0).otherwise(0.0) for c in classes])


def align_scores(
    scores: Column, model_classes: Sequence | None, canonical: Sequence, width: int | None = None
) -> Column:
    """Reorder a model's scores to the canonical classes.

    A class the model lacks scores 0 and a class it has in excess is left out. One score for two
    canonical classes is the second one's, (1 - p, p). Without a class list, `width` scores
    are taken as they are when they fit, and otherwise their mean goes to every class.
    """
    width = len(model_classes) if width is None else width
    if width == 1 and len(canonical) == 2:
        return F.array(1.0 - scores[0], scores[0])
    if model_classes is None:
        if width == len(canonical):
            return scores
        mean = F.aggregate(scores, F.lit(0.0), lambda total, p: total + p) / F.lit(width)
        return F.array_repeat(mean, len(canonical))
    if list(model_classes) == list(canonical):
        return scores
    place = {c: i for i, c in enumerate(model_classes)}
    return F.array(*[scores[place[c]] if c in place else F.lit(0.0) for c in canonical])


def _checked_weights(columns: Sequence[Column], weights: Sequence[float] | None) -> list[float]:
    if not columns:
        raise ValueError("nothing to combine")
    weights = [1.0] * len(columns) if weights is None else [float(w) for w in weights]
    if len(weights) != len(columns):
        raise ValueError(f"{len(weights)} weights for {len(columns)} models")
    return weights


def mean_vote(predictions: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """Mean, or weighted mean, of numeric predictions."""
    weights = _checked_weights(predictions, weights)
    return reduce(lambda a, b: a + b, [p * F.lit(w) for p, w in zip(predictions, weights)]) / F.lit(sum(weights))


def soft_vote(aligned: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """Mean, or weighted mean, of aligned score arrays, class by class."""
    weights = _checked_weights(aligned, weights)
    return F.transform(
        F.arrays_zip(*[c.alias(f"m{i}") for i, c in enumerate(aligned)]),
        lambda s: mean_vote([s[f"m{i}"] for i in range(len(aligned))], weights),
    )


def vote_decision(scores: Column, classes: Sequence) -> Column:
    """The class with the highest score; ties go to the first canonical class."""
    return label_decode(best_class(scores), classes)


def explode_scores(df: DataFrame, keys: Sequence[str], scores: str, classes: Sequence) -> DataFrame:
    """Score arrays as rows `keys..., class, proba`."""
    pairs = F.arrays_zip(F.array(*[F.lit(c) for c in classes]).alias("class"), col(scores).alias("proba"))
    return df.select(*[col(k) for k in keys], F.inline(pairs).alias("class", "proba"))


def ensemble_cost(runs: DataFrame, members: DataFrame) -> DataFrame:
    """Summed cost per ensemble from `runs(model, train_time, model_size)` and `members(ensemble, model)`."""
    return (
        members.join(F.broadcast(runs), "model")
        .groupBy("ensemble")
        .agg(
            F.sum("train_time").alias("train_time"),
            F.sum("model_size").alias("model_size"),
            F.lit(0.0).alias("combine_time"),
        )
    )
