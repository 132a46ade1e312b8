"""Metrics of all models of a run at once: one result row per model."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.functions.columns import col
from sparring.operators.task import CLASSIFICATION, check_task


def _long(df: DataFrame, parts: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row per input row and model, with the given columns."""
    entries = [F.struct(F.lit(m).alias("model"), *[c.alias(n) for n, c in cs.items()]) for m, cs in parts.items()]
    return df.select(F.inline(F.array(*entries)))


def confusion(df: DataFrame, actual: str, predictions: Mapping[str, Column]) -> DataFrame:
    """`model, actual, predicted, n`; partial counts leave at most classes squared rows per task."""
    y = col(actual).cast("string")
    parts = {m: {"actual": y, "predicted": p.cast("string")} for m, p in predictions.items()}
    return _long(df, parts).groupBy("model", "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(
    df: DataFrame, actual: str, predictions: Mapping[str, Column], scores: Mapping[str, Column] | None = None,
    positive: object = None,
) -> DataFrame:
    """`model, accuracy, precision, recall, f1, roc_auc`; means over classes weighted by support.

    `scores` holds the positive-class score per model for two-class targets; without them
    `roc_auc` is NULL.
    """
    n = F.col("n")
    hit = F.col("actual") == F.col("predicted")
    sides = F.array(
        F.struct(F.col("actual").alias("class"), n.alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(hit, n).otherwise(0).alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), n.alias("predicted"),
                 F.lit(0).cast("long").alias("hits")),
    )
    per_class = (
        confusion(df, actual, predictions)
        .select("model", F.inline(sides))
        .groupBy("model", "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )

    def mean_of(top: Column, bottom: Column) -> Column:
        ratio = F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
        return F.sum(F.col("support") * ratio) / F.sum("support")

    table = per_class.groupBy("model").agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        mean_of(F.col("hits"), F.col("predicted")).alias("precision"),
        mean_of(F.col("hits"), F.col("support")).alias("recall"),
        mean_of(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
    )
    if not scores:
        return table.withColumn("roc_auc", F.lit(None).cast("double"))
    return table.join(F.broadcast(roc_auc(df, col(actual) == F.lit(positive), scores)), "model", "left")


_PIECES = "model string, low double, area double, positives double, negatives double"
_PIECES_ARROW = pa.schema(
    [("model", pa.string()), ("low", pa.float64()), ("area", pa.float64()), ("positives", pa.float64()),
     ("negatives", pa.float64())]
)


def _partition_areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per model of a partition sorted by score: its area on its own, its totals and its lowest score."""
    totals: dict[str, list[float]] = {}
    for batch in batches:
        coded = batch.column("model").dictionary_encode()
        models, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        score, pos, neg = (
            batch.column(c).to_numpy().astype(np.float64) for c in ("score", "positives", "negatives")
        )
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            own = totals.setdefault(models[codes[start]], [score[start], 0.0, 0.0, 0.0])
            p, n = pos[start:end], neg[start:end]
            below = own[3] + np.cumsum(n) - n
            own[1] += float((p * (below + n / 2)).sum())
            own[2] += float(p.sum())
            own[3] += float(n.sum())
    if totals:
        rows = [(m, *values) for m, values in totals.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, type=f.type) for v, f in zip(zip(*rows), _PIECES_ARROW)], schema=_PIECES_ARROW
        )


def roc_auc(df: DataFrame, positive: Column, scores: Mapping[str, Column]) -> DataFrame:
    """`model, roc_auc`, exact, ties counting one half; NULL when a class is missing.

    Equal scores are counted together first, so a score shared by many rows is one row. The
    counted scores are then range-partitioned: each partition adds up its own part of the
    rank sum, and only one row per partition is left for the running sum over partitions.
    """
    parts = {m: {"score": s.cast("double"), "positive": positive} for m, s in scores.items()}
    counted = (
        _long(df, parts)
        .groupBy("model", "score")
        .agg(
            F.count_if("positive").cast("double").alias("positives"),
            F.count_if(~F.col("positive")).cast("double").alias("negatives"),
        )
    )
    pieces = (
        counted.repartitionByRange("model", "score")
        .sortWithinPartitions("model", "score")
        .mapInArrow(_partition_areas, _PIECES)
    )
    # One row per partition and model: small enough to line up per model.
    per_model = pieces.groupBy("model").agg(
        F.array_sort(F.collect_list(F.struct("low", "area", "positives", "negatives"))).alias("pieces")
    )
    start = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"))
    total = F.aggregate(
        "pieces",
        start,
        lambda t, p: F.struct(
            (t["area"] + p["area"] + p["positives"] * t["neg"]).alias("area"),
            (t["pos"] + p["positives"]).alias("pos"),
            (t["neg"] + p["negatives"]).alias("neg"),
        ),
    )
    return per_model.select("model", total.alias("t")).select(
        "model", F.try_divide("t.area", F.col("t.pos") * F.col("t.neg")).alias("roc_auc")
    )


def regression_metrics(df: DataFrame, actual: str, predictions: Mapping[str, Column]) -> DataFrame:
    """`model, mse, rmse, mae, r2` from one aggregation without a shuffle of rows.

    A constant target has r2 1 when predicted perfectly and 0 otherwise.
    """
    y = col(actual).cast("double")
    aggregates, entries = [], []
    for i, (model, p) in enumerate(predictions.items()):
        error = y - p
        known = F.when(p.isNotNull(), y)
        aggregates += [
            F.avg(error * error).alias(f"mse{i}"),
            F.avg(F.abs(error)).alias(f"mae{i}"),
            F.var_pop(known).alias(f"var{i}"),
        ]
        mse, var = F.col(f"mse{i}"), F.col(f"var{i}")
        flat = F.when(mse == 0, 1.0).otherwise(0.0)
        entries.append(
            F.struct(
                F.lit(model).alias("model"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
                F.col(f"mae{i}").alias("mae"), F.coalesce(1 - F.try_divide(mse, var), flat).alias("r2"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def compute_metrics(
    df: DataFrame, actual: str, task: str, predictions: Mapping[str, Column],
    scores: Mapping[str, Column] | None = None, positive: object = None,
) -> DataFrame:
    """Metrics by task."""
    if check_task(task) == CLASSIFICATION:
        return classification_metrics(df, actual, predictions, scores, positive)
    return regression_metrics(df, actual, predictions)
