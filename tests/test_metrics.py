import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from sparring.operators.metrics import classification_metrics, compute_metrics, regression_metrics, roc_auc


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(3000).select(
        (i % 3).cast("double").alias("y"),
        F.when(i % 5 == 0, (i + 1) % 3).otherwise(i % 3).cast("double").alias("p"),
        F.when(i % 2 == 0, 0.0).otherwise(1.0).alias("q"),
        ((i * 7919) % 1000 / 1000 + (i % 3 == 1).cast("double") * 0.2).alias("s"),
        F.when(i % 3 == 0, 0.5).otherwise((i % 4) / 10).alias("tied"),
    )


def test_classification_against_the_library(rows):
    found = {r["model"]: r for r in classification_metrics(rows, "y", {"a": F.col("p"), "b": F.col("q")}).collect()}
    for model, column in (("a", "p"), ("b", "q")):
        library = MulticlassClassificationEvaluator(labelCol="y", predictionCol=column)
        for ours, theirs in (
            ("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1"),
        ):
            assert found[model][ours] == pytest.approx(library.evaluate(rows, {library.metricName: theirs}))
        assert found[model]["recall"] == pytest.approx(found[model]["accuracy"])
        assert found[model]["roc_auc"] is None


def test_class_only_predicted_or_never_predicted(spark):
    frame = spark.createDataFrame([("a", "a"), ("a", "x"), ("b", "a")], "y string, p string")
    row = classification_metrics(frame, "y", {"m": F.col("p")}).first()
    assert row["accuracy"] == pytest.approx(1 / 3)
    assert row["precision"] == pytest.approx((2 * 0.5 + 0) / 3)


def test_auc_against_the_library_in_many_partitions(spark, rows):
    frame = rows.withColumn("one", (F.col("y") == 1).cast("double"))
    scores = {"s": F.col("s"), "tied": F.col("tied"), "flat": F.lit(1.0)}
    found = {r["model"]: r["roc_auc"] for r in roc_auc(frame, F.col("y") == 1, scores).collect()}
    for name in ("s", "tied"):
        library = BinaryClassificationEvaluator(labelCol="one", rawPredictionCol=name, numBins=0)
        assert found[name] == pytest.approx(library.evaluate(frame))
    assert found["flat"] == pytest.approx(0.5)
    assert roc_auc(frame.where("y = 1"), F.col("y") == 1, {"s": F.col("s")}).first()["roc_auc"] is None


def test_binary_metrics_carry_the_auc(spark):
    frame = spark.createDataFrame([("n", "n", 0.1), ("n", "y", 0.6), ("y", "y", 0.9)], "a string, p string, s double")
    row = compute_metrics(frame, "a", "classification", {"m": F.col("p")}, {"m": F.col("s")}, "y").first()
    assert row["roc_auc"] == 1.0
    with pytest.raises(ValueError):
        compute_metrics(frame, "a", "clustering", {"m": F.col("p")})


def test_regression_against_the_library(rows):
    found = {r["model"]: r for r in regression_metrics(rows, "y", {"a": F.col("s"), "b": F.col("tied")}).collect()}
    for model, column in (("a", "s"), ("b", "tied")):
        library = RegressionEvaluator(labelCol="y", predictionCol=column)
        for name in ("mse", "rmse", "mae", "r2"):
            assert found[model][name] == pytest.approx(library.evaluate(rows, {library.metricName: name}))


def test_r2_of_a_constant_target(spark):
    frame = spark.createDataFrame([(2.0, 2.0, 3.0)] * 3, "y double, right double, wrong double")
    found = regression_metrics(frame, "y", {"right": F.col("right"), "wrong": F.col("wrong")}).collect()
    assert {r["model"]: r["r2"] for r in found} == {"right": 1.0, "wrong": 0.0}
