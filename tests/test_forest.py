"""Forests without a depth limit are those of Spark's own regressor, but finished in tasks."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F
from test_nets import planted

from sparring.operators.forest import ForestModel, fit_forest, grow
from sparring.operators.models import train
from sparring.session import path_exists


def table(spark, tmp_path, n, columns=None):
    """Rows in one partition: two wide features, flags, many zeros, a constant; some rows come twice."""
    i = F.floor(F.col("id") / F.when(F.col("id") % 7 == 0, 2).otherwise(1))
    h = [F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1000)) for k in range(7)]
    columns = columns or [h[0] / 7, h[1] % 3, h[2] / 1000 - 0.5, F.when(h[3] < 700, 0.0).otherwise(h[3] / 3), F.lit(1.0), h[4] % 40]
    rows = spark.range(n).select(
        "id", array_to_vector(F.array(*[c.cast("double") for c in columns])).alias("features"), (h[5] / 10 + h[0] / 100).alias("label")
    )
    path = str(tmp_path / "rows")
    rows.coalesce(1).sortWithinPartitions("id").write.parquet(path)
    return spark.read.parquet(path), len(columns)


def predictions(frame, column):
    return {r["id"]: r[column] for r in frame.select("id", column).collect()}


@pytest.mark.parametrize("n, trees, depth, bins, rows_in_task", [
    (900, 6, 30, 32, 100_000),  # each tree in a task
    (900, 3, 30, 32, 150),  # upper levels by Spark
    (900, 3, 4, 8, 100_000),
    (900, 2, 3, 32, 10),  # nothing is left for tasks
    (5, 12, 30, 32, 100_000),  # some bags are empty
    (14_000, 2, 6, 32, 100_000),  # thresholds of a sample
    (30_000, 2, 6, 32, 100_000),  # of a smaller share
])
def test_trees_are_those_of_spark(spark, tmp_path, n, trees, depth, bins, rows_in_task):
    rows, width = table(spark, tmp_path, n)
    known = rows.where("id % 5 != 1")
    assert known.rdd.getNumPartitions() == 1
    own = fit_forest(known, "label", "features", width, trees, depth, bins, 42, rows_in_task)
    spark_model = RandomForestRegressor(numTrees=trees, maxDepth=depth, maxBins=bins, featureSubsetStrategy="all", seed=42).fit(known)
    assert (len(own.upper.feature) > trees) == (rows_in_task < n)
    scored = own.transform(rows.withColumn("other", F.col("id") * 2), "features", "p")
    assert scored.columns == ["id", "features", "label", "other", "p"] and scored.where("other <> id * 2").count() == 0
    assert predictions(scored, "p") == predictions(spark_model.transform(rows), "prediction")


def test_a_fit_without_depth_limit_has_few_jobs(spark):
    """Spark's own fit takes a job for each of some 30 levels, which made it too slow."""
    prepared = planted(spark, 1500, "regression")
    context = spark.sparkContext
    context.setJobGroup("deep forest", "")
    try:
        model = train("random_forest_regressor", prepared, {"random_forest_regressor": {"n_estimators": 3}})
        assert len(context.statusTracker().getJobIdsForGroup("deep forest")) < 15
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    scored = model.score(prepared.frame, "p")
    off, var = scored.where("split = 'train'").agg(F.avg(F.pow(F.col("p") - F.col("label"), 2)), F.var_pop("label")).first()
    assert off < 0.02 * var


def test_forests_are_saved_and_loaded(spark, tmp_path):
    rows, width = table(spark, tmp_path, 300)
    own = fit_forest(rows, "label", "features", width, 3, 30, 32, 1, 100)
    early, staged = own.transform(rows, "features", "p"), own.path
    before = predictions(early, "p")
    for path in (str(tmp_path / "a"), str(tmp_path / "b")):
        own.save(spark, path)
        assert predictions(ForestModel.load(path).transform(rows, "features", "p"), "p") == before
    assert predictions(early, "p") == before
    own.stand_at(spark, str(tmp_path / "b"))
    assert not path_exists(spark, staged)
    assert predictions(own.transform(rows, "features", "p"), "p") == before
    old = RandomForestRegressor(numTrees=2, maxDepth=3, seed=1).fit(rows)  # as saved by older versions
    old.save(str(tmp_path / "old"))
    loaded = ForestModel.load(str(tmp_path / "old"))
    assert predictions(loaded.transform(rows), "prediction") == predictions(old.transform(rows), "prediction")


def test_odd_tables(spark, tmp_path):
    rows, width = table(spark, tmp_path, 40, [F.lit(1.0), F.lit(0.0)])
    flat = fit_forest(rows, "label", "features", width, 4, 30, 32, 42)
    spark_model = RandomForestRegressor(numTrees=4, maxDepth=30, featureSubsetStrategy="all", seed=42).fit(rows)
    assert predictions(flat.transform(rows, "features", "p"), "p") == predictions(spark_model.transform(rows), "prediction")
    assert flat.transform(rows.where("id < 0"), "features", "p").count() == 0
    with pytest.raises(ValueError, match="at least one"):
        fit_forest(rows.where("id < 0"), "label", "features", width, 2, 30, 32, 42)
    with pytest.raises(Exception, match="labels must not"):
        fit_forest(rows.withColumn("label", F.when(F.col("id") > 3, F.col("label"))), "label", "features", width, 2, 30, 32, 42)


def test_equal_gains_take_the_first_feature():
    """Two equal features, and a node of few rows beside one of many."""
    rng = np.random.default_rng(0)
    one = rng.integers(0, 9, 200).astype(np.uint8)
    bins = np.stack([np.zeros_like(one), one, one], axis=1)
    nodes, prediction = grow(bins, one * 1.5, np.ones(200, np.uint8), np.array([1, 9, 9]), 30)
    assert set(nodes.feature.tolist()) == {-1, 1}
    leaves = nodes.route(bins, 0)
    assert np.allclose(prediction[leaves], one * 1.5) and len(set(leaves.tolist())) == 9
