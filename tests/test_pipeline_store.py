"""A stored pipeline scores like the one that was saved."""

import pytest
from pyspark.sql import functions as F

from sparring import Pipeline, Preprocessor, load_pipeline, run_experiment, save_pipeline
from sparring.functions.columns import col
from sparring.operators.leak import LeakThresholds
from sparring.plans import pipeline_store
from sparring.sources.exports import saved_size

QUICK = {"random_forest": {"n_estimators": 4, "max_depth": 4}, "random_forest_regressor": {"n_estimators": 4, "max_depth": 4}, "mlp": {"max_iter": 5}}


@pytest.fixture(scope="module")
def survey(spark):
    i = F.col("id")
    h = F.pmod(F.xxhash64(i), F.lit(1000))
    return spark.range(400).select(
        i, (h / 7).alias("odd name `x`"), (i % 13).alias("count"),
        F.concat(F.lit("brand "), (i % 61).cast("string")).alias("brand"),
        F.when(h % 11 == 0, None).otherwise(F.concat(F.lit("é"), (h % 5).cast("string"))).alias("color"),
        (h % 3 == 0).alias("flag"), F.array(h / 3, (i % 4).cast("double")).alias("series"),
        F.concat(F.lit("c"), (h % 4).cast("string")).alias("text_class"), (h % 3 + 9).alias("number_class"), (h % 2 == 0).alias("bool_class"),
        ((h % 7) * 1.1).alias("real_class"), (h * 0.3 + i % 13).alias("worth"),
    )


OPTIONS = Preprocessor(high_cardinality=30, svd_components=4, array_cols=["series"], thresholds=LeakThresholds(unique=2.0, corr=2.0))


def input_of(survey, target):
    return survey.select("id", col("odd name `x`"), "count", "brand", "color", "flag", "series", target)


@pytest.mark.parametrize("target, task, names", [
    ("text_class", None, ["Logistic Regression", "Random Forest + Logistic Regression"]),
    ("number_class", "classification", ["MLP", "Random Forest Classifier"]),
    ("bool_class", None, ["Logistic Regression"]),
    ("real_class", "classification", ["Random Forest Classifier"]),
    ("worth", "regression", ["Linear Regression", "Random Forest Regressor"]),
])
def test_loaded_pipelines_score_the_same(spark, survey, tmp_path, target, task, names):
    rows = input_of(survey, target)
    result = run_experiment(rows, target, names, task=task, key_cols=["id"], config=QUICK, preprocessor=OPTIONS)
    p = result.preprocessor
    assert p.numeric and p.frequency == ["brand"] and p.onehot.columns == ["color", "flag"] and p.vectors is not None and p.arrays
    saved, path = Pipeline(p, result.fitted), str(tmp_path / "stored")
    save_pipeline(spark, saved, path, {"config": QUICK})
    other = spark.newSession()
    loaded = load_pipeline(other, path)
    new = rows.drop(target).union(rows.drop(target).limit(1).withColumns({"id": F.lit(-1), "brand": F.lit("unseen"), "color": F.lit("unseen")}))
    columns = [f"s_{m}" for m in result.fitted]
    before = sorted(map(tuple, saved.scores(new).select("row_key", *columns).collect()))
    staged = str(tmp_path / "new")
    new.write.parquet(staged)
    after = sorted(map(tuple, loaded.scores(other.read.parquet(staged)).select("row_key", *columns).collect()))
    assert before == after and len(after) == 401
    test_keys = result.predictions
    again = loaded.predict(other.read.parquet(staged), names)
    joined = test_keys.join(spark.createDataFrame(again.collect(), again.schema).withColumnsRenamed({m: f"again {m}" for m in names}), "row_key")
    assert joined.count() == test_keys.count()
    assert all(r[m] == r[f"again {m}"] for r in joined.collect() for m in names)
    assert loaded.preprocessor.classes == p.classes
    assert saved_size(spark, path) > 0 and pipeline_store.read_manifest(spark, path)["settings"]["config"]["mlp"] == {"max_iter": 5}


def test_refusals(spark, survey, tmp_path):
    rows = survey.select("id", "count", "worth")
    result = run_experiment(rows, "worth", ["Linear Regression"], task="regression", key_cols=["id"])
    saved, path = Pipeline(result.preprocessor, result.fitted), str(tmp_path / "stored")
    save_pipeline(spark, saved, path)
    with pytest.raises(ValueError, match="exists"):
        save_pipeline(spark, saved, path)
    with pytest.raises(ValueError, match="complete"):
        load_pipeline(spark, str(tmp_path))
    with pytest.raises(ValueError, match="not in"):
        load_pipeline(spark, path, ["mlp"])
    with pytest.raises(ValueError, match="lacks"):
        load_pipeline(spark, path).predict(rows, ["Random Forest Regressor"])
    with pytest.raises(ValueError, match="cannot be stored"):
        save_pipeline(spark, Pipeline(result.preprocessor, {"cnn": result.fitted["linear_regression"]}), path + "2")
    old = pipeline_store.FORMAT_VERSION
    pipeline_store.FORMAT_VERSION = 99
    try:
        with pytest.raises(ValueError, match="format"):
            load_pipeline(spark, path)
    finally:
        pipeline_store.FORMAT_VERSION = old
