import json

import pytest
from pyspark.sql import functions as F

from sparring import Preprocessor, read_csv_table, run_experiment, session
from sparring.operators.task import infer_task
from sparring.plans import experiment, registry
from sparring.plans.report import display, human_size, totals

QUICK = {"random_forest": {"n_estimators": 5, "max_depth": 4}, "random_forest_regressor": {"n_estimators": 5, "max_depth": 5},
         "mlp_regressor": {"max_iter": 3}, "cnn": {"epochs": 2}, "lstm": {"epochs": 2}, "mlp": {"max_iter": 10}}


@pytest.fixture(scope="module")
def sweets(spark):
    """A small table like a tasting survey: flags, shares, a score, a unique name."""
    i = F.col("id")
    flag = (i % 2).cast("int")
    return spark.range(160).select(
        F.concat(F.lit("sweet "), i.cast("string")).alias("name"),
        F.when(flag == 1, "dark").otherwise("milk").alias("kind"),
        (i % 5).cast("double").alias("sugar"), ((i * 3) % 11).cast("double").alias("price"),
        F.element_at(F.array(*[F.lit(c) for c in "rgb"]), (i % 3 + 1).cast("int")).alias("color"),
        (flag * 20 + (i % 5) * 2 + F.pmod(F.xxhash64(i), F.lit(10)) / 10).alias("score"),
    )


def test_regression_run(spark, sweets, tmp_path, monkeypatch):
    calls = []
    train = experiment.train
    monkeypatch.setattr(experiment, "train", lambda name, *a: calls.append(name) or train(name, *a))
    names = ["Linear Regression", "Linear Regression + Random Forest Regressor + MLP Regressor", "Linear Regression"]
    result = run_experiment(sweets, "score", names, key_cols=["name"], config=QUICK, output_dir=str(tmp_path))
    assert result.task == "regression"
    assert calls == ["linear_regression", "random_forest_regressor", "mlp_regressor"]
    board = result.leaderboard.collect()
    assert [r["model"] for r in board] == names[:2]
    assert board[0]["r2"] > 0.95
    assert board[1]["train_time"] > board[0]["train_time"] and board[1]["model_size"] > board[0]["model_size"]
    wide = result.predictions
    assert wide.columns == ["row_key", "Actual", *names[:2]] and wide.count() == 32
    exported = read_csv_table(spark, str(next(tmp_path.iterdir())))
    assert exported.columns == ["Actual", *names[:2]] and exported.count() == 32
    sums = result.totals.first()
    assert sums["model_size"] == sum(r["model_size"] for r in board)
    shown = display(result.leaderboard, "regression").collect()
    assert shown[0]["Model"] == names[0] and len(shown[0]["mse"].split(".")[1]) == 4
    saved = json.loads(spark.read.text(result.runs.where("place = 1").first()["model_path"]).first()[0])
    assert saved["method"] == "mean_average" and len(saved["components"]) == 3 and "canonical_classes" not in saved


def test_content_keys_and_leaky_columns(sweets):
    result = run_experiment(sweets.withColumn("copy", F.col("kind")), "kind", ["Logistic Regression"], config=QUICK)
    report = {r["col"]: r["rule"] for r in result.leak_report.collect()}
    assert report["name"] == "id_like" and report["copy"] == "cat_value_maps_to_single_target"
    assert result.predictions.count() == 32
    assert result.leaderboard.first()["roc_auc"] is not None


def test_multiclass_ensembles(sweets):
    names = ["CNN + LSTM", "Random Forest + MLP"]
    result = run_experiment(sweets, "color", names, key_cols=["name"], config=QUICK)
    rows = result.leaderboard.collect()
    assert [r["roc_auc"] for r in rows] == [None, None]
    assert all(r["recall"] == pytest.approx(r["accuracy"]) for r in rows)
    assert {r[0] for r in result.predictions.select("CNN + LSTM").distinct().collect()} <= {"r", "g", "b"}
    assert [e["canonical_classes"] for e in result.ensembles] == [["b", "g", "r"]] * 2


def test_columns_named_like_ours(sweets):
    odd = sweets.select("name", F.col("kind").alias("label"), F.col("sugar").alias("features"),
                        F.col("price").alias("actual"), F.col("score").alias("a.b `c`"))
    result = run_experiment(odd, "label", ["Logistic Regression"], key_cols=["name"], preprocessor=Preprocessor(
        thresholds=experiment.Preprocessor().thresholds))
    assert result.leaderboard.count() == 1
    with pytest.raises(ValueError, match="rename"):
        run_experiment(sweets.withColumn("split", F.lit(1)), "kind", ["MLP"], key_cols=["name"])


def test_null_targets(sweets):
    holes = sweets.withColumn("kind", F.when(F.col("sugar") != 3, F.col("kind")))
    with pytest.raises(ValueError, match="NULL"):
        run_experiment(holes, "kind", ["Logistic Regression"], key_cols=["name"])
    result = run_experiment(holes, "kind", ["Logistic Regression"], key_cols=["name"], drop_null_target=True)
    assert result.predictions.count() == 26


def test_selection_rules():
    assert len(registry.CLASSIFICATION_MODELS) == 20 and len(registry.REGRESSION_MODELS) == 7
    assert registry.checked_selection(["CNN", "MLP", "CNN"], "classification") == ["CNN", "MLP"]
    for wrong in ([], ["MLP", "CNN", "LSTM", "MLP + CNN"], ["Linear Regression"], ["nope"]):
        with pytest.raises(ValueError):
            registry.checked_selection(wrong, "classification")


def test_task_inference(spark):
    frame = spark.range(100).selectExpr(
        "id % 15 AS few", "id % 16 AS many", "CAST(id AS STRING) AS text", "id % 2 = 0 AS flag", "CAST(id AS DOUBLE) AS x"
    )
    assert [infer_task(frame, c) for c in frame.columns] == [
        "classification", "regression", "classification", "classification", "regression",
    ]


def test_human_sizes(spark):
    sizes = [0, 5, 1023, 1024, 1536, 1024**2, 3 * 1024**3, 1024**5, 7 * 1024**6]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, s long")
    shown = [r[0] for r in frame.orderBy("i").select(human_size(F.col("s"))).collect()]
    assert shown == ["-", "5 B", "1023 B", "1.00 KB", "1.50 KB", "1.00 MB", "3.00 GB", "1.00 PB", "7168.00 PB"]
    empty = spark.createDataFrame([], "train_time double, model_size long")
    assert tuple(totals(empty).first()) == (0.0, 0, "-")


def files_below(folder):
    return sorted(p.name for p in folder.rglob("*") if p.is_file() and not p.name.startswith("."))


@pytest.mark.parametrize("task, target, names", [
    ("regression", "score", ["Linear Regression", "Linear Regression + Random Forest Regressor"]),
    ("classification", "kind", ["Logistic Regression", "Random Forest Classifier"]),
])
def test_a_stopped_run_goes_on(spark, sweets, tmp_path, monkeypatch, task, target, names):
    """A run that dies after `prepare`, and again after its first model, ends as one that never stopped."""
    folder, staged = str(tmp_path / "run"), tmp_path / "staged"
    monkeypatch.setattr(session, "_local_scratch", lambda: str(staged))
    arguments = dict(task=task, key_cols=["name"], config=QUICK)
    whole = run_experiment(sweets, target, names, **arguments)
    train, fit, calls = experiment.train, Preprocessor.fit, []

    def dies(after):
        def run(name, *rest):
            calls.append(name)
            if len(calls) > after:
                raise RuntimeError("the driver is gone")
            return train(name, *rest)

        return run

    for after in (0, 1):
        calls.clear()
        monkeypatch.setattr(experiment, "train", dies(after))
        with pytest.raises(RuntimeError, match="gone"):
            run_experiment(sweets, target, names, run_dir=folder, **arguments)
        monkeypatch.setattr(Preprocessor, "fit", lambda *a: pytest.fail("the preprocessor is stored already"))
    calls.clear()
    monkeypatch.setattr(experiment, "train", dies(1))
    result = run_experiment(sweets, target, names, run_dir=folder, **arguments)
    assert len(calls) == 1  # only the second model
    monkeypatch.setattr(Preprocessor, "fit", fit)
    assert sorted(map(tuple, result.predictions.collect())) == sorted(map(tuple, whole.predictions.collect()))
    with pytest.raises(ValueError, match="other"):
        run_experiment(sweets, target, names[:1], run_dir=folder, **arguments)
    result.release()
    whole.release()
    assert not (tmp_path / "run").exists() and files_below(staged) == []
