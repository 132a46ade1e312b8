"""One experiment: prepare a table once, train what was selected, compare."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparring.functions.columns import clean_missing, col, require_column
from sparring.functions.keys import ROW_KEY
from sparring.operators.encode import ACTUAL, FittedPreprocessor, Prepared, Preprocessor, label_decode
from sparring.operators.ensemble import align_scores, mean_vote, soft_vote, vote_decision
from sparring.operators.forest import ForestModel
from sparring.operators.leak import FINDINGS
from sparring.operators.metrics import compute_metrics
from sparring.operators.models import Fitted, train
from sparring.operators.split import SPLIT, TEST, split
from sparring.operators.task import CLASSIFICATION, infer_task
from sparring.plans.registry import MAX_SELECTED, checked_selection, models_for
from sparring.plans.model_store import READERS, load_preprocessor, save_preprocessor
from sparring.plans.report import leaderboard, prediction_table, totals
from sparring.plans.run_folder import RunFolder
from sparring.session import delete_path, local_frame, materialize, staging_path
from sparring.sources.exports import save_ensemble, save_predictions

# Training rows of one partition of a prepared table. Fits sample by partition, so partitions and their order follow
# from the rows alone: not from files, cores or a size limit.
ROWS_PER_PARTITION = 20_000


@dataclass
class Result:
    """What a run returns; every table is a DataFrame."""

    task: str
    leaderboard: DataFrame
    totals: DataFrame
    predictions: DataFrame
    leak_report: DataFrame
    runs: DataFrame
    fitted: dict[str, Fitted]
    preprocessor: FittedPreprocessor
    ensembles: list[dict]
    folder: RunFolder

    def release(self) -> None:
        """Delete what the run staged: its models, if no `model_dir` was given, and tables, `predictions` among them."""
        self.folder.release()

def prepare(
    df: DataFrame, target: str, task: str, key_cols: Sequence[str] | None = None,
    test_size: float = 0.2, seed: int = 42, preprocessor: Preprocessor | None = None, folder: RunFolder | None = None,
) -> tuple[Prepared, FittedPreprocessor]:
    """Split, fit the preprocessor on the training rows, and write the transformed table once.

    In a run's `folder` the fitted preprocessor is written before the table, and neither is made again.
    """
    taken = {SPLIT, ROW_KEY} & set(df.columns)
    if taken:
        raise ValueError(f"rename the columns {sorted(taken)}; their names are used by the split")
    table = split(df, target, task, key_cols, test_size, seed)
    preprocessor = replace(preprocessor or Preprocessor(), key_cols=tuple(key_cols or ()))
    if folder is None:
        fitted = preprocessor.fit(table, target, task)
    else:

        def fit(path: str) -> dict:
            found = preprocessor.fit(table, target, task)
            save_preprocessor(df.sparkSession, found, path)
            found.release()
            return {}

        folder.step("preprocessor", fit)
        fitted = load_preprocessor(df.sparkSession, folder.at("preprocessor"))
    prepared = fitted.transform(table)
    parts = -(-max(1, fitted.n_train) // ROWS_PER_PARTITION)
    frame = prepared.frame.repartition(parts, ROW_KEY).sortWithinPartitions(ROW_KEY)
    frame = materialize(frame, "prepared") if folder is None else folder.table("prepared", lambda: frame)
    return replace(prepared, frame=frame), fitted


def trained(spark: SparkSession, name: str, prepared: Prepared, config: Mapping | None, folder: RunFolder, path: str) -> tuple[Fitted, int]:
    """A model and its saved size: trained and saved below `path`, or loaded from there if the run has finished it."""
    fresh: list[Fitted] = []

    def make(_: str) -> dict:
        delete_path(spark, path)
        fresh.append(train(name, prepared, config))
        size = fresh[0].save(prepared.frame, path)
        if isinstance(fresh[0].model, ForestModel):
            fresh[0].model.stand_at(spark, path)
        return {"size": size, "train_time": fresh[0].train_time, "extra": fresh[0].extra}

    done = folder.step(f"model_{name}", make)
    if fresh:
        return fresh[0], done["size"]
    if name not in READERS:  # networks are not read again
        return train(name, prepared, config), done["size"]
    model = READERS[name].load(path)
    return Fitted(name, prepared.task, prepared.classes, model, done["train_time"], done["extra"]), done["size"]


def score_models(rows: DataFrame, fitted: Mapping[str, Fitted]) -> DataFrame:
    """All model outputs as columns `s_<name>` of the same row."""
    for name, model in fitted.items():
        rows = model.score(rows, f"s_{name}")
    return rows


def combined_outputs(
    name: str, components: Sequence[str], fitted: Mapping[str, Fitted], task: str, classes: list | None,
    weights: Sequence[float] | None = None,
) -> tuple[Column, Column | None]:
    """Prediction and class scores (None for regression) of one selectable model."""
    outputs = [F.col(f"s_{c}") for c in components]
    if task != CLASSIFICATION:
        return mean_vote(outputs, weights) if len(outputs) > 1 else outputs[0], None
    if len(outputs) == 1:
        return label_decode(fitted[components[0]].decision(outputs[0]), classes), outputs[0]
    aligned = [align_scores(o, fitted[c].classes, classes) for o, c in zip(outputs, components)]
    voted = soft_vote(aligned, weights)
    return vote_decision(voted, classes), voted


def run_experiment(
    df: DataFrame,
    target: str,
    models: Sequence[str],
    task: str | None = None,
    key_cols: Sequence[str] | None = None,
    config: Mapping | None = None,
    preprocessor: Preprocessor | None = None,
    test_size: float = 0.2,
    drop_null_target: bool = False,
    model_dir: str | None = None,
    output_dir: str | None = None,
    max_models: int | None = MAX_SELECTED,
    run_dir: str | None = None,
) -> Result:
    """Compare the selected models on one table.

    A component shared by several selections is trained once. All outputs are computed in one pass
    over the test rows. `config` holds shared settings (`seed`, ...) and one section per
    model. With `output_dir` the predictions are written as CSV.

    All tables and models of the run stand in one folder. A run that is given the `run_dir` of one that was stopped, with the
    same arguments and input, goes on after the last step that was finished there.
    """
    spark = df.sparkSession
    require_column(df, target)
    df = clean_missing(df)
    if drop_null_target:
        df = df.where(col(target).isNotNull())
    task = task or infer_task(df, target)
    selected = checked_selection(models, task, max_models)
    registry = models_for(task)
    seed = int((config or {}).get("seed", 42))
    settings = {
        "target": target, "task": task, "models": selected, "key_cols": list(key_cols or ()), "config": dict(config or {}),
        "preprocessor": str(preprocessor), "test_size": test_size, "columns": df.dtypes, "model_dir": model_dir,
    }
    folder = RunFolder(spark, run_dir or staging_path(spark, "run"), settings)
    run_id = folder.step("id", lambda _: {"id": uuid.uuid4().hex[:12]})["id"]
    model_dir = f"{model_dir.rstrip('/')}/{run_id}" if model_dir else folder.at("models")

    prepared, fitted_preprocessor = prepare(df, target, task, key_cols, test_size, seed, preprocessor, folder)
    needed = list(dict.fromkeys(c for m in selected for c in registry[m]))
    paths = {name: f"{model_dir}/{name}" for name in needed}
    found = {name: trained(spark, name, prepared, config, folder, paths[name]) for name in needed}
    fitted, sizes = {n: f for n, (f, _) in found.items()}, {n: s for n, (_, s) in found.items()}

    test = prepared.frame.where(F.col(SPLIT) == TEST)
    outputs = {m: combined_outputs(m, registry[m], fitted, task, prepared.classes) for m in selected}
    binary = task == CLASSIFICATION and len(prepared.classes) == 2
    scored = folder.table(
        "scored",
        lambda: score_models(test, fitted).select(
            ROW_KEY,
            ACTUAL,
            *[p.alias(f"p{i}") for i, (p, _) in enumerate(outputs.values())],
            *[s[1].alias(f"q{i}") for i, (_, s) in enumerate(outputs.values()) if binary],
        ),
    )
    predictions = {m: F.col(f"p{i}") for i, m in enumerate(selected)}
    positives = {m: F.col(f"q{i}") for i, m in enumerate(selected)} if binary else None
    metrics = compute_metrics(
        scored, ACTUAL, task, predictions, positives, prepared.classes[1] if binary else None
    ).collect()
    by_model = {r["model"]: {k: v for k, v in r.asDict().items() if k != "model"} for r in metrics}

    runs, ensembles = [], []
    for place, name in enumerate(selected):
        parts = registry[name]
        seconds = float(sum(fitted[c].train_time for c in parts))
        size = int(sum(sizes[c] for c in parts))
        extra = {k: str(v) for k, v in fitted[parts[0]].extra.items()} if len(parts) == 1 else {}
        path = paths[parts[0]]
        if len(parts) > 1:
            path = f"{model_dir}/ensemble_{'_'.join(parts)}"
            description = {
                "ensemble_name": name,
                "method": "soft_average" if task == CLASSIFICATION else "mean_average",
                "components": [paths[c] for c in parts],
                "metrics": by_model[name],
                "train_time_sum": seconds,
                "model_size_sum": size,
                "combine_time": 0.0,
            }
            if task == CLASSIFICATION:
                description["canonical_classes"] = prepared.classes
            delete_path(spark, path)
            save_ensemble(spark, description, path)
            ensembles.append(description)
            extra = {"components": str(description["components"]), "method": description["method"]}
        runs.append((place, name, path, seconds, size, list(extra.items())))
    runs_frame = local_frame(
        spark, runs,
        "place int, model string, model_path string, train_time double, model_size long, extra map<string,string>",
    )
    metric_names = [c for c in metrics[0].asDict() if c != "model"]
    metrics_frame = local_frame(
        spark, [tuple(r) for r in metrics], "model string, " + ", ".join(f"{c} double" for c in metric_names)
    )
    board = leaderboard(runs_frame, metrics_frame, task)
    wide = prediction_table(scored, ROW_KEY, ACTUAL, predictions)
    if output_dir:
        save_predictions(wide.drop(ROW_KEY), f"{output_dir.rstrip('/')}/predictions_{run_id}")
    report = local_frame(spark, [tuple(r) for r in fitted_preprocessor.report], FINDINGS)
    return Result(
        task, board, totals(board), wide, report, runs_frame, fitted, fitted_preprocessor, ensembles, folder
    )
