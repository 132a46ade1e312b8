"""The selectable models: user-facing names and the single models behind them."""

from __future__ import annotations

from collections.abc import Sequence

from sparring.operators.task import CLASSIFICATION, REGRESSION, check_task

# Selectable names and their components.
CLASSIFICATION_MODELS: dict[str, tuple[str, ...]] = {
    "Random Forest Classifier": ("random_forest",),
    "Logistic Regression": ("logistic_regression",),
    "MLP": ("mlp",),
    "CNN": ("cnn",),
    "LSTM": ("lstm",),
    "Random Forest + Logistic Regression": ("random_forest", "logistic_regression"),
    "Random Forest + MLP": ("random_forest", "mlp"),
    "Random Forest + CNN": ("random_forest", "cnn"),
    "Random Forest + LSTM": ("random_forest", "lstm"),
    "Logistic Regression + MLP": ("logistic_regression", "mlp"),
    "Logistic Regression + CNN": ("logistic_regression", "cnn"),
    "Logistic Regression + LSTM": ("logistic_regression", "lstm"),
    "MLP + CNN": ("mlp", "cnn"),
    "MLP + LSTM": ("mlp", "lstm"),
    "CNN + LSTM": ("cnn", "lstm"),
    "Random Forest + MLP + CNN": ("random_forest", "mlp", "cnn"),
    "Random Forest + CNN + LSTM": ("random_forest", "cnn", "lstm"),
    "Logistic Regression + MLP + CNN": ("logistic_regression", "mlp", "cnn"),
    "Random Forest + Logistic Regression + MLP": ("random_forest", "logistic_regression", "mlp"),
    "Random Forest + Logistic Regression + CNN": ("random_forest", "logistic_regression", "cnn"),
}
REGRESSION_MODELS: dict[str, tuple[str, ...]] = {
    "Linear Regression": ("linear_regression",),
    "Random Forest Regressor": ("random_forest_regressor",),
    "MLP Regressor": ("mlp_regressor",),
    "Linear Regression + Random Forest Regressor": ("linear_regression", "random_forest_regressor"),
    "Linear Regression + MLP Regressor": ("linear_regression", "mlp_regressor"),
    "Random Forest Regressor + MLP Regressor": ("random_forest_regressor", "mlp_regressor"),
    "Linear Regression + Random Forest Regressor + MLP Regressor": (
        "linear_regression", "random_forest_regressor", "mlp_regressor",
    ),
}
MAX_SELECTED = 3


def models_for(task: str) -> dict[str, tuple[str, ...]]:
    return {CLASSIFICATION: CLASSIFICATION_MODELS, REGRESSION: REGRESSION_MODELS}[check_task(task)]


def checked_selection(models: Sequence[str], task: str, limit: int | None = MAX_SELECTED) -> list[str]:
    """The selection without duplicates, in its order; `limit` None allows any number."""
    known = models_for(task)
    unknown = [m for m in models if m not in known]
    if unknown:
        raise ValueError(f"unknown {task} models {unknown}; choose from {list(known)}")
    chosen = list(dict.fromkeys(models))
    if not chosen or (limit is not None and len(chosen) > limit):
        raise ValueError(f"select 1 to {limit} models, not {len(chosen)}")
    return chosen
