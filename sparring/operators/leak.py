"""Finding ID-like columns and columns that give the target away, on training rows only."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparring.functions.columns import (
    NUMBER_PATTERN,
    categorical_columns,
    col,
    numeric_columns,
    per_column,
    require_column,
    sql_name,
    to_number,
)
from sparring.operators.profile import (
    category_profile,
    class_gaps,
    numeric_moments,
    single_target_columns,
    summaries,
    uniqueness,
)
from sparring.operators.task import CLASSIFICATION, check_task
from sparring.session import local_frame, materialize

# Rule names in the order in which they are tried.
RULES = (
    "id_like",
    "presence_diff",
    "constant_overall",
    "high_corr",
    "constant_within_class",
    "zero_fraction_diff",
    "min_value_presence_diff",
    "cat_value_maps_to_single_target",
)


@dataclass(frozen=True)
class LeakThresholds:
    """Fixed default values; `minimum_diff` None means the same limit as `zero_diff`."""

    unique: float = 0.8
    presence_diff: float = 0.9
    corr: float = 0.95
    zero_diff: float = 0.9
    minimum_diff: float | None = None
    max_classes: int = 50
    id_like_numeric: bool = True


FINDINGS = "col string, rule string, stat double, reason string"


def class_counts(train: DataFrame, target: str, task: str, max_classes: int = 50) -> list[Row] | None:
    """`(value, text, n_rows)` per class if the per-class rules apply, else None.

    They apply to classification targets with at most `max_classes` classes.
    """
    if check_task(task) != CLASSIFICATION:
        return None
    name = sql_name(target)
    classes = train.groupBy(F.expr(f"{name} AS value"), F.expr(f"CAST({name} AS STRING) AS text"))
    rows = classes.agg(F.expr("count(1) AS n_rows")).limit(max_classes + 1).collect()
    return rows if len(rows) <= max_classes else None


def _may_be_numeric(classes: list[Row] | None) -> bool:
    """Whether a target with these classes has a value that reads as a number."""
    return classes is None or any(
        r["value"] is not None and (not isinstance(r["value"], str) or re.match(NUMBER_PATTERN, r["value"]))
        for r in classes
    )


def _has_numbers(train: DataFrame, target: str, classes: list[Row] | None, moments: Mapping[str, Row]) -> bool:
    """Whether the target reads as a number in some row."""
    if classes is not None:
        return _may_be_numeric(classes)
    return any(r["n_pairs"] for r in moments.values()) or not train.where(to_number(train, target).isNotNull()).isEmpty()


def _findings(frame: DataFrame, rule: str, trips: str, stat: str, reason: str) -> DataFrame:
    """Rows of `frame` that trip a rule; the arguments after `rule` are SQL text."""
    return frame.where(trips).selectExpr(
        "col", f"'{rule}' AS rule", f"CAST({stat} AS DOUBLE) AS stat", f"{reason} AS reason"
    )


def id_like(
    train: DataFrame, columns: Sequence[str], t: LeakThresholds = LeakThresholds()
) -> DataFrame:
    stats = uniqueness(train, columns, t.unique)
    reason = "format_string('id_like (high_unique_frac=%.3f)', unique_frac)"
    return _findings(stats, RULES[0], f"unique_frac >= {t.unique}D", "unique_frac", reason)


def presence_diff(gaps: DataFrame, t: LeakThresholds = LeakThresholds()) -> DataFrame:
    reason = "format_string('presence_diff (nonnull_frac_diff=%.3f)', presence_gap)"
    return _findings(gaps, RULES[1], f"presence_gap > {t.presence_diff}D", "presence_gap", reason)


def constant_overall(moments: DataFrame) -> DataFrame:
    return _findings(moments, RULES[2], "constant", "NULL", "'constant_overall'")


def high_corr(moments: DataFrame, t: LeakThresholds = LeakThresholds()) -> DataFrame:
    reason = "format_string('high_corr (corr=%.3f)', abs(corr))"
    return _findings(moments, RULES[3], f"abs(corr) >= {t.corr}D", "abs(corr)", reason)


def constant_within_class(train: DataFrame, target: str, gaps: DataFrame) -> DataFrame:
    """The distinct counts per class are only taken for the columns that the gaps name."""
    names = [r["col"] for r in gaps.where("mixed_constancy").select("col").collect()]
    if not names:
        return local_frame(train.sparkSession, [], FINDINGS)
    counts = per_column(
        train.withColumnRenamed(target, "__stratum"),
        names,
        {"n_unique": "count(DISTINCT {c}) + max(CAST({c} IS NULL AS LONG))"},
        by=["__stratum"],
    )
    quote = "\\'" if isinstance(train.schema[target].dataType, T.StringType) else ""
    pairs = f"concat('{quote}', CAST(p.stratum AS STRING), '{quote}: ', CAST(p.n_unique AS STRING))"
    text = f"array_join(transform(array_sort(collect_list(struct(__stratum AS stratum, n_unique))), p -> {pairs}), ', ')"
    reason = f"concat('constant_within_class (per_class_nunique={{', {text}, '}})') AS reason"
    return _findings(counts.groupBy("col").agg(F.expr(reason)), RULES[4], "true", "1.0", "reason")


def zero_fraction_diff(gaps: DataFrame, t: LeakThresholds = LeakThresholds()) -> DataFrame:
    reason = "format_string('zero_fraction_diff (zero_frac_diff=%.3f)', zero_gap)"
    return _findings(gaps, RULES[5], f"zero_gap >= {t.zero_diff}D", "zero_gap", reason)


def min_value_presence_diff(gaps: DataFrame, t: LeakThresholds = LeakThresholds()) -> DataFrame:
    limit = t.zero_diff if t.minimum_diff is None else t.minimum_diff
    reason = "format_string('min_value_presence_diff (min_fraction_diff=%.3f)', minimum_gap)"
    return _findings(gaps, RULES[6], f"minimum_gap >= {limit}D", "minimum_gap", reason)


def cat_single_target(profile: DataFrame) -> DataFrame:
    return _findings(single_target_columns(profile), RULES[7], "n_mixed = 0", "NULL", f"'{RULES[7]}'")


@dataclass(frozen=True)
class LeakScan:
    """What the passes over the training rows found and can be used again."""

    findings: list[Row]
    classes: list[Row] | None
    profile: DataFrame | None
    moments: dict[str, Row]


def scan_leaks(
    train: DataFrame,
    target: str,
    task: str,
    columns: Sequence[str] | None = None,
    thresholds: LeakThresholds = LeakThresholds(),
) -> LeakScan:
    """Apply the rules in order.

    One pass of summaries by class serves all rules but the first and the last, and the scaling of numbers. A column that
    a rule names is left out of the later passes. ID-like columns go first, so the later passes only shuffle
    per-class rows and the categories of columns with repeated values. The category profile is written once
    and serves the encoders too.
    """
    require_column(train, target)
    spark = train.sparkSession
    t = thresholds
    columns = [c for c in (train.columns if columns is None else columns) if c != target]
    numeric = [c for c in numeric_columns(train) if c in columns]
    categorical = [c for c in categorical_columns(train) if c in columns]
    checked = [c for c in columns if c in categorical or (c in numeric and t.id_like_numeric)]
    found: list[Row] = []

    def left(names: Sequence[str]) -> list[str]:
        dropped = {r["col"] for r in found}
        return [c for c in names if c not in dropped]

    def apply(*rules: DataFrame) -> None:
        """Collect a few findings per column; a column keeps the first rule that names it."""
        for rule in rules:
            found.extend(r for r in rule.collect() if left([r["col"]]))

    def collected(stats: DataFrame) -> DataFrame:
        """One row per column, computed once for all the rules that read it."""
        return local_frame(spark, [tuple(r) for r in stats.collect()], stats.schema)

    classes = class_counts(train, target, task, t.max_classes)
    if checked:
        apply(id_like(train, checked, t))
    moments: dict[str, Row] = {}
    if left(numeric) or (classes is not None and left(categorical)):
        other = left(categorical) if classes is not None else []
        numbers = target if _may_be_numeric(classes) else None
        summary = collected(summaries(train, left(numeric), other, target if classes is not None else None, numbers))
        overall = collected(numeric_moments(summary))
        moments = {r["col"]: r for r in overall.collect()}
        gaps = collected(class_gaps(summary)) if classes is not None else None
        if gaps is not None:
            apply(presence_diff(gaps, t))
        # Without a single number in the target these two rules do not apply.
        if numbers and _has_numbers(train, target, classes, moments):
            apply(constant_overall(overall), high_corr(overall, t))
        if gaps is not None and left(numeric):
            apply(constant_within_class(train, target, gaps.where(col("col").isin(left(numeric)))))
            apply(zero_fraction_diff(gaps.where(col("col").isin(left(numeric))), t))
            apply(min_value_presence_diff(gaps.where(col("col").isin(left(numeric))), t))
    profile = None
    if left(categorical):
        profile = materialize(category_profile(train, left(categorical), target), "categories")
        if classes is not None:
            apply(cat_single_target(profile))
    return LeakScan(sorted(found, key=lambda r: r["col"]), classes, profile, moments)


def leak_report(
    train: DataFrame,
    target: str,
    task: str,
    columns: Sequence[str] | None = None,
    thresholds: LeakThresholds = LeakThresholds(),
) -> DataFrame:
    """`col, rule, stat, reason` of every column to drop, each under the first rule it meets."""
    findings = scan_leaks(train, target, task, columns, thresholds).findings
    return local_frame(train.sparkSession, [tuple(r) for r in findings], FINDINGS)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns, ignoring names the frame lacks."""
    return df.drop(*names)
