"""One hand-made frame per rule, one just below its threshold, and the NULL cases."""

import pytest

from sparring.operators import profile
from sparring.operators.leak import LeakThresholds, leak_report


def report(spark, pairs, kind="double", y="string", task="classification", **thresholds):
    frame = spark.createDataFrame(pairs, f"y {y}, x {kind}")
    return {r["col"]: r for r in leak_report(frame, "y", task, ["x"], LeakThresholds(**thresholds)).collect()}


def rule(spark, pairs, *args, **kwargs):
    found = report(spark, pairs, *args, **kwargs)
    return found["x"]["rule"] if found else None


def classes(a, b):
    return [("a", v) for v in a] + [("b", v) for v in b]


def test_id_like(spark):
    assert rule(spark, [("a", float(min(i, 7))) for i in range(10)]) == "id_like"
    assert rule(spark, [("a", float(min(i, 6))) for i in range(10)]) is None
    with_null = [("a", None if i >= 7 else float(i)) for i in range(10)]
    assert rule(spark, with_null) == "id_like"
    assert rule(spark, with_null, unique=0.85) is None
    assert rule(spark, with_null, id_like_numeric=False) is None
    found = report(spark, [("a", float(i)) for i in range(10)], y="string", task="regression")
    assert found["x"]["reason"] == "id_like (high_unique_frac=1.000)"


def test_presence_diff(spark):
    a = [1.0, 2.0, 3.0, 4.0] * 5
    assert rule(spark, classes(a, [None] * 20)) == "presence_diff"
    assert rule(spark, classes(a, [None] * 18 + [1.0, 2.0])) is None


def test_constant_overall_needs_a_numeric_target(spark):
    rows = [(float(i % 4), 5.0) for i in range(20)]
    assert rule(spark, rows, y="double") == "constant_overall"
    assert rule(spark, [(str(a), x) for a, x in rows]) == "constant_overall"
    assert rule(spark, [("t" + str(a), x) for a, x in rows]) is None
    assert rule(spark, [(a, None) for a, _ in rows], y="double") == "constant_overall"


def test_high_corr_on_complete_pairs(spark):
    rows = [(float(i % 10), 2.0 * (i % 10) + (0.5 if i % 3 else 0.0)) for i in range(60)]
    assert rule(spark, rows, y="double", task="regression") == "high_corr"
    assert rule(spark, rows + [(3.0, None)] * 5, y="double", task="regression") == "high_corr"
    noisy = [(float(i % 10), float((i % 10) + (i * 7) % 13)) for i in range(60)]
    assert rule(spark, noisy, y="double", task="regression") is None


def test_constant_within_class(spark):
    varied = [1.0, 2.0, 3.0, 4.0] * 5
    found = report(spark, classes([2.0] * 20, varied))["x"]
    assert found["rule"] == "constant_within_class"
    assert found["reason"] == "constant_within_class (per_class_nunique={'a': 1, 'b': 4})"
    assert rule(spark, classes([2.0] * 20, [3.0] * 20)) is None
    # NULL counts as a value.
    assert rule(spark, classes([2.0] * 19 + [None], varied)) is None
    assert rule(spark, classes([None] * 2 + [1.0] * 18, [2.0] * 20)) == "constant_within_class"


def test_zero_fraction(spark):
    assert rule(spark, classes([0.0] * 19 + [5.0], [3.0, 4.0] * 10)) == "zero_fraction_diff"
    assert rule(spark, classes([0.0] * 17 + [5.0] * 3, [3.0, 4.0] * 10)) is None
    # NULL is not zero.
    assert rule(spark, classes([None] * 18 + [0.0, 5.0], [3.0, 4.0, None, None] * 5)) is None


def test_own_minimum_share(spark):
    spread = [2.0] + [3.0, 4.0, 5.0] * 13
    assert rule(spark, classes([1.0] * 39 + [9.0], spread)) == "min_value_presence_diff"
    assert rule(spark, classes([1.0] * 36 + [9.0] * 4, spread)) is None
    assert rule(spark, classes([1.0] * 36 + [9.0] * 4, spread), minimum_diff=0.8) == "min_value_presence_diff"


def test_category_of_a_single_target(spark):
    assert rule(spark, classes(["p", "q"] * 5, ["r", "s"] * 5), "string") == "cat_value_maps_to_single_target"
    assert rule(spark, classes(["p", "q"] * 5, ["r", "p"] * 5), "string") is None
    assert rule(spark, classes(["p", None] * 5, ["r", None] * 5), "string") == "cat_value_maps_to_single_target"
    assert rule(spark, classes([None] * 5, [None] * 5), "string") is None
    assert rule(spark, classes([True] * 5, [False] * 5), "boolean") == "cat_value_maps_to_single_target"


@pytest.mark.parametrize("n_classes, expected", [(50, "cat_value_maps_to_single_target"), (51, None)])
def test_class_gate(spark, n_classes, expected):
    rows = [(f"k{i % n_classes:02d}", f"v{i % n_classes}") for i in range(n_classes * 4)]
    assert rule(spark, rows, "string") == expected


def test_sketches_only_decide_clear_cases(spark):
    rows = [("ab"[i % 2], float(i)) for i in range(3000)]
    assert rule(spark, rows) == "id_like"
    near = [("ab"[i % 2], float(i % 2430)) for i in range(3000)]
    assert report(spark, near)["x"]["stat"] == pytest.approx(0.81)
    assert rule(spark, [("ab"[i % 2], float(i % 5)) for i in range(3000)]) is None


def test_first_rule_wins_and_names_are_sorted(spark):
    rows = [("a" if i < 10 else "b", f"u{i}", "p" if i < 10 else "q") for i in range(20)]
    frame = spark.createDataFrame(rows, "y string, z string, `a.b c` string")
    found = leak_report(frame, "y", "classification").collect()
    assert [(r["col"], r["rule"]) for r in found] == [("a.b c", "cat_value_maps_to_single_target"), ("z", "id_like")]


def test_distinct_counts_copy_no_rows(spark):
    rows = spark.range(1000).selectExpr("id AS a", "IF(id % 10 = 0, NULL, id % 7) AS b", "CAST(id % 3 AS STRING) AS c", "IF(id % 2 = 0, 0.0D, -0.0D) AS d", "NULL AS e")
    counts = profile.distinct_counts(rows, rows.columns)
    assert {r["col"]: r["n_unique"] for r in counts.collect()} == {"a": 1000, "b": 8, "c": 3, "d": 1, "e": 1}
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()
