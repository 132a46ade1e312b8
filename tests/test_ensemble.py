import pytest
from pyspark.sql import functions as F

from sparring.operators.ensemble import align_scores, mean_vote, one_hot_scores, soft_vote, vote_decision


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def scores(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_alignment_cases(spark):
    assert value(spark, align_scores(scores(0.2, 0.8), ["b", "a"], ["a", "b"])) == [0.8, 0.2]
    assert value(spark, align_scores(scores(0.2, 0.8), ["b", "x"], ["a", "b"])) == [0.0, 0.2]
    assert value(spark, align_scores(scores(0.3), ["b"], ["a", "b"])) == [0.7, 0.3]
    assert value(spark, align_scores(scores(0.3, 0.7), None, ["a", "b"], width=2)) == [0.3, 0.7]
    assert value(spark, align_scores(scores(0.3, 0.7), None, ["a", "b", "c"], width=2)) == [0.5, 0.5, 0.5]
    assert value(spark, align_scores(scores(1, 2), [2, 10], [2, 10])) == [1.0, 2.0]


def test_votes(spark):
    a, b = scores(0.25, 0.75), scores(0.75, 0.25)
    assert value(spark, soft_vote([a])) == [0.25, 0.75]
    assert value(spark, soft_vote([a, b])) == [0.5, 0.5]
    assert value(spark, soft_vote([a, b], [3, 1])) == [0.375, 0.625]
    assert value(spark, mean_vote([F.lit(1.0), F.lit(4.0)])) == 2.5
    assert value(spark, mean_vote([F.lit(1.0), F.lit(4.0)], [2, 1])) == 2.0
    # Ties go to the first class.
    assert value(spark, vote_decision(soft_vote([a, b]), ["x", "y"])) == "x"
    assert value(spark, one_hot_scores(F.lit("y"), ["x", "y"])) == [0.0, 1.0]
    assert value(spark, one_hot_scores(F.lit("z"), ["x", "y"])) == [0.0, 0.0]


def test_nothing_to_combine_and_wrong_weights(spark):
    with pytest.raises(ValueError, match="nothing"):
        soft_vote([])
    with pytest.raises(ValueError, match="2 weights for 1 models"):
        mean_vote([F.lit(1.0)], [1, 2])
