import math

import pytest
from pyspark.sql import functions as F

from sparring.functions.keys import ROW_KEY, with_row_key
from sparring.operators.split import class_quotas, hash_digits, small_quotas, split


def counts(frame, *by):
    return {tuple(r[:-1]): r[-1] for r in frame.groupBy(*by).count().collect()}


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds half of the rows.
    label = F.when(F.col("id") % 2 == 0, "big").otherwise(F.concat(F.lit("c"), (F.col("id") % 14).cast("string")))
    return spark.range(2000).select("id", label.alias("y"), (F.col("id") % 7).cast("double").alias("x"))


def test_sizes_are_exact_and_every_class_is_on_both_sides(rows):
    found = counts(split(rows, "y", "classification", ["id"]), "y", "split")
    sizes = counts(rows, "y")
    assert sum(n for (_, side), n in found.items() if side == "test") == math.ceil(0.2 * 2000)
    for (label,), size in sizes.items():
        assert abs(found[label, "test"] - 0.2 * size) < 1
        assert found[label, "test"] + found[label, "train"] == size


def test_same_rows_under_any_partitioning_and_on_both_join_paths(rows):
    def test_ids(frame, **options):
        return {r[0] for r in split(frame, "y", "classification", ["id"], **options).where("split='test'").select("id").collect()}

    base = test_ids(rows)
    assert base == test_ids(rows.repartition(17, "x"))
    assert base == test_ids(rows, broadcast_strata=2)
    assert base != test_ids(rows, seed=7)


@pytest.mark.parametrize("n_test", [37, 55, 100])
def test_distributed_quotas_equal_the_local_ones(spark, n_test):
    sizes = {f"k{i}": 5 + i % 4 for i in range(40)}
    n = sum(sizes.values())
    frame = spark.createDataFrame(list(sizes.items()), "stratum string, n_rows long")
    found = {r["stratum"]: r["quota"] for r in class_quotas(frame, n, n_test, 42).collect()}
    assert found == small_quotas(sizes, n, n_test, 42)
    assert sum(found.values()) == n_test


def test_copies_get_distinct_keys_even_when_spread_over_blocks(spark):
    frame = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("v"))
    small = {r[0] for r in with_row_key(frame, in_place=10**6).select(ROW_KEY).collect()}
    blocks = with_row_key(frame, per_block=10)
    assert len(small) == 5000
    assert small == {r[0] for r in blocks.select(ROW_KEY).collect()}
    sizes = [r[1] for r in blocks.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.3 * 5000
    keyed = split(frame, "v", "regression")
    assert keyed.where("split = 'test'").count() == 1000


def test_null_and_empty_texts_have_different_keys(spark):
    frame = spark.createDataFrame([("", None), (None, ""), ("a|1", "b"), ("a", "1|b")], "x string, y string")
    assert with_row_key(frame).select(ROW_KEY).distinct().count() == 4


def test_bad_targets_are_refused(spark, rows):
    with pytest.raises(ValueError, match="not found"):
        split(rows, "missing", "classification", ["id"])
    with pytest.raises(ValueError, match="unknown task"):
        split(rows, "y", "ranking", ["id"])
    with pytest.raises(ValueError, match="NULL"):
        split(rows.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), "y", "classification", ["id"])
    with pytest.raises(ValueError, match="fewer than 2"):
        split(rows.withColumn("y", F.when(F.col("id") == 5, "lonely").otherwise("y")), "y", "classification", ["id"])
    with pytest.raises(ValueError, match="cannot cover"):
        split(rows.limit(20).withColumn("y", F.col("id") % 10), "y", "classification", ["id"])


def test_hash_digits_grow_with_the_table():
    assert hash_digits(100) == 1
    assert hash_digits(10**8) == 2
    assert hash_digits(10**13) == 6


def test_repeated_and_null_keys_split_exactly(spark):
    rows = [(i % 3, "ab"[i % 2], i) for i in range(1000)] + [(None, "ab"[i % 2], i) for i in range(50)]
    frame = spark.createDataFrame(rows, "id long, y string, cut_h long")
    for task in ("regression", "classification"):
        marked = split(frame, "y", task, ["id"]).cache()
        assert marked.count() == 1050
        assert marked.where("split = 'test'").count() == 210
        assert marked.select("row_key").distinct().count() == 4
        assert sorted(r[0] for r in split(frame, "y", task, ["id"]).where("split = 'test'").select("cut_h").collect()) == sorted(
            r[0] for r in marked.where("split = 'test'").select("cut_h").collect()
        )


def test_columns_may_be_called_like_the_joined_cutoffs(spark):
    frame = spark.createDataFrame([(i, i % 5, i, i) for i in range(200)], "id long, y int, stratum int, cut_key int")
    marked = split(frame, "y", "classification", ["id"], broadcast_strata=2)
    assert marked.where("split = 'test'").count() == 40
    assert marked.columns == ["id", "y", "stratum", "cut_key", "row_key", "split"]


def test_many_classes_of_which_one_holds_half_of_the_rows(spark):
    """60,000 classes: quotas are exact, and no task gets the rows of the large one."""
    i = F.col("id")
    frame = spark.range(400_000).select("id", F.when(i % 2 == 0, -1).otherwise((i - 1) / 2 % 60_000).cast("long").alias("y"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false"), ("spark.sql.shuffle.partitions", "16")):
        spark.conf.set(name, value)
    try:
        found = split(frame, "y", "classification", ["id"])
        sizes = sorted(r[1] for r in found.groupBy(F.spark_partition_id()).count().collect())
        tests = counts(found.where("split = 'test'"), "y")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(tests.values()) == 80_000 and tests[-1,] in (40_000, 40_001)
    assert sum(sizes) == 400_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert max(n for (y,), n in tests.items() if y >= 0) <= 1
