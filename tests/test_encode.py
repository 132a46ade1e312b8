import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import functions as F

from sparring.functions.keys import ROW_KEY
from sparring.functions.linalg import top_eigenvectors
from sparring.operators import encode, profile
from sparring.operators.encode import OneHot, Preprocessor, label_encode
from sparring.operators.split import SPLIT


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(400).select(
        i.cast("string").alias(ROW_KEY),
        F.when(i % 5 == 0, "test").otherwise("train").alias(SPLIT),
        (i % 9).cast("double").alias("size"),
        F.lit(4).alias("flat"),
        F.when(i % 10 == 0, None).otherwise(F.concat(F.lit("c"), (i % 3).cast("string"))).alias("color"),
        F.when(i % 5 == 0, (i % 40).cast("string")).otherwise((i % 37).cast("string")).alias("word"),
        (i % 2 == 0).alias("even"),
        ((i * 17) % 101 + 0.5).alias("y"),
    )


def test_whole_preprocessor_against_numpy(spark, table):
    fitted = Preprocessor(svd_components=200).fit(table, "y", "regression")
    # word has 37 categories of 320 rows, over 5 %: counted; color and even are one-hot and reduced.
    assert fitted.numeric == ["size"] and fitted.frequency == ["word"] and fitted.onehot.columns == ["color", "even"]
    assert [r["rule"] for r in fitted.report] == ["constant_overall"]
    local = table.toPandas()
    train = local[local["split"] == "train"]
    counts = train["word"].value_counts()
    words = local["word"].map(counts).fillna(0.0)
    columns = [local["size"], words]
    train_columns = [train["size"], train["word"].map(counts)]
    scaled = [(c - t.mean()) / t.std(ddof=0) for c, t in zip(columns, train_columns)]
    categories = [
        local["color"] == "c0", local["color"] == "c1", local["color"] == "c2", local["color"].isna(),
        ~local["even"], local["even"],
    ]
    if not train["color"].isna().any():
        categories.pop(3)
    block = np.stack(categories, 1).astype(float)
    gram = block[local["split"] == "train"].T @ block[local["split"] == "train"]
    _, vectors = top_eigenvectors(gram, 4)
    expected = np.column_stack([*scaled, block @ vectors])
    prepared = fitted.transform(table)
    assert prepared.n_features == expected.shape[1]
    rows = prepared.frame.select(F.col(ROW_KEY).cast("int"), vector_to_array("features")).orderBy(ROW_KEY).collect()
    found = {r[0]: r[1] for r in rows}
    assert np.allclose([found[int(k)] for k in local[ROW_KEY]], expected, atol=1e-8)


def test_onehot_null_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "v string")
    onehot = OneHot.fit(train, ["v"])
    seen = spark.createDataFrame([("a",), ("b",), (None,), ("new",), ("n",)], "v string")
    rows = onehot.encode(onehot.index(seen), "block").select("v", vector_to_array("block")).collect()
    assert {r[0]: r[1] for r in rows} == {
        "a": [1, 0, 0], "b": [0, 1, 0], None: [0, 0, 1], "new": [0, 0, 0], "n": [0, 0, 0],
    }
    without = OneHot.fit(train.na.drop(), ["v"])
    rows = without.encode(without.index(seen), "block").select("v", vector_to_array("block")).collect()
    assert {r[0]: r[1] for r in rows}[None] == [0, 0]


def test_frequency_paths_agree_with_hot_values(spark):
    i = F.col("id")
    frame = spark.range(3000).select(
        i.cast("string").alias(ROW_KEY),
        F.when(i % 3 == 0, "hot").when(i % 31 == 0, None).otherwise((i % 1500).cast("string")).alias("v"),
    )
    counts = encode.frequency_counts(frame.where(i < 2000), "v")

    def run(broadcast):
        out = encode.frequency_encode(frame, "v", counts, "f", 2000, broadcast)
        return {r[0]: r[1] for r in out.select(ROW_KEY, "f").collect()}

    shuffled, broadcast = run(False), run(True)
    # Without broadcast joins and adaptive plans the hot rows are still spread over the partitions.
    for setting, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(setting, value)
    try:
        out = encode.frequency_encode(frame, "v", counts, "f", 2000, False)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert run(False) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3000 and max(sizes) < 1000
    assert shuffled == broadcast and len(shuffled) == 3000
    assert set(frame.where("v is null").select(ROW_KEY).toPandas()[ROW_KEY]) <= {k for k, f in broadcast.items() if f == 0}


def test_no_text_is_shuffled_for_the_profile(spark):
    """Only names of columns, hashes and counts stand in the exchanges; equal texts of two columns stay apart."""
    rows = spark.range(200).selectExpr("repeat('long text ', 50) || id % 70 AS a", "IF(id % 3 = 0, NULL, 'long text ' || id % 2) AS b", "id % 2 AS y")
    found = profile.category_profile(rows, ["a", "b"], "y")
    routing = encode.cardinality_routing(found, 200)
    assert sorted(tuple(r) for r in routing.collect()) == [("a", 70, 70, "frequency"), ("b", 3, 2, "onehot")]
    plan = routing._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = [part.split("Input", 1)[1].split("\n")[0] for part in plan.split("\n\n") if ") Exchange" in part]
    names = {name.split("#")[0].strip() for line in exchanges for name in line.split(": [", 1)[1].split("]")[0].split(",")}
    assert names <= {"place", "hash", "count", "min", "max", "col", "n_unique", "n_categories"} and len(exchanges) >= 2




def test_scaling_of_constant_and_missing(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    stats = {r["col"]: r for r in encode.scale_stats(frame, ["a", "b"]).collect()}
    out = frame.select(*[encode.standardized(F.col(c), stats[c]["mean"], stats[c]["std"]) for c in "ab"]).collect()
    assert [tuple(r) for r in out] == [(0.0, -1.0), (0.0, None), (0.0, 1.0)]


def test_missing_numbers_are_refused_or_filled(table):
    holes = table.withColumn("size", F.when(F.col("size") != 3, F.col("size")))
    with pytest.raises(ValueError, match="missing values"):
        Preprocessor().fit(holes, "y", "regression")
    fitted = Preprocessor(missing="mean").fit(holes, "y", "regression")
    assert fitted.transform(holes).frame.where(vector_to_array("features")[0].isNull()).count() == 0


def test_no_usable_feature(table):
    with pytest.raises(ValueError, match="no usable features"):
        Preprocessor().fit(table.select(ROW_KEY, SPLIT, "y", "flat"), "y", "regression")


def test_svd_matches_the_distributed_decomposition(spark, table):
    train = table.where("split = 'train'")
    onehot = OneHot.fit(train, ["word", "color"])
    encoded = onehot.encode(onehot.index(train), "block")
    values, vectors = encode.fit_svd(onehot.index(train), onehot.positions(), onehot.width, 6)
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(encoded.select("block"), "block"))
    # The remaining values are equal to each other, where the iterative solver is not reliable.
    assert np.allclose(values[:3], matrix.computeSVD(3).s.toArray())
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-8)


def test_svd_of_many_categories(spark):
    """Of one column the squared singular values are the counts, whatever the width; nothing of the width squared exists."""
    counts = [20_000 // (r + 1) + 1 for r in range(20_000)]
    rows = spark.createDataFrame([(f"c{r:05d}", c) for r, c in enumerate(counts)], "word string, c int").selectExpr("word", "explode(sequence(1, c)) AS k")
    onehot = OneHot.fit(rows, ["word"])
    values, vectors = encode.fit_svd(onehot.index(rows), onehot.positions(), onehot.width, 20)
    assert onehot.width == 20_000 and vectors.shape == (20_000, 20)
    assert np.isclose((values**2).sum(), sum(counts[:20]), rtol=1e-7)
    assert np.allclose(values**2, counts[:20], rtol=1e-3)
    assert np.allclose(vectors.T @ vectors, np.eye(20), atol=1e-8)
    # Two columns: the first direction is shared, and all squares together are two for each row.
    both = rows.limit(3000).selectExpr("word", "CAST(k % 3 AS STRING) AS third")
    onehot = OneHot.fit(both, ["word", "third"])
    values, _ = encode.fit_svd(onehot.index(both), onehot.positions(), onehot.width, onehot.width)
    assert np.isclose((values**2).sum(), 2 * 3000)


def test_labels_follow_numbers_not_text(spark):
    frame = spark.createDataFrame([(10,), (2,), (33,)], "y long")
    classes = encode.class_labels(frame, "y")
    assert classes == [2, 10, 33]
    assert {r["y"]: r["label"] for r in label_encode(frame, "y", classes).collect()} == {2: 0, 10: 1, 33: 2}
    with pytest.raises(Exception, match="33"):
        label_encode(frame, "y", [2, 10]).collect()


def test_a_table_of_many_classes(spark):
    """150,000 classes are numbered in their order, encoded and decoded by joins."""
    rows = spark.range(300_000).select(((F.col("id") * 7919) % 150_000 - 75_000).alias("y"))
    classes = encode.class_table(rows, "y")
    edges = classes.where("place IN (0, 1, 149999)").orderBy("place").collect()
    assert [(r["place"], r["value"]) for r in edges] == [(0, -75_000), (1, -74_999), (149_999, 74_999)]
    encoded = encode.label_encode(rows, "y", classes)
    decoded = encode.label_decode_table(encoded, "label", classes, "again")
    assert decoded.where("y = again AND label = y + 75000").count() == 300_000
    texts = spark.createDataFrame([("b",), ("é",), ("B",), (None,), ("b",)], "y string")
    table = encode.class_table(texts, "y")
    assert [r["value"] for r in table.orderBy("place").collect()] == ["B", "b", "é"]
    with pytest.raises(Exception, match="no class"):
        encode.label_encode(texts, "y", table).collect()
    assert encode.class_table(texts.limit(0), "y").count() == 0
