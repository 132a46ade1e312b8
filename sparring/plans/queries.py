"""Named runs of every operator over the standard tables; `oracle.py` has their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparring.functions.columns import (
    categorical_columns,
    clean_missing,
    col,
    numeric_columns,
    per_column,
    split_target,
    to_number,
)
from sparring.functions.keys import ROW_KEY
from sparring.operators import encode, leak, profile
from sparring.operators.encode import FEATURES, LABEL, OneHot, Prepared, Preprocessor, label_encode
from sparring.operators.ensemble import (
    align_scores,
    ensemble_cost,
    explode_scores,
    mean_vote,
    one_hot_scores,
    soft_vote,
    vote_decision,
)
from sparring.operators.metrics import classification_metrics, regression_metrics, roc_auc
from sparring.operators.models import best_class, train, two_class_decision
from sparring.operators.split import SPLIT, TEST, TRAIN, split
from sparring.operators.task import CLASSIFICATION, REGRESSION, infer_tasks
from sparring.plans.experiment import prepare, run_experiment
from sparring.plans.pipeline_store import Pipeline, load_pipeline, save_pipeline
from sparring.plans.registry import CLASSIFICATION_MODELS, REGRESSION_MODELS
from sparring.plans.report import display, leaderboard, prediction_table, totals
from sparring.session import local_frame, staging_path
from sparring.sources.exports import save_ensemble, save_predictions, saved_size
from sparring.sources.tables import (
    preview,
    read_catalog_table,
    read_csv_table,
    read_parquet_table,
    single_column,
)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STATUSES = ["F", "O", "P"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, f"{sf_dir}/{name}.parquet")


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that engines adding in another order agree."""
    return frame.select(
        *[F.round(col(n), digits).alias(n) if t == "double" else col(n) for n, t in frame.dtypes]
    )


# --- sources and columns ---


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as text with missing-value tokens, read back with inferred types."""
    path = staging_path(spark, "csv")
    size = F.when(F.col("p_size") % 10 == 0, "NA").otherwise(F.col("p_size").cast("string"))
    table(spark, sf_dir, "part").withColumn("p_size", size).write.option("header", True).csv(path)
    return read_csv_table(spark, path)


@query
def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and commas, written as CSV and read back."""
    path = staging_path(spark, "csv")
    words = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('", '), "p_type").alias("words")
    table(spark, sf_dir, "part").select("p_partkey", words).write.option("header", True).option("escape", '"').csv(path)
    return read_csv_table(spark, path)


@query
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "supplier").createOrReplaceTempView("sparring_supplier")
    return read_catalog_table(spark, "sparring_supplier")


@query
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "customer"), order_by=["c_custkey"])


@query
def target_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_column(table(spark, sf_dir, "orders"), "o_orderstatus")


@query
def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_target(table(spark, sf_dir, "customer"), "c_mktsegment")[0]


@query
def column_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    kinds = {c: "numeric" for c in numeric_columns(rows)} | {c: "categorical" for c in categorical_columns(rows)}
    counts = per_column(rows, list(kinds), {"n_values": "count({c})"})
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    return counts.select("col", F.when(F.col("col").isin(numeric), "numeric").otherwise("categorical").alias("kind"),
                         "n_values")


@query
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.drop_columns(table(spark, sf_dir, "supplier"), ["s_name", "absent"])


@query
def task_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [(t, c, task) for t in TABLES for c, task in infer_tasks(table(spark, sf_dir, t)).items()]
    return local_frame(spark, found, "table_name string, column_name string, task string")


@query
def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", mixed.alias("mixed"))
    return rows.select("o_orderkey", to_number(rows, "mixed").alias("number"))


# --- split ---


def _part_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(table(spark, sf_dir, "part"), "p_retailprice", REGRESSION, ["p_partkey"])


def _orders_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(table(spark, sf_dir, "orders"), "o_orderstatus", CLASSIFICATION, ["o_orderkey"])


@query
def split_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_split(spark, sf_dir).select("p_partkey", SPLIT)


@query
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_split(spark, sf_dir).select("o_orderkey", "o_orderstatus", SPLIT)


@query
def split_many_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified by supplier of lineitem, where most remainders are tied or close."""
    rows = table(spark, sf_dir, "orders").withColumn("bucket", F.col("o_custkey") % 97)
    return split(rows, "bucket", CLASSIFICATION, ["o_orderkey"]).select("o_orderkey", "bucket", SPLIT)


@query
def split_content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key and with many copies."""
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    return split(rows, "l_quantity", REGRESSION)


# --- leak rules ---


def _leaky_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_linenumber",
        F.when(flag == "R", F.col("l_tax")).alias("only_r"),
        F.lit(7).alias("always_seven"),
        (2 * F.col("l_quantity") + F.col("l_discount")).alias("twice_quantity"),
        F.when(flag == "A", 1).otherwise(F.col("l_linenumber")).alias("flat_in_a"),
        F.when(flag == "R", F.col("l_quantity")).otherwise(0.0).alias("zero_but_r"),
        F.when(flag == "R", 3.0).otherwise(F.col("l_quantity")).alias("floor_in_r"),
        F.concat("l_returnflag", "l_linestatus").alias("flag_and_status"),
    )


LEAKY_NUMERIC = [
    "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_linenumber",
    "only_r", "always_seven", "twice_quantity", "flat_in_a", "zero_but_r", "floor_in_r",
]


@query
def leak_id_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _leaky_lineitem(spark, sf_dir)
    return rounded(leak.id_like(rows, [*LEAKY_NUMERIC, "l_linestatus", "flag_and_status"]))


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _leaky_lineitem(spark, sf_dir)
    return profile.class_gaps(profile.summaries(rows, LEAKY_NUMERIC, ["l_linestatus"], strata="l_returnflag"))


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_moments(profile.summaries(_leaky_lineitem(spark, sf_dir), LEAKY_NUMERIC[1:], target="l_quantity"))


@query
def leak_presence_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(leak.presence_diff(_gaps(spark, sf_dir)))


@query
def leak_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.constant_overall(_moments(spark, sf_dir)).select("col", "rule")


@query
def leak_high_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(leak.high_corr(_moments(spark, sf_dir)))


@query
def target_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = _moments(spark, sf_dir)
    return rounded(moments.select("col", "n_values", "low", "high", "corr"))


@query
def leak_constant_within_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _leaky_lineitem(spark, sf_dir)
    return leak.constant_within_class(rows, "l_returnflag", _gaps(spark, sf_dir)).select("col", "rule", "reason")


@query
def leak_zero_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(leak.zero_fraction_diff(_gaps(spark, sf_dir)))


@query
def class_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_gaps(spark, sf_dir).drop("minimum_gap"))


@query
def leak_min_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(leak.min_value_presence_diff(_gaps(spark, sf_dir)))


@query
def leak_cat_single_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = profile.category_profile(
        _leaky_lineitem(spark, sf_dir), ["l_linestatus", "flag_and_status"], "l_returnflag"
    )
    return profile.single_target_columns(categories)


@query
def leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules on the training rows of orders, with one planted column per rule."""
    status, key = F.col("o_orderstatus"), F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice", "o_orderpriority",
        F.when(status == "O", key % 7).alias("only_o"),
        F.when(status == "F", 5).otherwise(key % 11).alias("flat_in_f"),
        F.when(status == "F", (key % 50 == 0).cast("int")).otherwise(key % 5 + 1).alias("zero_in_f"),
        F.when(status == "F", F.when(key % 40 == 0, 3).otherwise(2)).otherwise(key % 50 + 2).alias("floor_in_f"),
        F.concat(status, (key % 10).cast("string")).alias("status_code"),
    )
    train_rows = split(rows, "o_orderstatus", CLASSIFICATION, ["o_orderkey"]).where(F.col(SPLIT) == TRAIN)
    columns = [c for c in rows.columns if c not in ("o_orderkey", "o_orderstatus")]
    return rounded(leak.leak_report(train_rows, "o_orderstatus", CLASSIFICATION, columns))


# --- encoders ---


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return labels.join(documents, "doc_id")


@query
def cardinality_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled_documents(spark, sf_dir)
    return encode.cardinality_routing(profile.category_profile(rows, ["lang", "source", "text"]), rows.count())


@query
def frequency_encode_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part_split(spark, sf_dir)
    train_rows = rows.where(F.col(SPLIT) == TRAIN)
    counts = encode.frequency_counts(train_rows, "p_brand")
    broadcast = encode.fits_broadcast(counts.count())
    encoded = encode.frequency_encode(rows, "p_brand", counts, "frequency", train_rows.count(), broadcast)
    return encoded.select("p_partkey", "frequency")


@query
def frequency_encode_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled form with hot values set apart, forced although the table is small."""
    rows = _orders_split(spark, sf_dir).withColumn(
        "word", F.when(F.col("o_custkey") % 3 == 0, "hot").otherwise(F.col("o_custkey").cast("string"))
    )
    train_rows = rows.where(F.col(SPLIT) == TRAIN)
    counts = encode.frequency_counts(train_rows, "word")
    encoded = encode.frequency_encode(rows, "word", counts, "frequency", train_rows.count(), broadcast=False)
    return encoded.select("o_orderkey", "frequency")


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = {r["col"]: r for r in encode.scale_stats(rows, names).collect()}
    scaled = [encode.standardized(col(c), stats[c]["mean"], stats[c]["std"]).alias(c) for c in names]
    return rounded(rows.select("l_orderkey", "l_linenumber", *scaled))


@query
def onehot_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training NULLs get their own column; a value seen only in the test rows is all zeros."""
    key = F.col("o_custkey")
    value = F.when(key % 17 == 0, None).when((key % 13 == 0) & (F.col(SPLIT) == TEST), "9-NEW").otherwise(
        F.col("o_orderpriority")
    )
    rows = _orders_split(spark, sf_dir).withColumn("priority", value)
    onehot = OneHot.fit(rows.where(F.col(SPLIT) == TRAIN), ["priority"])
    encoded = onehot.encode(onehot.index(rows), "block").withColumn("block", vector_to_array("block"))
    return encoded.select("o_orderkey", *[F.col("block")[i].cast("int").alias(f"c{i}") for i in range(onehot.width)])


@query
def svd_width_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part")
    categories = profile.category_profile(rows, ["p_name", "p_brand", "p_type"])
    return encode.svd_width(encode.cardinality_routing(categories, rows.count()))


def _part_onehot(spark: SparkSession, sf_dir: str) -> tuple[OneHot, DataFrame]:
    rows = table(spark, sf_dir, "part")
    onehot = OneHot.fit(rows, ["p_brand", "p_type"])
    return onehot, onehot.index(rows)


@query
def svd_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    onehot, indexed = _part_onehot(spark, sf_dir)
    names = [f"{c}={v}" for c, values in zip(onehot.columns, onehot.categories) for v in values]
    place = {side: local_frame(spark, list(enumerate(names)), f"{side} int, {name} string") for side, name in (("i", "first"), ("j", "second"))}
    cells = encode.co_occurrences(onehot.positions(), onehot.width, indexed)
    return cells.join(place["i"], "i").join(place["j"], "j").select("first", "second", "n")


@query
def svd_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part row projected on all singular vectors that the width rule keeps, which loses nothing of a row."""
    onehot, indexed = _part_onehot(spark, sf_dir)
    categories = profile.category_profile(table(spark, sf_dir, "part"), ["p_brand", "p_type"])
    # Both columns are in the block, so both count for its width.
    routed = encode.cardinality_routing(categories, indexed.count(), high_fraction=1.0)
    k = encode.svd_width(routed).first()["n_components"]
    singular, vectors = encode.fit_svd(indexed, onehot.positions(), onehot.width, k)
    length = F.aggregate("c", F.lit(0.0), lambda a, x: a + x * x)
    return rounded(
        indexed.withColumn("c", encode.project_one_hot(vectors, onehot.positions())).select(
            "p_partkey", length.alias("square_length"), F.lit(float((singular**2).sum())).alias("square_sum")
        )
    )


@query
def label_encode_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    classes = encode.class_table(rows, "c_nationkey")
    encoded = label_encode(rows, "c_nationkey", classes)
    decoded = encode.label_decode_table(encoded, LABEL, classes, "decoded")
    return decoded.select("c_custkey", F.col(LABEL).cast("int").alias("label"), "decoded")


@query
def sequence_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as vectors and back to sequences, one row per step."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", encode.array_to_vector(F.col("embedding").cast("array<double>")).alias(FEATURES)
    )
    steps = rows.select("vec_id", F.posexplode(vector_to_array(FEATURES, "float32")).alias("step", "value"))
    return rounded(steps.withColumn("value", F.col("value").cast("double")))


@query
def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preprocessor: a scaled number and a one-hot block, fitted on the training rows."""
    price = F.when(F.col("o_totalprice") < 200_000, "cheap").otherwise("dear")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", price.alias("price"))
    prepared, _ = prepare(rows, "o_orderstatus", CLASSIFICATION, ["o_orderkey"])
    features = vector_to_array(FEATURES)
    return rounded(
        prepared.frame.select(
            F.col(ROW_KEY).cast("long").alias("o_orderkey"), SPLIT, F.col(LABEL).cast("int").alias(LABEL),
            *[features[i].alias(f"f{i}") for i in range(3)],
        )
    )


# --- ensembles over models that SQL can replay: class shares and group means ---


def _scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with three frequency models: P(status | group) as arrays in class order.

    The groups have 5, 7 and 11 values, so each model is a table of a few rows.
    """
    orders = table(spark, sf_dir, "orders")
    shares = ", ".join(f"count_if(o_orderstatus = '{s}') / count(1)" for s in STATUSES)
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    for output, group in (("a", "o_orderpriority"), ("b", "o_custkey % 7"), ("c", "o_custkey % 11")):
        model = orders.groupBy(F.expr(f"{group} AS g_{output}")).agg(F.expr(f"array({shares}) AS {output}"))
        rows = rows.join(F.broadcast(model), F.expr(group) == F.col(f"g_{output}")).drop(f"g_{output}")
    return rows


def _wide(rows: DataFrame, scores: str, prefix: str) -> list[Column]:
    return [F.round(F.col(scores)[i], 6).alias(f"{prefix}_{s}") for i, s in enumerate(STATUSES)]


@query
def hard_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_orders(spark, sf_dir)
    two = two_class_decision(F.array(1 - F.col("b")[1], F.col("b")[1]))
    return rows.select("o_orderkey", best_class(F.col("b")).alias("best"), two.alias("from_threshold"))


@query
def onehot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_orders(spark, sf_dir)
    hard = rows.withColumn("p", one_hot_scores(vote_decision(F.col("b"), STATUSES), STATUSES))
    return explode_scores(hard, ["o_orderkey"], "p", STATUSES)


@query
def align_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reordered with a missing and an excess class; one score for two classes; no class list."""
    b = F.col("b")
    rows = _scored_orders(spark, sf_dir).select(
        "o_orderkey",
        align_scores(F.array(b[2], b[1], b[0]), ["P", "X", "F"], STATUSES).alias("mapped"),
        align_scores(F.array(b[1]), ["O"], ["other", "O"]).alias("expanded"),
        align_scores(F.array(b[0], b[1]), None, STATUSES, width=2).alias("spread"),
    )
    return rows.select(
        "o_orderkey", *_wide(rows, "mapped", "mapped"),
        F.round(F.col("expanded")[0], 6).alias("rest"), F.round(F.col("expanded")[1], 6).alias("only"),
        *_wide(rows, "spread", "spread"),
    )


@query
def soft_vote_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = _scored_orders(spark, sf_dir).withColumn("v", soft_vote([F.col("a"), F.col("b"), F.col("c")]))
    return voted.select("o_orderkey", *_wide(voted, "v", "v"), vote_decision(F.col("v"), STATUSES).alias("decision"))


@query
def soft_vote_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col("a"), F.col("b"), F.col("c")]
    voted = _scored_orders(spark, sf_dir).withColumn("v", soft_vote(columns, [3, 2, 1]))
    return voted.select("o_orderkey", *_wide(voted, "v", "v"))


def _predicted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("o_totalprice")
    )
    priced = rows
    for output, group in (("m1", "o_orderpriority"), ("m2", "o_custkey % 7"), ("m3", "o_custkey % 11")):
        model = priced.groupBy(F.expr(f"{group} AS g_{output}")).agg(F.expr(f"avg(o_totalprice) AS {output}"))
        rows = rows.join(F.broadcast(model), F.expr(group) == F.col(f"g_{output}")).drop(f"g_{output}")
    return rows


@query
def mean_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    vote = mean_vote([F.col("m1"), F.col("m2"), F.col("m3")])
    return rounded(_predicted_orders(spark, sf_dir).select("o_orderkey", vote.alias("prediction")), 4)


@query
def mean_regression_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    vote = mean_vote([F.col("m1"), F.col("m2")], [3, 1])
    return rounded(_predicted_orders(spark, sf_dir).select("o_orderkey", vote.alias("prediction")), 4)


def _derived_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run rows computed from lineitem: one 'model' per line number."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").cast("string").alias("model")).agg(
        F.round(F.sum("l_tax"), 2).alias("train_time"), F.sum("l_orderkey").cast("long").alias("model_size")
    )


@query
def ensemble_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_suppkey") % 5 <= F.col("l_linenumber"))
        .select((F.col("l_suppkey") % 5).cast("string").alias("ensemble"),
                F.col("l_linenumber").cast("string").alias("model"))
        .distinct()
    )
    return rounded(ensemble_cost(_derived_runs(spark, sf_dir), members), 4)


# --- metrics and reports ---


@query
def classification_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_orders(spark, sf_dir)
    predictions = {m: vote_decision(F.col(m), STATUSES) for m in ("a", "b", "c")}
    return rounded(classification_metrics(rows, "o_orderstatus", predictions))


@query
def ranking_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous score, a score with many ties, and one score for all rows."""
    rows = table(spark, sf_dir, "orders")
    scores = {
        "continuous": F.col("o_totalprice"), "tied": (F.col("o_custkey") % 10).cast("double"),
        "constant": F.lit(0.5),
    }
    return rounded(roc_auc(rows, F.col("o_orderstatus") == "F", scores))


@query
def regression_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _predicted_orders(spark, sf_dir)
    return rounded(regression_metrics(rows, "o_totalprice", {m: F.col(m) for m in ("m1", "m2", "m3")}), 4)


def _board(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _predicted_orders(spark, sf_dir)
    metrics = regression_metrics(rows, "o_totalprice", {str(i): F.col(f"m{i}") for i in (1, 2, 3)})
    runs = _derived_runs(spark, sf_dir).withColumn("place", F.col("model").cast("int"))
    return leaderboard(runs, metrics, REGRESSION)


@query
def leaderboard_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = display(_board(spark, sf_dir), REGRESSION)
    return shown.withColumnsRenamed({"Model": "model_name", "train_time(s)": "train_seconds"})


@query
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(totals(_board(spark, sf_dir)), 4)


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _predicted_orders(spark, sf_dir)
    models = {"By priority": F.col("m1"), "By customer + priority": mean_vote([F.col("m1"), F.col("m2")])}
    return rounded(prediction_table(rows, "o_orderkey", "o_totalprice", models))


@query
def prediction_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparison(spark, sf_dir)


@query
def prediction_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "predictions")
    save_predictions(_comparison(spark, sf_dir), path)
    return read_csv_table(spark, path)


# --- models ---


@query
def ols_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias(LABEL), "l_quantity", F.lit(TRAIN).alias(SPLIT)
    )
    frame = VectorAssembler(inputCols=["l_quantity"], outputCol=FEATURES).transform(rows)
    model = train("linear_regression", Prepared(frame, LABEL, REGRESSION, None, 1, 0)).model
    fit = [(float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))]
    return rounded(local_frame(spark, fit, "slope double, intercept double, r2 double"), 4)


def _priced_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 1000).alias("price"), (F.col("o_custkey") % 100).alias("customer")
    )


@query
def ols_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, scale, fit and predict the test rows with one feature, which SQL can replay."""
    options = Preprocessor(thresholds=leak.LeakThresholds(id_like_numeric=False))
    result = run_experiment(
        _priced_customers(spark, sf_dir), "price", ["Linear Regression"], key_cols=["o_orderkey"], preprocessor=options
    )
    return rounded(result.predictions.withColumnsRenamed({"Linear Regression": "prediction", "Actual": "actual"}), 5)


@query
def ols_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of that experiment."""
    result = run_experiment(
        _priced_customers(spark, sf_dir), "price", ["Linear Regression"], key_cols=["o_orderkey"]
    )
    return rounded(result.leaderboard.select("model", "mse", "rmse", "mae", "r2"), 4)


def _classification_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled_documents(spark, sf_dir).drop("text", "toxic")


def _single(name: str, make_input, target: str, task: str, key: str):
    """Train one model; return its test-row outputs with the actual values."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared, _ = prepare(make_input(spark, sf_dir), target, task, [key])
        model = train(name, prepared)
        scored = model.score(prepared.frame.where(F.col(SPLIT) == TEST), "output")
        if task == REGRESSION:
            return scored.select(ROW_KEY, "actual", F.col("output").alias("prediction"))
        decided = encode.label_decode(model.decision(F.col("output")), prepared.classes)
        return scored.select(ROW_KEY, "actual", decided.alias("prediction"), F.array_max("output").alias("proba"))

    return run


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


_DOCS = (_classification_input, "quality", CLASSIFICATION, "doc_id")
_PART = (_parts, "p_retailprice", REGRESSION, "p_partkey")
QUERIES["logistic_regression_outputs"] = _single("logistic_regression", *_DOCS)
QUERIES["random_forest_outputs"] = _single("random_forest", *_DOCS)
QUERIES["mlp_outputs"] = _single("mlp", *_DOCS)
QUERIES["linear_regression_outputs"] = _single("linear_regression", *_PART)
QUERIES["random_forest_regressor_outputs"] = _single("random_forest_regressor", *_PART)


def _without_nets(models: dict[str, tuple[str, ...]]) -> list[str]:
    """The selectable names whose components are all fitted by Spark's own library."""
    return [name for name, parts in models.items() if not set(parts) & {"cnn", "lstm", "mlp_regressor"}]


@query
def planted_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifiers and their votes on a class that is a threshold on one feature: all must find it."""
    digit = F.col("p_size") % 10
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", digit.cast("double").alias("digit"), F.when(digit < 5, "low").otherwise("high").alias("grade")
    )
    names = _without_nets(CLASSIFICATION_MODELS)
    result = run_experiment(rows, "grade", names, key_cols=["p_partkey"], max_models=None)
    return result.predictions.select(
        "row_key", F.col("Actual").alias("actual"), *[col(m).alias(f"m{i}") for i, m in enumerate(names)]
    )


@query
def planted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regressors and their mean on a sum of two flags, which each of them can represent."""
    one, two = (F.col("p_size") % 2).cast("double"), (F.col("p_size") % 3 == 0).cast("double")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", one.alias("one"), two.alias("two"), (10 + 3 * one + 5 * two).alias("worth")
    )
    names = _without_nets(REGRESSION_MODELS)
    result = run_experiment(rows, "worth", names, task=REGRESSION, key_cols=["p_partkey"], max_models=None)
    return rounded(
        result.predictions.select(
            "row_key", F.col("Actual").alias("actual"), *[col(m).alias(f"m{i}") for i, m in enumerate(names)]
        ),
        4,
    )


@query
def score_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows without target and split, prepared and scored by what was fitted on the labelled ones."""
    one, two = (F.col("p_size") % 2).cast("double"), (F.col("p_size") % 3 == 0).cast("double")
    rows = table(spark, sf_dir, "part").select("p_partkey", one.alias("one"), two.alias("two"))
    labelled = rows.withColumn("worth", 10 + 3 * F.col("one") + 5 * F.col("two"))
    result = run_experiment(labelled, "worth", ["Linear Regression"], task=REGRESSION, key_cols=["p_partkey"])
    features = result.preprocessor.transform_new(rows)
    return rounded(result.fitted["linear_regression"].score(features, "prediction").select(ROW_KEY, "prediction"), 4)


@query
def reload_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines of both tasks are saved and loaded; all rows are scored without target, and compared with the saved ones."""
    one, two = (F.col("p_size") % 2).cast("double"), (F.col("p_size") % 3 == 0).cast("double")
    rows = table(spark, sf_dir, "part").select("p_partkey", one.alias("one"), two.alias("two"), "p_brand")
    worth = rows.withColumn("worth", 10 + 3 * F.col("one") + 5 * F.col("two"))
    digit = F.col("p_size") % 10
    grade = table(spark, sf_dir, "part").select("p_partkey", digit.cast("double").alias("digit"), F.when(digit < 5, "low").otherwise("high").alias("grade"))
    runs = (
        (worth, "worth", ["Linear Regression", "Random Forest Regressor"]),
        (grade, "grade", ["Logistic Regression", "Random Forest Classifier"]),
    )
    out = None
    for labelled, target, names in runs:
        options = Preprocessor(high_cardinality=10)  # brands go by frequency
        result = run_experiment(labelled, target, names, key_cols=["p_partkey"], preprocessor=options, task=REGRESSION if target == "worth" else CLASSIFICATION)
        path = staging_path(spark, "pipeline")
        saved = Pipeline(result.preprocessor, result.fitted)
        save_pipeline(spark, saved, path)
        loaded, new = load_pipeline(spark, path), labelled.drop(target)
        before, after = saved.scores(new), loaded.scores(new)
        outputs = [c for c in after.columns if c != ROW_KEY]
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in outputs]
        compared = before.alias("x").join(after.alias("y"), ROW_KEY).select(ROW_KEY, reduce(Column.__and__, same).alias(f"same_{target}"))
        predicted = loaded.predict(new, names).join(compared, ROW_KEY)
        renamed = predicted.select(ROW_KEY, *[col(m).alias(f"{target}_{i}") for i, m in enumerate(names)], f"same_{target}")
        out = renamed if out is None else out.join(renamed, ROW_KEY)
    return rounded(out, 4)


@query
def all_classification_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of the singles and ensembles fitted by Spark's own library, on labelled documents."""
    names = _without_nets(CLASSIFICATION_MODELS)
    result = run_experiment(
        _classification_input(spark, sf_dir), "quality", names, key_cols=["doc_id"], max_models=None
    )
    return result.leaderboard.drop("train_time", "model_size", "model_path", "extra")


@query
def all_regression_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _without_nets(REGRESSION_MODELS)
    result = run_experiment(_parts(spark, sf_dir), "p_retailprice", names, key_cols=["p_partkey"], max_models=None)
    return result.leaderboard.drop("train_time", "model_size", "model_path", "extra")


@query
def model_save_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, _ = prepare(_parts(spark, sf_dir), "p_retailprice", REGRESSION, ["p_partkey"])
    model = train("linear_regression", prepared)
    path = staging_path(spark, "model")
    size = model.save(prepared.frame, path)
    same = size == saved_size(spark, path) and size > 0
    return local_frame(spark, [(model.name, same)], "model string, size_is_listed boolean")


@query
def ensemble_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ensemble's description with metrics from orders, written as JSON and read back."""
    rows = _predicted_orders(spark, sf_dir).withColumn("m", mean_vote([F.col("m1"), F.col("m2")]))
    row = regression_metrics(rows, "o_totalprice", {"both": F.col("m")}).first()
    path = staging_path(spark, "ensemble")
    save_ensemble(
        spark,
        {"ensemble_name": "both", "method": "mean_average", "components": ["m1", "m2"], "mae": round(row["mae"], 4)},
        path,
    )
    read = spark.read.schema("ensemble_name string, method string, components array<string>, mae double").json(path)
    return read.select("ensemble_name", "method", F.array_join("components", ",").alias("components"), "mae")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict a line's price from its other numbers: split, leak rules, scaling, fit, metrics."""
    rows = clean_missing(table(spark, sf_dir, "lineitem")).select(
        "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber"
    )
    return run_experiment(rows, "l_extendedprice", ["Linear Regression"]).leaderboard
