"""A corpus pipeline of five stages over `documents`: language ID, line dedup, n-gram Jaccard join, decontamination, BPE.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that its predecessor kept; `run` writes each
stage's result as Parquet to the staging folder and reads it again. All but the last return the columns of documents.

Rows of null id or null text are treated as each operator says: a null text has no language and goes in the first
stage; of rows of null id none is compared with others, so they are kept by the later filters.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparring.llm import bpe, decontaminate, jaccard_join, language_id, line_dedup
from sparring.llm.common import bound_batches, table
from sparring.session import staging_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with `lang` as predicted from all labelled ones. What has no letter goes."""
    bound_batches(spark)
    named = language_id.identify(docs, language_id.fit(docs, F.col("doc_id").isNotNull())).where(F.col("lang_pred") != language_id.UNKNOWN)
    return named.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines repeated elsewhere; one that loses all its lines stays, with an empty text."""
    bound_batches(spark)
    left = line_dedup.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of smallest id."""
    bound_batches(spark)
    return jaccard_join.keep_smallest(docs).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no item of `benchmark`."""
    bound_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives the text back."""
    bound_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, decoded_col="decoded")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("restored"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding and decoding", tokens),
]

#: Language ID and the iterative components have no SQL form; stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
