"""Exact, reproducible train/test split without ordering the data."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparring.functions.columns import col, require_column
from sparring.functions.keys import ROW_KEY, seeded_hash, value_hash, with_row_key
from sparring.operators.task import CLASSIFICATION, check_task
from sparring.session import local_frame, materialize, release

SPLIT = "split"
TRAIN = "train"
TEST = "test"

# One cutoff row per stratum travels to every task; beyond this many strata Spark joins by shuffle.
BROADCAST_STRATA = 50_000

# Up to this many cutoffs are written into the expression instead of being joined.
INLINE_STRATA = 16

# Rows that one hash bucket should hold at most; decides how finely the hash is bucketed.
ROWS_PER_BUCKET = 50_000

# Classes with at least this share of the rows (at most 1000) are joined apart; salts over which their rows are scattered.
HOT_SHARE = 0.001
HOT_SALTS = 1024


def split(
    df: DataFrame,
    target: str,
    task: str,
    key_cols: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    broadcast_strata: int = BROADCAST_STRATA,
) -> DataFrame:
    """Add `row_key` and `split`; exactly ceil(test_size * n) rows are `'test'`.

    Classification is stratified by the target: every class gets the floor of its share and
    the largest remainders get the rows left over. In each stratum the rows with the smallest
    seeded hash of the key are the test rows. Only a histogram of hash prefixes is
    needed to find where the test rows end, so the data itself is never sorted or shuffled.
    """
    require_column(df, target)
    stratified = check_task(task) == CLASSIFICATION
    if key_cols:
        rows = with_row_key(df, key_cols)
        marked = _marked(rows, target, stratified, test_size, seed, broadcast_strata)
        if marked is not None:
            return marked
    # Content keys cost a shuffle of whole rows, so they are made once. They also decide between rows of one given
    # key where the test rows would end among them.
    rows = materialize(with_row_key(df), "keyed")
    marked = _marked(rows, target, stratified, test_size, seed, broadcast_strata)
    return with_row_key(marked.drop(ROW_KEY), key_cols).select(*rows.columns, SPLIT) if key_cols else marked


def _marked(
    rows: DataFrame, target: str, stratified: bool, test_size: float, seed: int, broadcast_strata: int
) -> DataFrame | None:
    """`rows` with their part, or None if a repeated key stands where the test rows end."""
    keyed = rows.select(
        (col(target) if stratified else F.lit(0)).alias("stratum"),
        F.col(ROW_KEY),
        seeded_hash(F.col(ROW_KEY), seed).alias("h"),
    )
    cutoffs, hot = _cutoffs_for(keyed, stratified, test_size, seed, broadcast_strata)
    edges = cutoffs.limit(broadcast_strata + 1).collect()
    few = len(edges) <= broadcast_strata
    if any(e["tied"] for e in edges) or not few and not cutoffs.where("tied").isEmpty():
        return None
    # The hash has a fixed length, so hash and key order like their concatenation.
    place = F.concat(seeded_hash(F.col(ROW_KEY), seed), F.col(ROW_KEY))
    if len(edges) <= min(INLINE_STRATA, broadcast_strata):
        cut = F.lit(None).cast("string")
        for e in edges:
            mine = F.lit(True) if not stratified else col(target) == F.lit(e["stratum"])
            cut = F.when(mine, F.lit(e["cut_h"] + e["cut_key"])).otherwise(cut)
        return rows.withColumn(SPLIT, F.when(place <= cut, TEST).otherwise(TRAIN))
    if few:
        cutoffs = F.broadcast(local_frame(rows.sparkSession, edges, cutoffs.schema))
        cutoffs = cutoffs.select(F.col("stratum").alias("__stratum"), F.concat("cut_h", "cut_key").alias("__cut"))
        marked = rows.join(cutoffs, col(target) == F.col("__stratum"), "left")
        return marked.withColumn(SPLIT, F.when(place <= F.col("__cut"), TEST).otherwise(TRAIN)).drop("__stratum", "__cut")
    # Classes go by hash. The few that hold many rows are broadcast, and their rows scattered over salts that match nothing.
    cutoffs = materialize(cutoffs.select(value_hash(F.col("stratum")).alias("__v"), F.concat("cut_h", "cut_key").alias("__cut")), "cutoffs")
    hashes = local_frame(rows.sparkSession, [(h,) for h in hot], "__v binary")
    often = cutoffs.join(F.broadcast(hashes), "__v", "left_semi").select(F.col("__v").alias("__hv"), F.col("__cut").alias("__hcut"))
    seldom = cutoffs.join(F.broadcast(hashes), "__v", "left_anti")
    salt = F.concat(F.lit("~"), F.pmod(F.xxhash64(F.col(ROW_KEY)), F.lit(HOT_SALTS)).cast("string")).cast("binary")
    joined = (
        rows.withColumn("__k", value_hash(col(target)))
        .join(F.broadcast(often), F.col("__k") == F.col("__hv"), "left")
        .withColumn("__ck", F.when(F.col("__hv").isNotNull(), salt).otherwise(F.col("__k")))
        .join(seldom, F.col("__ck") == F.col("__v"), "left")
    )
    part = F.when(place <= F.coalesce("__hcut", "__cut"), TEST).otherwise(TRAIN)
    return joined.withColumn(SPLIT, part).drop("__k", "__hv", "__hcut", "__ck", "__v", "__cut")


def _cutoffs_for(
    keyed: DataFrame, stratified: bool, test_size: float, seed: int, broadcast_strata: int
) -> tuple[DataFrame, list[bytes]]:
    """The last test row of each stratum, and the hashes of strata with over HOT_SHARE of the rows if there are many strata."""
    counts = keyed.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_rows"))
    head = counts.limit(broadcast_strata + 1).collect()
    few = len(head) <= broadcast_strata
    if few:
        sizes = [r["n_rows"] for r in head]
        n, strata, smallest = sum(sizes), len(sizes), min(sizes, default=0)
        has_null = any(r["stratum"] is None for r in head)
    else:
        counts = materialize(counts, "class-sizes")
        n, strata, smallest, has_null = counts.agg(
            F.sum("n_rows"), F.count(F.lit(1)), F.min("n_rows"), F.bool_or(F.col("stratum").isNull())
        ).first()
    if has_null:
        raise ValueError("the target has NULLs; drop those rows before splitting")
    n_test = math.ceil(test_size * n)
    if n_test == 0 or n_test >= n:
        raise ValueError(f"cannot split {n} rows with test_size={test_size}")
    if stratified:
        if smallest < 2:
            raise ValueError("the least populated class has fewer than 2 rows, too few for a stratified split")
        if min(n_test, n - n_test) < strata:
            raise ValueError(f"{n_test} test and {n - n_test} train rows cannot cover {strata} classes")
    if few:
        quotas = small_quotas({r["stratum"]: r["n_rows"] for r in head}, n, n_test, seed)
        schema = T.StructType([keyed.schema["stratum"], T.StructField("quota", T.LongType())])
        wanted = local_frame(keyed.sparkSession, list(quotas.items()), schema)
        return hash_cutoffs(keyed, wanted, hash_digits(n), few), []
    hot = counts.where(F.col("n_rows") > HOT_SHARE * n).select(value_hash(F.col("stratum")).alias("h")).collect()
    cutoffs = materialize(hash_cutoffs(keyed, class_quotas(counts, n, n_test, seed), hash_digits(n), few), "cutoffs")
    release(counts)
    return cutoffs, [bytes(r["h"]) for r in hot]


def small_quotas(counts: dict, n: int, n_test: int, seed: int) -> dict:
    """Test rows per class: floors plus largest remainders, ties by the seeded hash of the class."""
    quotas = {c: n_test * size // n for c, size in counts.items()}
    left_over = n_test - sum(quotas.values())

    def place(c):
        text = str(c).lower() if isinstance(c, bool) else str(c)
        return -(n_test * counts[c] % n), hashlib.md5(f"{text}|{seed}".encode()).hexdigest()

    for c in sorted(counts, key=place)[:left_over]:
        quotas[c] += 1
    return quotas


def hash_digits(n: int) -> int:
    """Hex digits of the hash to bucket by, so that a bucket holds about ROWS_PER_BUCKET rows."""
    return max(1, int(math.log(max(n / ROWS_PER_BUCKET, 1), 16)))


def class_quotas(counts: DataFrame, n: int, n_test: int, seed: int) -> DataFrame:
    """`small_quotas` for any number of classes: `stratum, quota` from `stratum, n_rows`."""
    share = F.lit(n_test).cast("decimal(19,0)") * F.col("n_rows").cast("decimal(19,0)")
    shares = counts.select("stratum", share.alias("share")).select(
        "stratum",
        F.expr(f"share div {n}").cast("long").alias("base"),
        F.expr(f"share % {n}").cast("long").alias("rest"),
        seeded_hash(F.col("stratum"), seed).alias("h"),
    )
    left_over = n_test - shares.agg(F.sum("base")).first()[0]
    if left_over == 0:
        return shares.select("stratum", F.col("base").alias("quota"))
    # Classes of equal size have equal remainders, so there are at most sqrt(2n) remainders.
    running = Window.orderBy(F.desc("rest")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        shares.groupBy("rest")
        .agg(F.count(F.lit(1)).alias("classes"))
        .withColumn("upto", F.sum("classes").over(running))
        .where((F.col("upto") >= left_over) & (F.col("upto") - F.col("classes") < left_over))
        .first()
    )
    take = left_over - (last["upto"] - last["classes"])
    if take == last["classes"]:
        gets_one = F.col("rest") >= last["rest"]
    else:
        tied = shares.where(F.col("rest") == last["rest"]).select(
            F.lit(0).alias("stratum"), F.col("stratum").cast("string").alias(ROW_KEY), "h"
        )
        one = tied.sparkSession.range(1).select(
            F.lit(0).alias("stratum"), F.lit(take).cast("long").alias("quota")
        )
        edge = hash_cutoffs(tied, one, hash_digits(last["classes"]), True).first()
        within = (F.col("h") < edge["cut_h"]) | (
            (F.col("h") == edge["cut_h"]) & (F.col("stratum").cast("string") <= edge["cut_key"])
        )
        gets_one = (F.col("rest") > last["rest"]) | ((F.col("rest") == last["rest"]) & within)
    return shares.select("stratum", (F.col("base") + gets_one.cast("long")).alias("quota"))


def hash_cutoffs(rows: DataFrame, quotas: DataFrame, digits: int, broadcast: bool) -> DataFrame:
    """For each stratum the `quota`-th row in (h, row_key) order, as `stratum, cut_h, cut_key`; `tied` if the next
    row has the same key.

    A histogram of hash prefixes (at most 16^digits rows per stratum) names the bucket that
    holds the wanted row; only the rows of that bucket are ranked.
    """
    hint = F.broadcast if broadcast else (lambda frame: frame)
    bucket = F.substring("h", 1, digits).alias("bucket")
    running = Window.partitionBy("stratum").orderBy("bucket")
    last_bucket = (
        rows.groupBy("stratum", bucket)
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("upto", F.sum("size").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(hint(quotas), "stratum")
        .where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("size") < F.col("quota")))
        .select("stratum", "bucket", (F.col("quota") - F.col("upto") + F.col("size")).alias("take"))
    )
    ranking = Window.partitionBy("stratum").orderBy("h", ROW_KEY)
    return (
        rows.withColumn("bucket", bucket)
        .join(hint(last_bucket), ["stratum", "bucket"])
        .withColumn("rank", F.row_number().over(ranking))
        .withColumn("tied", F.coalesce(F.lead(ROW_KEY).over(ranking) == F.col(ROW_KEY), F.lit(False)))
        .where(F.col("rank") == F.col("take"))
        .select("stratum", F.col("h").alias("cut_h"), F.col(ROW_KEY).alias("cut_key"), "tied")
    )
