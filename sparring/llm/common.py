"""Helpers shared by the corpus operators: bounded slices of Arrow batches, word hashes, folds, session settings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparring.session import materialize

#: Text bytes that a step inside a task holds at once; a longer text makes a slice of its own.
SLICE_BYTES = 4 << 20
#: Rows of an Arrow batch between Spark and Python.
ARROW_ROWS = 1024


def bound_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches at ARROW_ROWS rows in this session: whole texts are large, and each batch is buffered twice."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts (column number `text`) have about `limit` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text."""
    return column.cast(pa.binary()).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. `bytes.split()` cuts at exactly the ASCII white space [\\x20\\x09-\\x0D]."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, so that every bit of the result depends on every bit of `x`."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """One 64-bit hash for each run of `width` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for k in range(width):
        out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mixed(out)


def fold(doc_id: Column, of: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo `of`; the fold of a null id is null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


#: Classes up to which their counts are broadcast.
BROADCAST_CLASSES = 100_000


def hash_sample(rows: DataFrame, class_col: str, per_class: int | None = None, total: int = 0, least: int = 1) -> DataFrame:
    """At most `per_class` rows (or an equal share of `total`, but `least`) of each class, with `turn`, their place in the class.

    The order is that of a hash of doc_id. Rows are thinned by the hash to about twice the wanted number before they
    are ranked, so that ranking a class never takes more. Every class takes part.
    """
    steps = 1 << 20
    counts = materialize(rows.groupBy(class_col).count(), "class-counts")
    classes = counts.count()
    each = per_class or max(least, total // max(1, classes))
    cuts = counts.select(class_col, F.least(F.lit(steps), F.expr(f"{2 * each * steps} div count + 64")).alias("_cut"))
    kept = rows.join(F.broadcast(cuts) if classes <= BROADCAST_CLASSES else cuts, class_col).where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(steps)) < F.col("_cut")).drop("_cut")
    order = F.xxhash64(F.lit(5), "doc_id"), F.col("doc_id")
    turn = F.row_number().over(Window.partitionBy(class_col).orderBy(F.pmod(order[0], F.lit(steps)), *order))
    return kept.withColumn("turn", turn).where(F.col("turn") <= each)


def labelled_ids(labels: DataFrame, label_col: str, learn: Column, per_class: int) -> DataFrame:
    """At most `per_class` (doc_id, label) of each class 0 and 1; of several labels of one id the largest counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & learn)
    one = known.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    return hash_sample(one, "label", per_class).select("doc_id", "label")
