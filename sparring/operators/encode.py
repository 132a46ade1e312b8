"""Turning columns into model features: routing, frequency counts, scaling, one-hot, reduction."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparring.functions.columns import categorical_columns, col, numeric_columns, per_column, require_column
from sparring.functions.keys import ROW_KEY, value_hash, with_row_key
from sparring.functions.linalg import fix_signs
from sparring.operators.leak import LeakThresholds, scan_leaks
from sparring.operators.profile import category_texts
from sparring.operators.split import SPLIT, TRAIN
from sparring.operators.task import CLASSIFICATION, check_task
from sparring.session import local_frame, materialize, release

ACTUAL = "actual"
LABEL = "label"
FEATURES = "features"

# Fixed default values: when a category column is too wide for one-hot, and the reduced width.
HIGH_CARDINALITY = 1000
HIGH_FRACTION = 0.05
SVD_COMPONENTS = 200
# Directions beyond those asked for, and when the range finder stops.
SVD_OVERSAMPLE, SVD_TOLERANCE = 10, 1e-10

# Count tables up to this many values (of 16 bytes and a count) are broadcast; larger ones are joined by shuffle.
BROADCAST_VALUES = 200_000
# Values holding at least this share of the rows are joined apart; at most 1000 values can.
HOT_SHARE = 0.001
HOT_SALTS = 1024


def class_table(df: DataFrame, target: str) -> DataFrame:
    """`place, value, text`: the distinct target values in their natural order, numbers by value, text by code point.

    Values are range-partitioned and numbered within their range; one count for each range passes through the driver.
    """
    value = col(target)
    found = df.select(value.alias("value"), value.cast("string").alias("text")).where(F.col("value").isNotNull()).distinct()
    ordered = found.repartitionByRange("value").sortWithinPartitions("value")
    numbered = materialize(
        ordered.select("value", "text", F.spark_partition_id().alias("part"), F.expr("monotonically_increasing_id() & 8589934591").alias("inner")), "classes"
    )
    counts = sorted((r["part"], r["count"]) for r in numbered.groupBy("part").count().collect())
    first, rows = 0, []
    for part, count in counts:
        rows.append((part, first))
        first += count
    starts = F.broadcast(local_frame(df.sparkSession, rows, "part int, first long"))
    return numbered.join(starts, "part").select((F.col("first") + F.col("inner")).alias("place"), "value", "text")


def class_labels(df: DataFrame, target: str) -> list:
    """The distinct target values in their natural order: numbers by value, text by code point."""
    return [value for value, _ in _labels_and_texts(df, target)]


def _labels_and_texts(df: DataFrame, target: str) -> list[tuple]:
    """Class values in order, each with its text as Spark renders it, which the indexer compares."""
    return [(r["value"], r["text"]) for r in class_table(df, target).orderBy("place").collect()]


def label_encode(df: DataFrame, target: str, classes: Sequence | DataFrame, output: str = LABEL) -> DataFrame:
    """Add the position of the target in `classes`, a list or a class table. An unseen value is an error that names it."""
    if isinstance(classes, DataFrame):
        return _joined_labels(df, target, classes, output)
    kind = df.schema[target].dataType
    if isinstance(kind, T.StringType):
        return _index_labels(df, target, list(classes), output)
    local = local_frame(df.sparkSession, list(enumerate(classes)), T.StructType(
        [T.StructField("place", T.LongType()), T.StructField("value", kind)]
    ))
    texts = [r["text"] for r in local.selectExpr("place", "CAST(value AS STRING) AS text").orderBy("place").collect()]
    return _index_labels(df, target, texts, output)


def _joined_labels(df: DataFrame, target: str, classes: DataFrame, output: str) -> DataFrame:
    table = classes.select(F.col("place").alias("__place"), F.col("value").alias("__value"))
    joined = df.join(table, col(target) == F.col("__value"), "left")
    unseen = F.raise_error(F.concat(F.lit("no class "), F.coalesce(col(target).cast("string"), F.lit("NULL")))).cast("double")
    return joined.withColumn(output, F.coalesce(F.col("__place").cast("double"), unseen)).drop("__place", "__value")


def label_decode_table(df: DataFrame, index: str, classes: DataFrame, output: str) -> DataFrame:
    """Add the class at the position in column `index`, by a join with the class table; NULL beyond it."""
    table = classes.select(F.col("place").alias("__place"), F.col("value").alias(output))
    return df.join(table, col(index).cast("long") == F.col("__place"), "left").drop("__place")


def _index_labels(df: DataFrame, target: str, texts: list[str], output: str) -> DataFrame:
    indexer = StringIndexerModel.from_labels(
        texts, inputCol="__label_text", outputCol=output, handleInvalid="error"
    )
    return indexer.transform(df.withColumn("__label_text", col(target).cast("string"))).drop("__label_text")


def label_decode(index: Column, classes: Sequence) -> Column:
    """The class at a position."""
    return F.array(*[F.lit(c) for c in classes])[index.cast("int")]


def cardinality_routing(
    profile: DataFrame, n_train: int, high_cardinality: int = HIGH_CARDINALITY, high_fraction: float = HIGH_FRACTION
) -> DataFrame:
    """`col, n_unique, n_categories, route`: `'frequency'` for wide category columns, else `'onehot'`."""
    n_unique = F.count(F.lit(1))
    wide = (F.col("n_unique") > high_cardinality) | (F.col("n_unique") > high_fraction * n_train)
    return (
        profile.groupBy("col")
        .agg(n_unique.alias("n_unique"), F.count("hash").alias("n_categories"))
        .withColumn("route", F.when(wide, "frequency").otherwise("onehot"))
    )


def svd_width(routing: DataFrame, svd_components: int = SVD_COMPONENTS) -> DataFrame:
    """One row `total_unique, n_components, mode` for the one-hot block."""
    total = F.coalesce(F.sum("n_categories"), F.lit(0))
    width = F.least(F.lit(svd_components), F.greatest(F.lit(2), F.col("total_unique") - 1))
    return (
        routing.where(F.col("route") == "onehot")
        .agg(total.alias("total_unique"))
        .withColumn("n_components", width.cast("long"))
        .withColumn("mode", F.when(F.col("total_unique") <= F.col("n_components"), "onehot").otherwise("svd"))
    )


def frequency_counts(train: DataFrame, column: str) -> DataFrame:
    """`hash, n_rows` of the non-NULL values in the training rows."""
    return (
        train.where(col(column).isNotNull())
        .groupBy(value_hash(col(column)).alias("hash"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def fits_broadcast(n_values: int) -> bool:
    """Whether a count table is small enough to travel to every task; its rows have a fixed size."""
    return n_values <= BROADCAST_VALUES


def frequency_encode(
    df: DataFrame, column: str, counts: DataFrame, output: str, n_rows: int, broadcast: bool
) -> DataFrame:
    """Replace a value by its training count; 0.0 for unseen values and NULL.

    Values are joined by their 128-bit hash, which keeps long texts out of the shuffle. A count table that
    `fits_broadcast` is broadcast. Otherwise values holding over HOT_SHARE of the training rows (fewer
    than 1/HOT_SHARE by arithmetic) are broadcast, and the rest is joined by shuffle
    with the hot rows scattered over salts that match nothing, so no task gets a hot value.
    """
    key = value_hash(col(column))
    if broadcast:
        table = F.broadcast(counts.select(F.col("hash").alias("__v"), F.col("n_rows").alias("__n")))
        joined = df.join(table, key == F.col("__v"), "left")
        return joined.withColumn(output, F.coalesce(F.col("__n"), F.lit(0)).cast("double")).drop("__v", "__n")

    edge = HOT_SHARE * n_rows
    hashed = counts.select(F.col("hash").alias("__v"), F.col("n_rows").alias("__n"))
    hot = hashed.where(F.col("__n") > edge).select(F.col("__v").alias("__hv"), F.col("__n").alias("__hn"))
    cold = hashed.where(F.col("__n") <= edge)
    # The salt is part of the key text: as a column of its own the optimizer would fold it out of the join key.
    salt = F.concat(F.lit("~"), F.pmod(F.xxhash64(F.col(ROW_KEY)), F.lit(HOT_SALTS)).cast("string")).cast("binary")
    apart = F.col("__hn").isNotNull() | F.col("__k").isNull()
    marked = (
        df.withColumn("__k", key)
        .join(F.broadcast(hot), F.col("__k") == F.col("__hv"), "left")
        .withColumn("__ck", F.when(apart, salt).otherwise(F.col("__k")))
    )
    joined = marked.join(cold, F.col("__ck") == F.col("__v"), "left")
    value = F.coalesce(F.col("__hn"), F.col("__n"), F.lit(0)).cast("double")
    return joined.withColumn(output, value).drop("__k", "__hv", "__hn", "__ck", "__v", "__n")


def scale_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`col, n_rows, n_values, mean, std` (population deviation; NULLs ignored)."""
    return per_column(
        train,
        columns,
        {
            "n_values": "count({c})",
            "mean": "avg(CAST({c} AS DOUBLE))",
            "std": "stddev_pop(CAST({c} AS DOUBLE))",
        },
    )


def standardized(column: Column, mean: float, std: float) -> Column:
    """(x - mean) / std, with a zero deviation replaced by 1; NULL stays NULL."""
    return (column.cast("double") - F.lit(float(mean or 0.0))) / F.lit(float(std) if std else 1.0)


@dataclass
class OneHot:
    """Fitted one-hot block: sorted categories per column, NULL last when training had NULLs."""

    columns: list[str]
    categories: list[list[str]]
    null_seen: list[bool]
    _encoder: OneHotEncoderModel | None = field(default=None, repr=False)

    # The indexer takes no NULL, so values are written with a prefix that NULL lacks.
    NULL_LABEL = "n"
    PREFIX = "v"

    @property
    def widths(self) -> list[int]:
        return [len(c) + int(n) for c, n in zip(self.categories, self.null_seen)]

    @property
    def width(self) -> int:
        return sum(self.widths)

    @staticmethod
    def fit(rows: DataFrame, columns: Sequence[str]) -> OneHot:
        """From the training rows; routing bounds the categories of each column."""
        found: dict[str, set] = {c: set() for c in columns}
        for r in category_texts(rows, columns).collect():
            found[r["col"]].add(r["value"])
        return OneHot(list(columns), [sorted(found[c] - {None}) for c in columns], [None in found[c] for c in columns])

    def _index_names(self) -> list[str]:
        return [f"__i{i}" for i in range(len(self.columns))]

    def index(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Add one index column per category column; unseen values get the index past the last."""
        texts = [f"__t{i}" for i in range(len(self.columns))]
        for name, text in zip(columns or self.columns, texts):
            df = df.withColumn(text, F.coalesce(F.concat(F.lit(self.PREFIX), col(name).cast("string")), F.lit(self.NULL_LABEL)))
        labels = [
            [self.PREFIX + c for c in found] + [self.NULL_LABEL] * int(null)
            for found, null in zip(self.categories, self.null_seen)
        ]
        for labelled, text, index in zip(labels, texts, self._index_names()):
            indexer = StringIndexerModel.from_labels(labelled, inputCol=text, outputCol=index, handleInvalid="keep")
            df = indexer.transform(df)
        return df.drop(*texts)

    def positions(self) -> list[Column]:
        """Per category column the 0-based position in the block; `width` where the value is unseen."""
        out, offset = [], 0
        for name, width in zip(self._index_names(), self.widths):
            out.append(F.when(F.col(name) < width, (F.col(name) + offset).cast("int")).otherwise(self.width))
            offset += width
        return out

    def encode(self, indexed: DataFrame, output: str) -> DataFrame:
        """Add the sparse 0/1 block. The 'unseen' slot is the last one, which dropLast leaves out."""
        outputs = [f"__o{i}" for i in range(len(self.columns))]
        if self._encoder is None:
            self._encoder = OneHotEncoder(
                inputCols=self._index_names(), outputCols=outputs, dropLast=True, handleInvalid="error"
            ).fit(indexed)
        assembled = VectorAssembler(inputCols=outputs, outputCol=output).transform(self._encoder.transform(indexed))
        return assembled.drop(*outputs)


def co_occurrences(positions: Sequence[Column], width: int, indexed: DataFrame) -> DataFrame:
    """`i, j, n`: how many rows hold the categories at two positions of the block (i <= j); unseen values hold none.

    The Gram matrix of the block, of which only cells that occur exist; pairs are counted before the shuffle.
    """
    places = F.filter(F.array(*positions), lambda p: p < width)
    after = lambda x, k: F.transform(F.slice(places, k + 1, F.size(places)), lambda y: F.struct(x.alias("i"), y.alias("j")))
    pairs = indexed.select(F.explode(F.flatten(F.transform(places, after))).alias("p"))
    return pairs.groupBy("p.i", "p.j").agg(F.count(F.lit(1)).alias("n"))


def fit_svd(
    indexed: DataFrame, positions: Sequence[Column], width: int, k: int, oversample: int = SVD_OVERSAMPLE, tolerance: float = SVD_TOLERANCE, seed: int = 42
) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and vectors of the uncentred one-hot block: `k` clamped to its width, and those of rank only.

    A randomized range finder: a block of k + `oversample` directions is multiplied by the Gram matrix and made orthonormal by
    a tall-skinny QR again and again, until the sum of the k largest Ritz values stays the same to `tolerance`. The Gram
    matrix is a table of its non-empty cells, made in one scan of the rows; the driver and each task hold width times
    block numbers. If the block is as wide as the matrix, one product gives the exact result.
    """
    spark, k = indexed.sparkSession, min(k, width)
    size = min(width, k + oversample)
    cells = co_occurrences(positions, width, indexed)
    both = cells.select("i", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))).alias("c"), "n")
    # A row of the matrix has at most `width` cells.
    lines = both.groupBy("c.i").agg(F.collect_list(F.struct("c.j", F.col("n").cast("double").alias("n"))).alias("cells"))
    lines = materialize(lines.select("i", F.col("cells.j").alias("js"), F.col("cells.n").alias("ns")), "gram")

    def product(block: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [
                    (np.frombuffer(ns.values.buffers()[1], np.float64)[ns.values.offset :][: len(ns.values)] @ sent.value[js.values.to_numpy()]).tobytes()
                    for js, ns in zip(batch.column(1), batch.column(2))
                ]
                yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["i", "z"])

        out = np.zeros((width, block.shape[1]))
        for row in lines.mapInArrow(run, "i int, z binary").toLocalIterator():
            out[row["i"]] = np.frombuffer(bytes(row["z"]))
        sent.unpersist()
        return out

    block, last = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0], -1.0
    while True:
        moved = product(block)
        ritz = block.T @ moved
        values, turned = np.linalg.eigh((ritz + ritz.T) / 2)
        total = float(values[::-1][:k].sum())
        if size == width or abs(total - last) <= tolerance * abs(total):
            break
        last, block = total, np.linalg.qr(moved)[0]
    release(lines)
    values, vectors = np.sqrt(np.maximum(values[::-1][:k], 0.0)), (block @ turned)[:, ::-1][:, :k]
    known = values > 1e-6 * values.max(initial=0.0)
    return values[known], fix_signs(vectors[:, known])


def project_one_hot(vectors: np.ndarray, positions: Sequence[Column]) -> Column:
    """One-hot row times `vectors`, as array<double>: the sum of the rows its positions select."""
    table = np.vstack([vectors, np.zeros((1, vectors.shape[1]))])

    @F.arrow_udf("array<double>")
    def project(*cols: pa.Array) -> pa.Array:
        total = sum(table[c.to_numpy(zero_copy_only=False)] for c in cols)
        offsets = np.arange(len(total) + 1, dtype=np.int32) * table.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(total.ravel()))

    return project(*positions)


@dataclass
class Prepared:
    """A transformed table `row_key, split, actual, label, features` and what it was made from."""

    frame: DataFrame
    target: str
    task: str
    classes: list | None
    n_features: int
    n_train: int


@dataclass
class FittedPreprocessor:
    target: str
    task: str
    report: list
    numeric: list[str]
    frequency: list[str]
    arrays: list[str]
    array_widths: list[int]
    counts: dict[str, DataFrame]
    broadcast: dict[str, bool]
    n_train: int
    stats: dict[str, tuple[float, float]]
    onehot: OneHot | None
    vectors: np.ndarray | None
    singular_values: np.ndarray | None
    classes: list | None
    class_texts: list[str] | None
    missing: str
    key_cols: tuple[str, ...] = ()
    staged: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Delete the staged tables that `counts` reads; only for one that is stored elsewhere."""
        release(*self.staged)

    @property
    def n_features(self) -> int:
        block = 0 if self.onehot is None else self.onehot.width if self.vectors is None else self.vectors.shape[1]
        return len(self.numeric) + len(self.frequency) + sum(self.array_widths) + block

    def transform(self, df: DataFrame) -> Prepared:
        """The split table, with its target, as features and labels."""
        out = self._features(df, [F.col(SPLIT), col(self.target).alias("__actual")])
        if self.task == CLASSIFICATION:
            out = _index_labels(out, "__actual", self.class_texts, LABEL)
        else:
            out = out.withColumn(LABEL, F.col("__actual").cast("double"))
        frame = out.select(ROW_KEY, SPLIT, F.col("__actual").alias(ACTUAL), LABEL, FEATURES)
        return Prepared(frame, self.target, self.task, self.classes, self.n_features, self.n_train)

    def transform_new(self, df: DataFrame) -> DataFrame:
        """`row_key, features` of rows that have neither target nor split, for fitted models to score."""
        return self._features(with_row_key(df, self.key_cols), [])

    def _features(self, df: DataFrame, extra: list[Column]) -> DataFrame:
        """`row_key`, the `extra` columns and the features."""
        # Inside, source columns go by position so that no column name can clash.
        inputs = [*self.numeric, *self.frequency]
        block = self.onehot.columns if self.onehot else []
        out = df.select(
            F.col(ROW_KEY),
            *extra,
            *[col(c).alias(f"__x{i}") for i, c in enumerate(inputs)],
            *[array_to_vector(col(a).cast("array<double>")).alias(f"__a{i}") for i, a in enumerate(self.arrays)],
            *[col(c).alias(f"__c{i}") for i, c in enumerate(block)],
        )
        keep = out.columns[: 1 + len(extra)]
        for i, name in enumerate(inputs):
            if i >= len(self.numeric):
                out = frequency_encode(
                    out, f"__x{i}", self.counts[name], f"__x{i}", self.n_train, self.broadcast[name]
                )
        scaled = []
        for i, name in enumerate(inputs):
            value = standardized(F.col(f"__x{i}"), *self.stats[name])
            scaled.append((F.coalesce(value, F.lit(0.0)) if self.missing == "mean" else value).alias(f"__x{i}"))
        arrays = [f"__a{i}" for i in range(len(self.arrays))]
        parts = [f"__x{i}" for i in range(len(inputs))] + arrays
        out = out.select(*keep, *scaled, *arrays, *[f"__c{i}" for i in range(len(block))])
        if self.onehot:
            out = self.onehot.index(out, [f"__c{i}" for i in range(len(block))])
            if self.vectors is None:
                out = self.onehot.encode(out, "__block")
            else:
                out = out.withColumn(
                    "__block", array_to_vector(project_one_hot(self.vectors, self.onehot.positions()))
                )
            parts.append("__block")
        out = VectorAssembler(inputCols=parts, outputCol=FEATURES, handleInvalid="error").transform(out)
        return out.select(*keep, FEATURES)


@dataclass
class Preprocessor:
    """Fits the whole feature pipeline on the training rows of a split table."""

    high_cardinality: int = HIGH_CARDINALITY
    high_fraction: float = HIGH_FRACTION
    svd_components: int = SVD_COMPONENTS
    thresholds: LeakThresholds = LeakThresholds()
    missing: str = "error"
    key_cols: Sequence[str] = ()
    array_cols: Sequence[str] = ()

    def fit(self, df: DataFrame, target: str, task: str) -> FittedPreprocessor:
        require_column(df, target)
        check_task(task)
        if self.missing not in ("error", "mean"):
            raise ValueError("missing must be 'error' or 'mean'")
        train = df.where(F.col(SPLIT) == TRAIN)
        aside = {ROW_KEY, SPLIT, target, *self.key_cols}
        numeric, categorical = numeric_columns(df, aside), categorical_columns(df, aside)
        scan = scan_leaks(train, target, task, numeric + categorical, self.thresholds)
        report = scan.findings
        dropped = {r["col"] for r in report}
        numeric = [c for c in numeric if c not in dropped]
        categorical = [c for c in categorical if c not in dropped]
        if not numeric and not categorical and not self.array_cols:
            raise ValueError(f"no usable features; dropped: {[(r['col'], r['reason']) for r in report]}")

        stats = {}
        n_train = None
        if numeric:
            rows = [scan.moments[c] for c in numeric]
            n_train = rows[0]["n_rows"]
            stats = {r["col"]: (r["mean"], r["std"]) for r in rows}
            lacking = [r["col"] for r in rows if r["n_values"] < r["n_rows"]]
            if lacking and self.missing == "error":
                raise ValueError(f"missing values in {lacking}; fill them or pass missing='mean'")
        if scan.classes is not None:
            n_train = sum(r["n_rows"] for r in scan.classes)
        elif n_train is None:
            n_train = train.count()

        frequency, counts, broadcast, onehot, vectors, singular = [], {}, {}, None, None, None
        if categorical:
            profile = scan.profile.where(col("col").isin(categorical))
            routing = cardinality_routing(profile, n_train, self.high_cardinality, self.high_fraction)
            routes = {r["col"]: r for r in routing.collect()}
            frequency = [c for c in categorical if routes[c]["route"] == "frequency"]
            normal = [c for c in categorical if routes[c]["route"] == "onehot"]
            sums = _power_sums(profile.where(col("col").isin(frequency))) if frequency else {}
            for name in frequency:
                stats[name] = _frequency_stats(sums[name], n_train)
                broadcast[name] = fits_broadcast(routes[name]["n_categories"])
                counts[name] = profile.where((col("col") == name) & col("hash").isNotNull()).select("hash", "n_rows")
            if normal:
                total = sum(routes[c]["n_categories"] for c in normal)
                k = min(self.svd_components, max(2, total - 1))
                onehot = OneHot.fit(train, normal)
                if total > k:
                    singular, vectors = fit_svd(onehot.index(train), onehot.positions(), onehot.width, k)
        widths = [train.select(F.max(F.size(col(a)))).first()[0] for a in self.array_cols]
        labels = None
        if task == CLASSIFICATION:
            known = scan.classes and [(r["value"], r["text"]) for r in scan.classes]
            labels = sorted(known or _labels_and_texts(train, target))
        return FittedPreprocessor(
            target, task, report, numeric, frequency, list(self.array_cols), widths, counts, broadcast, n_train,
            stats, onehot, vectors, singular, labels and [v for v, _ in labels], labels and [t for _, t in labels],
            self.missing, tuple(self.key_cols), (scan.profile,) if scan.profile is not None else (),
        )


def _power_sums(profile: DataFrame) -> dict:
    """Per column the exact sums of n^2 and n^3 over its values' counts n."""
    n = "CAST(n_rows AS DECIMAL(12,0))"
    sums = profile.where("hash IS NOT NULL").groupBy("col").agg(
        F.expr(f"sum({n} * {n}) AS s2"), F.expr(f"sum({n} * {n} * {n}) AS s3")
    )
    return {r["col"]: r for r in sums.collect()}


def _frequency_stats(sums, n_train: int) -> tuple[float, float]:
    """Mean and population deviation of an encoded training column.

    A value with count n is on n rows, so the first two moments are the sums of n^2 and n^3;
    NULL rows add zeros. Whole numbers keep the variance exact before its root.
    """
    s2, s3 = int(sums["s2"]), int(sums["s3"])
    return s2 / n_train, ((n_train * s3 - s2 * s2) / n_train**2) ** 0.5
