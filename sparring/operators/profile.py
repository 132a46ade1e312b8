"""Small statistics of columns, classes and categories that the leak rules and encoders read."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparring.functions.columns import col, per_column, to_number
from sparring.functions.keys import value_hash
from sparring.session import local_frame

# A HyperLogLog sketch of 2^12 registers has a standard error of 1.6 %; it is trusted when it is at
# least six of them away from the threshold. The hash gives NULL a value of its own.
SKETCH = "hll_sketch_estimate(hll_sketch_agg(xxhash64({c}), 12))"
SKETCH_BAND = 0.1


def distinct_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`col, n_unique`: distinct values of many columns, NULL counting as one, in one aggregation over (column, hash).

    Values go by 128 bits, so that rows are not copied for each column; tasks drop their own repeats before the shuffle.
    """
    cells = [
        F.struct(F.lit(i).alias("place"), F.xxhash64(col(c)).alias("one"), F.xxhash64(F.lit(1), col(c)).alias("two"))
        for i, c in enumerate(columns)
    ]
    distinct = rows.select(F.explode(F.array(*cells)).alias("c")).select("c.*").distinct()
    names = local_frame(rows.sparkSession, list(enumerate(columns)), "place int, col string")
    return distinct.groupBy("place").agg(F.count(F.lit(1)).alias("n_unique")).join(F.broadcast(names), "place").select("col", "n_unique")


def uniqueness(rows: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """`col, n_rows, n_unique, unique_frac`, NULL counting as one value.

    A sketch, which shuffles a few kilobytes per column, is enough for columns clearly below the
    threshold, which no report shows. All others are counted exactly, whatever the size of the table.
    """
    sketch = per_column(rows, columns, {"n_unique": SKETCH})
    estimates = sketch.select("n_rows", "col", "n_unique").collect()
    low = threshold * (1 - SKETCH_BAND)

    def count(r) -> bool:
        return r["n_unique"] / max(r["n_rows"], 1) >= low

    counted = local_frame(rows.sparkSession, [tuple(r) for r in estimates if not count(r)], sketch.schema)
    exact = {r["col"]: r["n_rows"] for r in estimates if count(r)}
    if exact:
        known = local_frame(rows.sparkSession, [(n, c) for c, n in exact.items()], "n_rows long, col string")
        counted = counted.union(known.join(distinct_counts(rows, list(exact)), "col").select(counted.columns))
    return counted.selectExpr("col", "n_rows", "n_unique", "n_unique / n_rows AS unique_frac")


#: Sums of one (class, column): all of them add up when summaries are merged. Those from `pairs` on are over rows
#: where the column and the target number are both present; values are shifted by about their mean.
SUMS = ("present", "zeros", "s1", "s2", "pairs", "px", "py", "pxx", "pyy", "pxy")
SUMMARY = (
    ", n_rows long, col string, low struct<d: double, l: long>, n_low long, high struct<d: double, l: long>, "
    "shift double, present long, zeros long, s1 double, s2 double, pairs long, px double, py double, pxx double, "
    "pyy double, pxy double"
)
#: Rows from which the shift of each column is taken.
SHIFT_ROWS = 100


class Accumulator:
    """Summaries of the rows of one task, by class and column; a class's rows of a batch are one segment."""

    def __init__(self, names: Sequence[str], n_numeric: int, shifts: Sequence[float], y_shift: float):
        self.names, self.n_numeric, self.shifts, self.y_shift = names, n_numeric, shifts, y_shift
        self.classes: dict = {}
        self.rows: list[int] = []
        self.cells: list[list[dict]] = []

    def add(self, batch: pa.RecordBatch) -> None:
        coded = batch.column(0).dictionary_encode(null_encoding="encode")
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        sizes = np.diff([*starts, len(order)])
        values = coded.dictionary.to_pylist()
        owners = [self._class(values[c]) for c in codes[order][starts].tolist()]
        for owner, size in zip(owners, sizes.tolist()):
            self.rows[owner] += size
        y, y_valid = self._numbers(batch.column(1), order, 0.0)
        y = np.where(y_valid, y - self.y_shift, 0.0)
        add = lambda x: np.add.reduceat(x, starts).tolist()
        for k in range(len(self.names)):
            column = batch.column(2 + k)
            if k >= self.n_numeric:
                for owner, present in zip(owners, add(column.is_valid().to_numpy(zero_copy_only=False)[order].astype(np.int64))):
                    self.cells[owner][k]["present"] += present
                continue
            x, valid = self._numbers(column, order, 0)
            whole = x.dtype.kind == "i"
            top, bottom = (np.iinfo(np.int64).max, np.iinfo(np.int64).min) if whole else (np.inf, -np.inf)
            low = np.minimum.reduceat(np.where(valid, x, top), starts)
            high = np.maximum.reduceat(np.where(valid, x, bottom), starts)
            at_low = add((valid & (x == np.repeat(low, sizes))).astype(np.int64))
            moved = np.where(valid, x - self.shifts[k], 0.0)
            both = valid & y_valid
            px, py = np.where(both, moved, 0.0), np.where(both, y, 0.0)
            sums = (valid.astype(np.int64), (valid & (x == 0)).astype(np.int64), moved, moved * moved, both.astype(np.int64), px, py, px * px, py * py, px * py)
            for place, totals in enumerate(zip(*map(add, sums))):
                if totals[0]:
                    self._merge(self.cells[owners[place]][k], low[place].item(), at_low[place], high[place].item(), totals)

    def _class(self, value) -> int:
        if value not in self.classes:
            self.classes[value] = len(self.classes)
            self.rows.append(0)
            self.cells.append([{"low": None, "n_low": 0, "high": None, **dict.fromkeys(SUMS, 0)} for _ in self.names])
        return self.classes[value]

    @staticmethod
    def _numbers(column: pa.Array, order: np.ndarray, nothing: float) -> tuple[np.ndarray, np.ndarray]:
        """Values (of 64 bits) and whether each is there; NaN is not."""
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        x = column.fill_null(nothing).to_numpy(zero_copy_only=False)
        x = x.astype(np.int64 if x.dtype.kind in "iu" else np.float64)
        if x.dtype.kind == "f":
            valid, x = valid & ~np.isnan(x), np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
        return x[order], valid[order]

    @staticmethod
    def _merge(cell: dict, low, n_low: int, high, totals: tuple) -> None:
        """The smaller minimum wins, equal ones add up."""
        if cell["low"] is None or low < cell["low"]:
            cell["low"], cell["n_low"] = low, 0
        if low == cell["low"]:
            cell["n_low"] += n_low
        cell["high"] = high if cell["high"] is None else max(high, cell["high"])
        for name, total in zip(SUMS, totals):
            cell[name] += total

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        # A double decides the order; the whole number tells large ones apart that are the same double.
        edge = lambda v: None if v is None else {"d": float(v), "l": v if isinstance(v, int) else None}
        rows = [
            {"stratum": value, "n_rows": self.rows[c], "col": name, **cell, "low": edge(cell["low"]), "high": edge(cell["high"]), "shift": shift}
            for value, c in self.classes.items()
            for name, cell, shift in zip(self.names, self.cells[c], [*self.shifts, *[None] * len(self.names)])
        ]
        return pa.RecordBatch.from_pylist(rows, schema)


def summaries(rows: DataFrame, numeric: Sequence[str], other: Sequence[str] = (), strata: str | None = None, target: str | None = None) -> DataFrame:
    """One row for each column and class of `strata` (one class if None) with everything that the rules need to know.

    `stratum, n_rows, col, low, n_low (rows at the minimum), high, shift` and the SUMS. One scan: each task sums up its
    rows, and only a row for each task, class and column is shuffled. For other than numeric columns all but `present`
    stays empty. The sums with the target are over `target` as a number.
    """
    y = to_number(rows, target) if target else F.lit(None).cast("double")
    stratum = col(strata) if strata else F.lit(None).cast("string")
    names = [*numeric, *other]
    chosen = rows.select(stratum.alias("stratum"), y.alias("y"), *[col(c).alias(f"x{i}") for i, c in enumerate(names)])
    means = [F.avg(f"x{i}").alias(f"m{i}") for i in range(len(numeric))]
    some = chosen.select("y", *[F.col(f"x{i}").cast("double").alias(f"x{i}") for i in range(len(numeric))]).limit(SHIFT_ROWS)
    first = some.agg(F.avg("y").alias("y"), *means).first()
    shift = [v if v is not None and np.isfinite(v) else 0.0 for v in first]
    kind = chosen.schema["stratum"].dataType
    schema = T.StructType([T.StructField("stratum", kind)] + T.StructType.fromDDL(SUMMARY.removeprefix(", ")).fields)
    arrow, n_numeric = to_arrow_schema(schema), len(numeric)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Accumulator(names, n_numeric, shift[1:], shift[0])
        for batch in batches:
            if batch.num_rows:
                found.add(batch)
        yield found.batch(arrow)

    parts = chosen.mapInArrow(run, schema)
    # Equal minima add up first, then the smallest one wins.
    sums = [F.sum(c).alias(c) for c in ("n_rows", *SUMS)]
    by_low = parts.groupBy("stratum", "col", "low").agg(F.sum("n_low").alias("n_low"), F.max("high").alias("high"), F.max("shift").alias("shift"), *sums)
    return by_low.groupBy("stratum", "col").agg(
        F.min("low").alias("low"), F.min_by("n_low", "low").alias("n_low"), F.max("high").alias("high"), F.max("shift").alias("shift"), *sums
    )


def numeric_moments(summary: DataFrame) -> DataFrame:
    """`col, n_rows, n_values, low, high, constant, mean, std, n_target, corr` of numeric columns, over all classes.

    The correlation uses the rows where column and target number are both present and is NULL, not an error, when either
    side is constant there.
    """
    sums = [F.sum(c).alias(c) for c in ("n_rows", *SUMS)]
    merged = summary.where("shift IS NOT NULL").groupBy("col").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("shift").alias("shift"), *sums)
    # What is left of a sum of squares after rounding counts as nothing.
    spread = lambda squares, s: f"CASE WHEN {squares} - {s} * {s} / nullif(pairs, 0) > 1e-12D * {squares} THEN {squares} - {s} * {s} / nullif(pairs, 0) END"
    return merged.selectExpr(
        "col", "n_rows", "present AS n_values", "low.d AS low", "high.d AS high", "present = 0 OR low = high AS constant",
        "shift + try_divide(s1, present) AS mean",
        "CASE WHEN present = 0 THEN NULL WHEN low = high THEN 0.0D ELSE sqrt(greatest(0.0D, s2 / present - pow(s1 / present, 2))) END AS std",
        "pairs AS n_pairs",
        f"try_divide(pxy - px * py / nullif(pairs, 0), sqrt({spread('pxx', 'px')}) * sqrt({spread('pyy', 'py')})) AS corr",
    )


def class_gaps(summary: DataFrame) -> DataFrame:
    """Per column the spread over classes: `col, presence_gap, zero_gap, minimum_gap, mixed_constancy`.

    A column is constant in a class if it has exactly one distinct value there, NULL counting as a value; minimum and
    maximum tell that. `minimum_gap` is about the share of rows at the class's own minimum. NULL for other columns.
    """
    numeric = "shift IS NOT NULL"
    constant = "present = 0 OR (present = n_rows AND low = high)"
    shares = summary.selectExpr(
        "col", "present / n_rows AS presence", f"CASE WHEN {numeric} THEN zeros / n_rows END AS zeros",
        f"CASE WHEN {numeric} THEN n_low / n_rows END AS minimum", f"CASE WHEN {numeric} THEN {constant} END AS constant",
    )
    return shares.groupBy("col").agg(
        F.expr("max(presence) - min(presence) AS presence_gap"),
        F.expr("max(zeros) - min(zeros) AS zero_gap"),
        F.expr("max(minimum) - min(minimum) AS minimum_gap"),
        F.expr("bool_or(constant) AND NOT bool_and(constant) AS mixed_constancy"),
    )


def category_profile(rows: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """`col, hash, n_rows, one_target` for every value (NULL included) of categorical columns.

    Values go by 128 bits, however long their texts are; texts are looked up only for the columns that need
    them. Partial aggregation reduces hot values before the shuffle. `one_target` says that all
    rows with the value share one target value (NULL counting as one).
    """
    owner = F.xxhash64(col(target)) if target else F.lit(None).cast("long")
    hashes = [value_hash(col(c)).alias(f"h{i}") for i, c in enumerate(columns)]
    long = rows.select(owner.alias("owner"), *hashes).unpivot("owner", [f"h{i}" for i in range(len(columns))], "place", "hash")
    counted = long.groupBy("place", "hash").agg(
        F.expr("count(1) AS n_rows"), F.expr("min(owner) = max(owner) AS one_target")
    )
    names = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (f"h{i}", c)])
    return counted.select(names[F.col("place")].alias("col"), "hash", "n_rows", "one_target")


def category_texts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`col, value`: the distinct values (NULL included) of columns that are known to have few."""
    texts = [col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns)]
    long = rows.select(*texts).unpivot([], [f"v{i}" for i in range(len(columns))], "place", "value").distinct()
    names = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (f"v{i}", c)])
    return long.select(names[F.col("place")].alias("col"), "value")


def single_target_columns(profile: DataFrame) -> DataFrame:
    """`col, n_categories, n_mixed`: a column leaks when no category is mixed and one exists."""
    return (
        profile.where("hash IS NOT NULL")
        .groupBy("col")
        .agg(F.expr("count(1) AS n_categories"), F.expr("count_if(NOT one_target) AS n_mixed"))
    )
