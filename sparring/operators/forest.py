"""Forests of regression trees for any depth: Spark splits the nodes of many rows, tasks finish those of few.

The trees are those of Spark's `RandomForestRegressor` with all features at each node: the same thresholds, bags, gains,
ties and leaves, to the last bit if the rows stand in one partition (of several, Spark adds the sums in any order). Spark's
own fit keeps a histogram of all features for each node, however few rows it has, and trees without a depth limit have
about two nodes for each row. Here a node gets such histograms, summed over all partitions, only while it has more than `ROWS_IN_TASK` rows;
the rows of each smaller one, a cell, are brought together, and one task grows the tree below it.

A fitted forest is a table of cells. Rows are scored by sending them to the cells that they fall into, so neither the
driver nor a task holds the whole forest.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparring.functions.bags import poisson_ones, sampled
from sparring.session import delete_path, local_frame, materialize, path_exists, release, staging_path

# Training rows that thresholds are taken from, rows that a task may grow a tree of,
# rows of a node up to which its features are sorted rather than counted in bins, and numbers of one pass of histograms.
SAMPLE = 10_000
ROWS_IN_TASK = 100_000
FEW = 32
HISTOGRAM_NUMBERS = 6_000_000

# Impurities below this are none, as in Spark.
EPSILON = 2.0**-52

CELLS = "cell long, kind int, block long, a binary, b binary, c binary, d binary"
_BINNED = "id long, label double, bins binary, bags binary"
_PACKED = "cell long, id long, bins binary, labels binary, bags binary"
_FOUND = "slot int, feature int, cut int, stats array<double>, left_stats array<double>, right_stats array<double>"


@dataclass
class Nodes:
    """Nodes of one or more trees; `feature` is -1 in leaves, the right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    def route(self, bins: np.ndarray, start: int) -> np.ndarray:
        """The leaf of each row, from node `start`."""
        at = np.full(len(bins), start)
        rows = np.arange(len(bins))
        while len(rows):
            node = at[rows]
            inner = self.feature[node] >= 0
            rows, node = rows[inner], node[inner]
            at[rows] = self.left[node] + (bins[rows, self.feature[node]] > self.cut[node])
        return at


def _spread(count, total, squares):
    return (squares - total * total / count) / count


def _variance(count, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, _spread(count, total, squares))


def _gains(left, right, impurity):
    """Fall of the impurity, and -inf where a side is empty or nothing is gained."""
    with np.errstate(divide="ignore", invalid="ignore"):
        total = left[0] + right[0]
        gain = impurity - left[0] / total * _spread(*left) - right[0] / total * _spread(*right)
        return np.where((left[0] >= 1) & (right[0] >= 1) & (gain >= 0), gain, -np.inf)


class _Splits:
    """The best split of each of some nodes: of equal ones that of the first feature, then the lowest.

    Statistics are (count, sum, sum of squares) by node. Those of a root are not known (its impurity is NaN) before its
    first feature is offered.
    """

    def __init__(self, stats: np.ndarray, impurity: np.ndarray) -> None:
        k = len(impurity)
        self.stats, self.impurity, self.gain = stats.copy(), impurity.copy(), np.zeros(k)
        self.feature, self.cut = np.full(k, -1, np.int32), np.zeros(k, np.int32)
        self.left_stats, self.right_stats = np.zeros((3, k)), np.zeros((3, k))

    def offer(self, feature: int, sums: np.ndarray) -> None:
        """Statistics of the bins of a feature, (3, nodes, bins)."""
        sums = np.cumsum(sums, axis=2)
        left = sums[:, :, :-1]
        right = sums[:, :, -1:] - left
        new = np.isnan(self.impurity)
        if new.any():
            self.stats[:, new] = (left[:, :, 0] + right[:, :, 0])[:, new]
            self.impurity[new] = _variance(*self.stats[:, new])
        gain = _gains(left, right, self.impurity[:, None])
        cut = gain.argmax(1)
        i = np.nonzero(gain[np.arange(len(cut)), cut] > self.gain)[0]
        self.take(i, gain[i, cut[i]], feature, cut[i], left[:, i, cut[i]], right[:, i, cut[i]])

    def take(self, i, gain, feature, cut, left_stats, right_stats) -> None:
        self.gain[i], self.feature[i], self.cut[i] = gain, feature, cut
        self.left_stats[:, i], self.right_stats[:, i] = left_stats, right_stats


def _split_by_bins(splits: _Splits, by_feature, x, rows, node, n_bins) -> None:
    """Nodes of many rows: `rows` of `node`, by the bins of each feature."""
    k, x = len(splits.gain), x[:, rows]
    for f in np.nonzero(n_bins > 1)[0]:
        at = node * n_bins[f] + by_feature[f, rows]
        sums = [np.bincount(at, v, k * n_bins[f]).reshape(k, -1) for v in x]
        splits.offer(f, np.stack(sums))


def _split_by_order(splits: _Splits, bins, x, rows, real) -> None:
    """Nodes of few rows, which stand in `rows` (nodes, rows): features are sorted. Where `real` is false no row stands."""
    k, n = rows.shape
    width = n.bit_length()
    kind, pad = (np.uint16, (1 << 16 - width) - 1) if bins.dtype == np.uint8 else (np.uint64, 1 << 40)
    key = np.where(real[:, :, None], bins[rows], pad).astype(kind).transpose(0, 2, 1) << kind(width)
    key = np.sort(key | np.arange(n, dtype=kind), axis=2).transpose(2, 0, 1).copy()
    value = key >> kind(width)
    at = (key & kind((1 << width) - 1)).astype(np.intp) + (np.arange(k) * n)[:, None]
    given = np.where(real, x[:, rows], 0.0).reshape(3, -1)
    sums = np.stack([v.take(at) for v in given])
    # Sums of a bin's rows first, then those of the bins, as histograms have them; counts are exact in any order.
    below, bin_sum = np.zeros((2, *at.shape[1:])), sums[1:, 0].copy()
    changes = value[1:] != value[:-1]
    for i in range(1, n):
        np.copyto(below, sums[1:, i - 1], where=changes[i - 1])
        bin_sum *= ~changes[i - 1]
        bin_sum += sums[1:, i]
        np.add(below, bin_sum, out=sums[1:, i])
        sums[0, i] += sums[0, i - 1]
    total, impurity = sums[:, -1], splits.impurity[:, None]
    best, cut = np.zeros(at.shape[1:]), np.zeros(at.shape[1:], np.int8)
    with np.errstate(divide="ignore", invalid="ignore"):
        for i in range(n - 1):
            left = sums[:, i]
            # Beyond the last row the right side is empty and the gain NaN.
            right = total - left
            gain = impurity - left[0] / total[0] * _spread(*left) - right[0] / total[0] * _spread(*right)
            better = (gain > best) & changes[i]
            np.copyto(best, gain, where=better)
            np.copyto(cut, i, where=better)
    feature = best.argmax(1)
    gain = best[np.arange(k), feature]
    i = np.nonzero(gain > splits.gain)[0]
    feature = feature[i]
    place = cut[i, feature]
    left = sums[:, place, i, feature]
    splits.take(i, gain[i], feature, value[place, i, feature], left, sums[:, -1, i, feature] - left)


_WIDTHS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 25, FEW)
_AT_ONCE = 300_000  # numbers of one call of _split_by_order


def _best_splits(stats, impurity, bins, by_feature, x, order, size, n_bins) -> _Splits:
    """Splits of nodes whose rows follow each other in `order`."""
    found = _Splits(stats, impurity)

    def keep(nodes: np.ndarray, search, *given) -> None:
        part = _Splits(stats[:, nodes], impurity[nodes])
        search(part, *given)
        found.stats[:, nodes], found.impurity[nodes] = part.stats, part.impurity
        found.take(nodes, part.gain, part.feature, part.cut, part.left_stats, part.right_stats)

    starts = np.cumsum(size) - size
    many = (size > FEW) | np.isnan(impurity)
    if many.any():
        node = np.repeat(np.where(many, np.cumsum(many) - 1, -1), size)
        keep(np.nonzero(many)[0], _split_by_bins, by_feature, x, order[node >= 0], node[node >= 0], n_bins)
    for low, width in zip((0, *_WIDTHS), _WIDTHS):
        nodes = np.nonzero(~many & (size > low) & (size <= width))[0]
        step = max(1, _AT_ONCE // (width * max(1, len(n_bins))))
        for i in range(0, len(nodes), step):
            part = nodes[i : i + step]
            real = np.arange(width) < size[part, None]
            rows = order[np.minimum(starts[part, None] + np.arange(width), len(order) - 1)]
            keep(part, _split_by_order, bins, x, rows, real)
    return found


def grow(bins: np.ndarray, labels: np.ndarray, bags: np.ndarray, n_bins: np.ndarray, levels: int, stats: np.ndarray | None = None) -> tuple[Nodes, np.ndarray]:
    """A tree of up to `levels` levels of splits and the predictions of its nodes; rows that are bagged 0 times are left out before."""
    weights = bags.astype(float)
    x = np.stack([weights, weights * labels, weights * labels * labels])
    by_feature = np.ascontiguousarray(bins.T)
    n = len(bins)
    nodes = Nodes(np.full(2 * n + 1, -1, np.int32), np.zeros(2 * n + 1, np.int32), np.zeros(2 * n + 1, np.int32))
    prediction = np.zeros(2 * n + 1)
    whole = np.cumsum(x, axis=1)[:, -1:] if n else np.zeros((3, 1))
    impurity = np.array([np.nan]) if stats is None else _variance(*stats.reshape(3, 1))
    stats = whole if stats is None else stats.reshape(3, 1)
    prediction[0] = stats[1, 0] / stats[0, 0] if stats[0, 0] else 0.0
    order, size, ids, used = np.arange(n), np.array([n]), np.array([0]), 1
    for level in range(levels if n else 0):
        splits = _best_splits(stats, impurity, bins, by_feature, x, order, size, n_bins)
        if level == 0:
            prediction[0] = splits.stats[1, 0] / splits.stats[0, 0]
        split = splits.feature >= 0
        k = int(split.sum())
        if not k:
            break
        at = ids[split]
        nodes.feature[at], nodes.cut[at], nodes.left[at] = splits.feature[split], splits.cut[split], used + 2 * np.arange(k)
        stats = np.stack([splits.left_stats[:, split], splits.right_stats[:, split]], axis=2).reshape(3, 2 * k)
        impurity, ids = _variance(*stats), used + np.arange(2 * k)
        prediction[ids] = stats[1] / stats[0]
        used += 2 * k
        node = np.repeat(np.where(split, np.cumsum(split) - 1, -1), size)
        order, node = order[node >= 0], node[node >= 0]
        child = 2 * node + (bins[order, nodes.feature[at][node]] > nodes.cut[at][node])
        size = np.bincount(child, minlength=2 * k)
        open_ = (np.abs(impurity) >= EPSILON) & (size > 1)
        order, child = order[open_[child]], child[open_[child]]
        order = order[np.argsort(child, kind="stable")]
        ids, size, stats, impurity = ids[open_], size[open_], stats[:, open_], impurity[open_]
    return Nodes(nodes.feature[:used], nodes.cut[:used], nodes.left[:used]), prediction[:used]


# --- thresholds and bins ---


def _cuts(value_counts: dict[float, float], expected: float, n_splits: int) -> list[float]:
    """Thresholds between values, at equal counts if there are too many; zeros are what is missing of `expected` rows."""
    zeros = expected - sum(value_counts.values())
    if zeros > EPSILON * sum(value_counts.values()) * 100:
        value_counts = {**value_counts, 0.0: zeros}
    values = sorted(value_counts)
    if len(values) - 1 <= n_splits:
        return [(a + b) / 2.0 for a, b in itertools.pairwise(values)]
    stride = expected / (n_splits + 1)
    cuts, count, target = [], value_counts[values[0]], stride
    for a, b in itertools.pairwise(values):
        before, count = count, count + value_counts[b]
        if abs(before - target) < abs(count - target):
            cuts.append((a + b) / 2.0)
            target += stride
    return cuts


def find_cuts(rows: DataFrame, vector: str, n_features: int, n_rows: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of each feature."""
    n_splits = min(max_bins, n_rows) - 1
    share = min(1.0, max(SAMPLE, (n_splits + 1) ** 2) / n_rows)

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = sampled(share, seed, TaskContext.get().partitionId())
        for batch in batches:
            yield batch.filter(pa.array(itertools.islice(chosen, len(batch)), pa.bool_()))

    def cuts(key, table):
        counts = dict(zip(table["value"].to_pylist(), map(float, table["count"].to_pylist())))
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "cuts": pa.array([_cuts(counts, share * n_rows, n_splits)], pa.list_(pa.float64()))})

    drawn = rows.select(vector_to_array(vector).alias("x")).mapInArrow(taken, "x array<double>")
    values = drawn.select(F.posexplode("x").alias("feature", "value")).where("value != 0")
    found = values.groupBy("feature", "value").count().groupBy("feature").applyInArrow(cuts, "feature int, cuts array<double>").collect()
    of = {r["feature"]: r["cuts"] for r in found}
    return [np.array(of.get(f, []), float) for f in range(n_features)]


def _small(cuts: Sequence[np.ndarray]):
    return np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16 if max(map(len, cuts)) < 65536 else np.uint32


def _binned(column: pa.Array, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """(rows, features): how many thresholds are below each value."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
    if column.null_count or len(x) != len(column) or not np.isfinite(x).all():
        raise ValueError("features must not be NULL, NaN or infinite")
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(_small(cuts)) if len(cuts) else np.zeros((len(column), 0), np.uint8)


def _bin_rows(cuts: Sequence[np.ndarray], n_trees: int, seed: int):
    """Rows with bins instead of features and how often each tree's bag holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        draws, seen = poisson_ones(seed + partition + 1), partition << 33
        for batch in batches:
            n, labels = len(batch), batch["label"].to_numpy(zero_copy_only=False)
            if not np.isfinite(labels).all():
                raise ValueError("labels must not be NULL, NaN or infinite")
            bags = np.fromiter(itertools.islice(draws, n * n_trees), np.uint8, n * n_trees).reshape(n, n_trees)
            yield pa.record_batch({
                "id": np.arange(seen, seen + n), "label": labels,
                "bins": _records(_binned(batch["x"], cuts)), "bags": _records(bags),
            })
            seen += n

    return run


def _records(table: np.ndarray) -> pa.Array:
    """The rows of a table as binary values."""
    table = np.ascontiguousarray(table)
    width = table.shape[1] * table.itemsize
    ends = np.arange(0, (len(table) + 1) * width, max(width, 1), dtype=np.int64) if width else np.zeros(len(table) + 1, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(table), [None, pa.py_buffer(ends), pa.py_buffer(table)]).cast(pa.binary())


def _table(column: pa.Array, kind, width: int) -> np.ndarray:
    """`_records` read back."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


# --- fitting ---


def _histograms(upper: Nodes, slots: np.ndarray, trees: np.ndarray, n_bins: np.ndarray, kind, n_trees: int):
    """Statistics of the bins of the nodes in `slots`, summed over a partition; `trees` are those of the slots, in order."""
    offsets = np.cumsum(n_bins) - n_bins
    n_slots, total = len(trees), int(n_bins.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, n_slots, total))
        for batch in batches:
            bins, bags = _table(batch["bins"], kind, len(n_bins)), _table(batch["bags"], np.uint8, n_trees)
            labels = batch["label"].to_numpy()
            for t in np.unique(trees):
                first, last = np.searchsorted(trees, [t, t + 1])
                rows = np.nonzero(bags[:, t])[0]
                at = slots[upper.route(bins[rows], t)]
                rows, at = rows[at >= 0], at[at >= 0] - first
                w, y, k = bags[rows, t].astype(float), labels[rows], last - first
                for f, b in enumerate(n_bins):
                    place = at * b + bins[rows, f]
                    for s, v in zip(sums, (w, w * y, w * y * y)):
                        s[first:last, offsets[f] : offsets[f] + b] += np.bincount(place, v, k * b).reshape(k, b)
        partition = TaskContext.get().partitionId()
        for i in range(n_slots):
            yield pa.record_batch({"slot": pa.array([i], pa.int32()), "partition": pa.array([partition], pa.int32()), "sums": [sums[:, i].tobytes()]})

    return run


def _found(stats: np.ndarray, impurity: np.ndarray, n_bins: np.ndarray):
    """The best split of a node from the histograms of all partitions."""
    offsets = np.cumsum(n_bins) - n_bins

    def run(key, table):
        slot = key[0].as_py()
        table = table.sort_by("partition")
        sums = sum(np.frombuffer(s.as_buffer(), float).reshape(3, 1, -1) for s in table["sums"])
        splits = _Splits(stats[:, [slot]], impurity[[slot]])
        for f in np.nonzero(n_bins > 1)[0]:
            splits.offer(f, sums[:, :, offsets[f] : offsets[f] + n_bins[f]])
        return pa.table({
            "slot": pa.array([slot], pa.int32()), "feature": splits.feature, "cut": splits.cut, "stats": [splits.stats[:, 0]],
            "left_stats": [splits.left_stats[:, 0]], "right_stats": [splits.right_stats[:, 0]],
        })

    return run


@dataclass
class _Upper:
    """The nodes that Spark splits, on the driver: those of more than `ROWS_IN_TASK` rows and their children."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    tree: list[int]
    depth: list[int]
    stats: list[np.ndarray | None]

    def nodes(self) -> Nodes:
        return Nodes(*(np.array(c, np.int32) for c in (self.feature, self.cut, self.left)))

    def add(self, tree: int, depth: int, stats: np.ndarray | None) -> None:
        for column, value in zip((self.feature, self.cut, self.left, self.tree, self.depth, self.stats), (-1, 0, 0, tree, depth, stats)):
            column.append(value)

    def closed(self, node: int, max_depth: int) -> bool:
        """Whether a node stays a leaf."""
        s = self.stats[node]
        return self.depth[node] == max_depth or s is not None and bool(abs(_variance(*s)) < EPSILON)


def _split_upper(rows: DataFrame, n_rows: int, n_bins: np.ndarray, kind, n_trees: int, max_depth: int, rows_in_task: int) -> tuple[_Upper, set[int]]:
    """Nodes of many rows are split by levels; the upper nodes, and those of their leaves that stay leaves."""
    upper = _Upper([], [], [], [], [], [])
    for t in range(n_trees):
        upper.add(t, 0, None)
    at_once = max(1, HISTOGRAM_NUMBERS // (3 * int(n_bins.sum()) or 1))
    level, leaves = list(range(n_trees)), set()
    while level:
        leaves |= {i for i in level if upper.closed(i, max_depth)}
        large = [i for i in level if i not in leaves and (n_rows if upper.stats[i] is None else upper.stats[i][0]) > rows_in_task]
        level = []
        for s in range(0, len(large), at_once):
            part = sorted(large[s : s + at_once], key=lambda i: (upper.tree[i], i))
            nodes, unknown = upper.nodes(), np.full(3, np.nan)
            slots = np.full(len(nodes.feature), -1)
            slots[part] = np.arange(len(part))
            stats = np.stack([unknown if upper.stats[i] is None else upper.stats[i] for i in part], axis=1)
            sums = rows.mapInArrow(_histograms(nodes, slots, np.array([upper.tree[i] for i in part]), n_bins, kind, n_trees), "slot int, partition int, sums binary")
            for r in sums.groupBy("slot").applyInArrow(_found(stats, _variance(*stats), n_bins), _FOUND).collect():
                node = part[r["slot"]]
                upper.stats[node] = np.array(r["stats"])
                if r["feature"] < 0:
                    leaves.add(node)
                    continue
                upper.feature[node], upper.cut[node], upper.left[node] = r["feature"], r["cut"], len(upper.feature)
                for side in ("left_stats", "right_stats"):
                    level.append(len(upper.feature))
                    upper.add(upper.tree[node], upper.depth[node] + 1, np.array(r[side]))
    return upper, leaves


def _pack_rows(upper: Nodes, done: np.ndarray, kind, n_features: int, n_trees: int):
    """The bagged rows of a batch by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, bags = _table(batch["bins"], kind, n_features), _table(batch["bags"], np.uint8, n_trees)
            ids, labels = batch["id"].to_numpy(), batch["label"].to_numpy()
            for t in range(n_trees):
                rows = np.nonzero(bags[:, t])[0]
                at = upper.route(bins[rows], t)
                cells = [c for c in np.unique(at) if not done[c]]
                of = [rows[at == c] for c in cells]
                yield pa.record_batch({
                    "cell": pa.array(cells, pa.int64()), "id": pa.array([ids[r[0]] for r in of], pa.int64()),
                    "bins": pa.array([bins[r].tobytes() for r in of], pa.binary()), "labels": pa.array([labels[r].tobytes() for r in of], pa.binary()),
                    "bags": pa.array([bags[r, t].tobytes() for r in of], pa.binary()),
                })

    return run


def _cell_record(cell: int, nodes: Nodes, prediction: np.ndarray) -> tuple:
    return cell, 0, 0, nodes.feature.tobytes(), nodes.cut.tobytes(), nodes.left.tobytes(), prediction.tobytes()


def _grow_cells(upper: _Upper, kind, n_bins: np.ndarray, max_depth: int):
    def run(key, table):
        cell = key[0].as_py()
        table = table.sort_by("id")
        bins, labels, bags = (
            np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in (("bins", kind), ("labels", float), ("bags", np.uint8))
        )
        grown = grow(bins.reshape(len(labels), len(n_bins)), labels, bags, n_bins, max_depth - upper.depth[cell], upper.stats[cell])
        names = [f.split()[0] for f in CELLS.split(", ")]
        return pa.table({n: [v] for n, v in zip(names, _cell_record(cell, *grown))}).cast(_ARROW_CELLS)

    return run


_ARROW_CELLS = pa.schema([
    ("cell", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), *[(c, pa.binary()) for c in "abcd"],
])


def _n_tasks(spark: SparkSession, n_cells: int) -> int:
    """Tasks for cells: a few for each core, as cells fall on tasks by hash."""
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 6 * spark.sparkContext.defaultParallelism)
    return max(1, min(n_cells, wanted))


def fit_forest(
    rows: DataFrame, label: str, vector: str, n_features: int, n_trees: int, max_depth: int, max_bins: int, seed: int,
    rows_in_task: int = ROWS_IN_TASK,
) -> ForestModel:
    """A forest over the rows of a stable table, in which partitions and their order do not change."""
    spark, n_rows = rows.sparkSession, rows.count()
    if not n_rows:
        raise ValueError("a forest needs at least one training row")
    cuts = find_cuts(rows, vector, n_features, n_rows, max_bins, seed)
    n_bins, kind = np.array([len(c) + 1 for c in cuts]), _small(cuts)
    given = rows.select(F.col(label).cast("double").alias("label"), vector_to_array(vector).alias("x"))
    binned = materialize(given.mapInArrow(_bin_rows(cuts, n_trees, seed), _BINNED), "binned")
    upper, leaves = _split_upper(binned, n_rows, n_bins, kind, n_trees, max_depth, rows_in_task)
    nodes = upper.nodes()
    done = np.isin(np.arange(len(nodes.feature)), list(leaves)) | (nodes.feature >= 0)
    # A root of an empty bag has no rows, but is a tree.
    empty = local_frame(spark, [(int(c), -1, b"", b"", b"") for c in np.nonzero(~done)[0]], _PACKED)
    packed = binned.mapInArrow(_pack_rows(nodes, done, kind, n_features, n_trees), _PACKED).union(empty)
    grown = packed.repartition(_n_tasks(spark, int((~done).sum())), "cell").groupBy("cell").applyInArrow(_grow_cells(upper, kind, n_bins, max_depth), CELLS)
    leaf = Nodes(*np.array([[-1], [0], [0]], np.int32))
    single = local_frame(spark, [_cell_record(c, leaf, np.array([upper.stats[c][1] / upper.stats[c][0]])) for c in sorted(leaves)], CELLS)
    path = staging_path(spark, "forest")
    grown.union(single).write.parquet(f"{path}/cells")
    release(binned)
    return ForestModel(cuts, n_trees, nodes, path, staged=True)


# --- scoring ---


def _to_cells(model: ForestModel):
    """The rows of each batch by cell, and the batch itself, which waits for its predictions."""
    cuts, n_trees, upper = model.cuts, model.n_trees, model.upper

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            if not len(batch):
                continue
            sink = pa.BufferOutputStream()
            kept = batch.select(batch.schema.names[:-1])
            with pa.ipc.new_stream(sink, kept.schema) as out:
                out.write_batch(kept)
            content = sink.getvalue().to_pybytes()
            # The content is part of the name: had a lost task been run again on other rows, predictions would not match.
            name = hashlib.blake2b(b"%d,%d," % (partition, i) + content, digest_size=8).digest()
            block = int.from_bytes(name, "big", signed=True)
            bins = _binned(batch.column(batch.num_columns - 1), cuts)
            yield _records_of([(-1 - (block & 0xFFFF), 1, block, content, b"", b"", b"")])
            for t in range(n_trees):
                at = upper.route(bins, t)
                found = []
                for c in np.unique(at):
                    rows = np.nonzero(at == c)[0]
                    found.append((int(c), 1, block, rows.astype(np.int32).tobytes(), bins[rows].tobytes(), np.int32(t).tobytes(), b""))
                yield _records_of(found)

    return run


def _records_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW_CELLS)], schema=_ARROW_CELLS)


def _score_cells(kind, n_features: int):
    """Cells come before their rows; what comes out is (tree, rows, predictions) of a block, or the block's own batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = nodes = prediction = None
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    cell, prediction = r["cell"], np.frombuffer(r["d"], float)
                    nodes = Nodes(*(np.frombuffer(r[c], np.int32) for c in "abc"))
                    continue
                if r["cell"] < 0:
                    yield _records_of([tuple(r.values())])
                    continue
                if r["cell"] != cell:
                    raise RuntimeError(f"cell {r['cell']} of the forest is missing")
                bins = np.frombuffer(r["b"], kind).reshape(-1, n_features)
                got = prediction[nodes.route(bins, 0)] if n_features else np.full(len(r["a"]) // 4, prediction[0])
                yield _records_of([(cell, 1, r["block"], r["a"], got.tobytes(), r["c"], b"")])

    return run


def _mean_of_trees(n_trees: int, output: str):
    def run(table):
        rows = table.to_pylist()
        (content,) = [r["a"] for r in rows if r["cell"] < 0]
        batch = pa.ipc.open_stream(content).read_all()
        scores = np.full((n_trees, len(batch)), np.nan)
        for r in rows:
            if r["cell"] >= 0:
                scores[np.frombuffer(r["c"], np.int32)[0], np.frombuffer(r["a"], np.int32)] = np.frombuffer(r["b"], float)
        if np.isnan(scores).any():
            raise RuntimeError("a block lacks predictions of some trees: its rows changed while they were scored")
        total = np.zeros(len(batch))
        for own in scores:
            total += own
        return batch.append_column(output, pa.array(total / n_trees))

    return run


@dataclass
class ForestModel:
    """A fitted forest: thresholds, the upper nodes and the folder of its cells."""

    cuts: list[np.ndarray]
    n_trees: int
    upper: Nodes
    path: str
    staged: bool = False

    def transform(self, df: DataFrame, vector: str, output: str) -> DataFrame:
        """Add the prediction of each row."""
        spark = df.sparkSession
        if output in df.columns:
            raise ValueError(f"{output} is a column already")
        n_cells = int((self.upper.feature < 0).sum())
        cells = spark.read.schema(CELLS).parquet(f"{self.path}/cells")
        sent = df.withColumn("__x", vector_to_array(vector)).mapInArrow(_to_cells(self), CELLS)
        met = cells.union(sent).repartition(_n_tasks(spark, n_cells), "cell").sortWithinPartitions("cell", "kind")
        scored = met.mapInArrow(_score_cells(_small(self.cuts), len(self.cuts)), CELLS)
        schema = T.StructType([*df.schema.fields, T.StructField(output, T.DoubleType())])
        return scored.groupBy("block").applyInArrow(_mean_of_trees(self.n_trees, output), schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the forest below `path`."""
        spark.read.schema(CELLS).parquet(f"{self.path}/cells").write.mode("overwrite").parquet(f"{path}/cells")
        cuts = local_frame(spark, [(i, c.tolist()) for i, c in enumerate(self.cuts)], "place int, cuts array<double>")
        cuts.write.mode("overwrite").parquet(f"{path}/cuts")
        u = self.upper
        upper = local_frame(spark, list(zip(range(len(u.feature)), u.feature.tolist(), u.cut.tolist(), u.left.tolist())), "place int, feature int, cut int, left int")
        upper.write.mode("overwrite").parquet(f"{path}/upper")
        local_frame(spark, [(self.n_trees,)], "n_trees int").write.mode("overwrite").parquet(f"{path}/trees")

    def stand_at(self, spark: SparkSession, path: str) -> None:
        """Use what was saved below `path` from now on, and delete what the fit staged."""
        if self.staged:
            delete_path(spark, self.path)
        self.path, self.staged = path, False

    @staticmethod
    def load(path: str) -> ForestModel | RandomForestRegressionModel:
        """A saved forest; one of Spark's own, if the folder holds such a one."""
        spark = SparkSession.active()
        if path_exists(spark, f"{path}/treesMetadata"):
            return RandomForestRegressionModel.load(path)
        cuts = [np.array(r["cuts"], float) for r in spark.read.parquet(f"{path}/cuts").orderBy("place").collect()]
        upper = spark.read.parquet(f"{path}/upper").orderBy("place").collect()
        nodes = Nodes(*(np.array([r[c] for r in upper], np.int32) for c in ("feature", "cut", "left")))
        return ForestModel(cuts, spark.read.parquet(f"{path}/trees").first()[0], nodes, path)
