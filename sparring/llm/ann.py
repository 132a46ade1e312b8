"""Approximate nearest neighbours by cross-polytope hashing.

Rows are dealt into bands of like length (a factor of sqrt(2)). A row of a band with longest length l gets one more
component, sqrt(l**2 - length**2), a query the component 0, so that within a band the nearest axis follows the inner
product, and one long vector changes its own band only. The vector is rotated by a fast pseudo-rotation (three rounds of
random signs and a Hadamard transform, on the length padded to a power of two) and hashed to the nearest signed axis,
once in each table; a query visits its `probes` nearest axes in each table and band. Bands of at most `whole_rows` rows,
among them the few longest vectors, which are near to most queries, are searched whole by every query. Neighbouring axes
share a cell of the shuffle, cells are cut into blocks of about `block_rows` rows and queries; in a pair of blocks each
axis is one matrix product, of which each query keeps its best rows. Those are scored again on the original vectors in
double precision and ranked. A query that found fewer rows than it is owed is compared with all rows.

Nearness is the largest inner product; ties go to the smaller id. Of equal vectors only the k + 1 smallest ids can ever
be among the k nearest, so only those are indexed, and equal queries are searched once.

Vectors that are null, zero, empty or hold null or non-finite components take no part, nor do rows of null id or of
another length than most vectors (the smaller of two lengths equally frequent). Repeated rows (same id and vector)
count once; of one id with different vectors each vector counts. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparring.session import materialize

#: Tables, rows of a block, rows of a band that is searched whole, cells of a table as long as they fit a block.
TABLES, BLOCK_ROWS, WHOLE_ROWS, GROUPS = 8, 16_384, 64, 8


def probe_count(dimensions: int) -> int:
    """Axes that a query visits in each table: a share of all that grows with the dimension.

    Chosen on random directions, the hardest case, of 4,000 to 20,000 rows with equal and lognormal lengths.
    """
    axes = 2 * padded(dimensions + 1)
    return math.ceil(axes * (1 / 8 if dimensions <= 128 else 3 / 16 if dimensions <= 512 else 1 / 4))


def padded(dimensions: int) -> int:
    return 1 << max(0, dimensions - 1).bit_length()


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of signs and Hadamard transform of each row; `signs` [3, a power of two]."""
    n, size = len(x), signs.shape[1]
    x = np.hstack([x, np.zeros((n, size - x.shape[1]))])
    for sign in signs:
        x = x * sign
        half = 1
        while half < size:
            pairs = x.reshape(n, size // (2 * half), 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
            half *= 2
        x = x / math.sqrt(size)
    return x


def table_signs(tables: int, dimensions: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, padded(dimensions)))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the rows that take part, each once, vectors in double precision."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    size = common[0]["n"] if common else 0
    return rows.where(F.size("v") == size).select("vec_id", F.transform("v", lambda x: x + 0.0).alias("v"))


def smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """Of each vector the `most` smallest ids. Tasks keep their own smallest before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return rows.withColumn("n", rank).where(F.col("n") <= most).drop("n")


def log_length() -> Column:
    """Binary logarithm of the length of `v`, also where its square is out of range."""
    most = F.array_max(F.transform("v", F.abs))
    return F.log2(most) + F.log2(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / most) * (x / most))) / 2


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and the binary logarithm of each row's length."""
    most = np.abs(x).max(1)
    x = x / most[:, None]
    length = np.sqrt((x * x).sum(1))
    return x / length[:, None], np.log2(most) + np.log2(length)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    probes: int | None = None,
    block_rows: int = BLOCK_ROWS,
    whole_rows: int = WHOLE_ROWS,
) -> DataFrame:
    """The `k` nearest found for each query row (`is_query` on `vec_id`): query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).distinct()
    indexed = smallest_ids(rows, k + 1).withColumn("band", F.floor(2 * log_length() + 0.5).cast("int"))
    # A row for each band; doubles have about 4,300.
    facts = indexed.groupBy("band").agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size"), F.max(log_length()).alias("top"))
    facts = sorted(facts.collect(), key=lambda r: r["band"])
    size = facts[0]["size"] if facts else 1
    signs = table_signs(tables, size + 1)
    axes = 2 * signs.shape[2]
    visited = min(probes or probe_count(size), axes)
    # Of each hashed band: longest length, first cell, cells of a table. Cell 0 has the bands that are searched whole.
    bands: dict[int, tuple[float, int, int]] = {}
    cells = 1
    for fact in facts:
        if fact["n"] > whole_rows:
            # Two levels only, so that the copies of a query don't grow with the rows.
            groups = min(axes, GROUPS) if fact["n"] <= GROUPS * block_rows else axes
            bands[fact["band"]] = fact["top"], cells, groups
            cells += groups * tables
    some_whole = len(bands) < len(facts)
    asked = rows.where(is_query)
    distinct = asked.groupBy("v").agg(F.min("vec_id").alias("query"))

    def towards(x: np.ndarray, table: int) -> np.ndarray:
        turned = rotated(x, signs[table])
        return np.hstack([turned, -turned])

    place_type = pa.list_(pa.struct([("cell", pa.int32()), ("axis", pa.int32())]))
    visit_type = pa.list_(pa.struct([("cell", pa.int32()), ("axes", pa.list_(pa.int32()))]))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, length = directions(matrix(batch.column(1)))
            band = batch.column(2).to_pylist()
            top, first, groups = np.array([bands.get(b, (0.0, 0, 0)) for b in band]).T
            share = np.exp2(np.minimum(length - top, 0))
            x = np.hstack([x * share[:, None], np.sqrt(1 - share * share)[:, None]])
            axis = np.stack([towards(x, t).argmax(1) for t in range(tables)], 1)
            cell = (first[:, None] + np.arange(tables) * groups[:, None] + axis * groups[:, None] // axes).astype(int)
            places = [
                [{"cell": c, "axis": a} for c, a in zip(cs, ax)] if b in bands else [{"cell": 0, "axis": 0}]
                for b, cs, ax in zip(band, cell.tolist(), axis.tolist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, place_type)], ["vec_id", "v", "at"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, _ = directions(matrix(batch.column(1)))
            visits = [[{"cell": 0, "axes": [0]}] if some_whole else [] for _ in range(len(x))]
            x = np.hstack([x, np.zeros((len(x), 1))])
            for t in range(tables if bands else 0):
                best = np.sort(np.argsort(-towards(x, t), axis=1, kind="stable")[:, :visited], axis=1)
                for _, first, groups in bands.values():
                    for seen, row, cell in zip(visits, best, first + t * groups + best * groups // axes):
                        edges = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
                        seen.extend({"cell": cell[s], "axes": row[s:e]} for s, e in zip(edges, edges[1:]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visits, visit_type)], ["query", "v", "at"])

    placed = indexed.select("vec_id", "v", "band").mapInArrow(index, "vec_id long, v array<double>, at array<struct<cell:int,axis:int>>")
    placed = placed.select("vec_id", "v", F.inline("at"))
    visits = distinct.select("query", "v").mapInArrow(visit, "query long, v array<double>, at array<struct<cell:int,axes:array<int>>>")
    visits = visits.select("query", "v", F.inline("at"))

    def block_counts(rows: DataFrame, name: str) -> DataFrame:
        """Blocks of each cell; at most tables * axes rows for each hashed band."""
        counted = rows.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name)).collect()
        return F.broadcast(spark.createDataFrame([(r["cell"], r[name]) for r in counted], f"cell int, {name} int"))

    def search(queries: pa.Table, members: pa.Table) -> pa.Table:
        # Queries in slices, so that the score matrices and what is kept of them stay small.
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and members.num_rows:
            q_id, m_id, axis = queries.column("query").to_numpy(), members.column("vec_id").to_numpy(), members.column("axis").to_numpy()
            q, m = matrix(queries.column("v").combine_chunks()), matrix(members.column("v").combine_chunks())
            order = np.argsort(axis, kind="stable")
            m_id, m, axis = m_id[order], m[order], axis[order]
            edges = [0, *(np.flatnonzero(np.diff(axis)) + 1).tolist(), len(axis)]
            lists = queries.column("axes").combine_chunks()
            for start in range(0, len(q), 256):
                visit = lists.slice(start, 256)
                wanted = visit.flatten().to_numpy()
                owner = start + np.repeat(np.arange(len(visit)), visit.value_lengths().to_numpy())
                parts = [best_of_axis(q, owner[wanted == axis[s]], m[s:e], s) for s, e in zip(edges, edges[1:])]
                row, at, exact = (np.concatenate(p) for p in zip(*parts))
                order = np.lexsort((m_id[at], -exact, row))
                row, at, exact = row[order], at[order], exact[order]
                first = np.flatnonzero(np.diff(row, prepend=-1))
                keep = np.arange(len(row)) - np.repeat(first, np.diff([*first, len(row)])) < k + 1
                found.append((q_id[row[keep]], m_id[at[keep]], exact[keep]))
        parts = [np.concatenate([f[n] for f in found]) if found else np.zeros(0, kind) for n, kind in enumerate((np.int64, np.int64, float))]
        return pa.table([pa.array(p) for p in parts], ["query", "vec_id", "score"])

    def best_of_axis(q: np.ndarray, asking: np.ndarray, m: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, place of the row, score): the best rows of one axis for the queries that visit it."""
        scores = q[asking] @ m.T
        most = min(k + 1, len(m))
        least = np.partition(scores, len(m) - most, axis=1)[:, len(m) - most]
        row, at = np.nonzero(scores >= (least - 1e-9 * (1 + abs(least)))[:, None])
        return asking[row], at + offset, (q[asking[row]] * m[at]).sum(1)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def found_in(visits: DataFrame, placed: DataFrame) -> DataFrame:
        """(query, vec_id, score): the best k + 1 rows of each query among the cells it visits."""
        m_counts, q_counts = block_counts(placed, "m_blocks"), block_counts(visits, "q_blocks")

        def blocked(rows: DataFrame, own: str, other: str, id_name: str) -> DataFrame:
            """Each row in one block of its own side, copied to every block of the other side."""
            rows = rows.join(m_counts, "cell").join(q_counts, "cell")
            rows = rows.withColumn(own, F.pmod(F.xxhash64(id_name), F.col(f"{own}s")).cast("int"))
            return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("m_blocks", "q_blocks")

        keys = ("cell", "m_block", "q_block")
        queries, members = blocked(visits, "q_block", "m_block", "query"), blocked(placed, "m_block", "q_block", "vec_id")
        pairs = queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(search, "query long, vec_id long, score double")
        # The same row found in several tables has the same score; one of id and score stays.
        few = pairs.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        return few.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")

    few = materialize(found_in(visits, placed), "nearest")
    owed = indexed.select("vec_id").distinct().limit(k + 1).count()
    served = few.groupBy("query").count().where(F.col("count") >= owed).select("query")
    short = materialize(distinct.select("query", "v").join(served, "query", "left_anti"), "nearest-short")
    if not short.isEmpty():
        everything = indexed.select("vec_id", "v", F.lit(0).alias("cell"), F.lit(0).alias("axis"))
        again = short.select("query", "v", F.lit(0).alias("cell"), F.array(F.lit(0)).alias("axes"))
        few = few.join(served, "query", "left_semi").unionByName(found_in(again, everything))
    names = asked.join(distinct, "v").select(F.col("vec_id").alias("query_id"), "query")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = names.join(few, "query").where(F.col("query_id") != F.col("vec_id"))
    answers = answers.withColumn("rank", F.row_number().over(own).cast("int")).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")


def search_twentieths(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """The `k` nearest of every row whose vec_id is divisible by 20."""
    return nearest(embeddings, F.col("vec_id") % 20 == 0, k)
