"""Removal of lines repeated across documents, with two Bloom filters.

One scan hashes every line's key and sets bits in two filters: keys seen once, and keys seen again. Filters are cut
into blocks, filled by each task for its own rows and merged block by block (a bit set in both sides' first filters
goes to the second). The second filter has a fixed size and is sent to all tasks; only keys that it suspects of a
repeat are shuffled, counted exactly and joined back. A larger corpus makes more suspects, never another result.

A line's key is the line without the ASCII white space at both ends, with A-Z lower-cased. Keys of at least
`min_chars` code points found in at least `min_docs` documents lose all their lines except in the largest id holding
one. Null and empty texts have one empty line. Rows of one id are one document: the rule holds for each of its rows.
Rows of null id count for nothing and are kept as they are. Keys are compared by SHA-256. Columns of the input pass
through, except those named like an output column (n_lines, n_dropped), which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import mixed, slices, unused_name
from sparring.session import materialize

#: Bits of each filter: 8 MB, whatever the input. Each key sets two bits.
FILTER_BITS = 26
BLOCK_BITS = 16
#: Keys hashed before a task hands its filters on, and then starts new ones.
FLUSH_KEYS = 8 << 20
#: Counts of one row between tasks.
CELLS = 4096
NOTHING = np.zeros(0, np.uint64)


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of each line, None where it is too short to count."""
    keys = [line.strip().lower() for line in text.split(b"\n")]
    return [k if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8", "replace")) >= min_chars) else None for k in keys]


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each hash."""
    return np.stack([hashes >> np.uint64(64 - bits), mixed(hashes) >> np.uint64(64 - bits)]).astype(np.int64)


def hash_keys(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def packed_bits(flags: np.ndarray) -> bytes:
    """A block's set bits, as two-byte positions or as a bit map, whichever is shorter."""
    at = np.flatnonzero(flags)
    return at.astype(np.uint16).tobytes() if 2 * len(at) < len(flags) // 8 else np.packbits(flags).tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    """The bit map of a packed block."""
    if len(data) == size // 8:
        return np.frombuffer(data, np.uint8)
    flags = np.zeros(size, bool)
    flags[np.frombuffer(data, np.uint16)] = True
    return np.packbits(flags)


def twice_filter(rows: DataFrame, hashes_of: Callable[[bytes], tuple[np.ndarray, np.ndarray]], bits: int, cell_bits: int = 0) -> tuple[bytes, np.ndarray]:
    """The filter of hashes seen in two rows (id, text) or more, as a bit map of 2**bits bits, and counts by first bits.

    `hashes_of` gives the distinct hashes of one text, and hashes that are counted by their first `cell_bits` bits. Rows
    of null id are left out.
    """
    block_bits = min(BLOCK_BITS, bits - 3)
    size = 1 << block_bits

    def blocks(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(once) // size, 64):
            some = [k for k in range(start, min(start + 64, len(once) // size)) if once[k * size : (k + 1) * size].any()]
            parts = [[packed_bits(f[k * size : (k + 1) * size]) for k in some] for f in (once, twice)]
            yield pa.record_batch([pa.array(some, pa.int32()), *(pa.array(p, pa.binary()) for p in parts)], ["block", "once", "twice"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, seen, cells = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool), 0, np.zeros(1 << cell_bits, np.int64)
        for batch in slices(batches, 1):
            found = [hashes_of(t) for i, t in zip(batch.column(0).to_pylist(), as_texts(batch.column(1))) if i is not None]
            hashes, counts = np.unique(np.concatenate([*(f for f, _ in found), np.zeros(0, np.uint64)]), return_counts=True)
            if cell_bits:
                counted = np.concatenate([*(c for _, c in found), np.zeros(0, np.uint64)]) >> np.uint64(64 - cell_bits)
                cells += np.bincount(counted.astype(np.int64), minlength=len(cells))
            at = places(hashes, bits)
            again = once[at].all(0) | (counts > 1)
            twice[at[:, again]] = True
            once[at] = True
            seen += len(hashes)
            if seen > FLUSH_KEYS:
                yield from blocks(once, twice)
                once[:], twice[:], seen = False, False, 0
        yield from blocks(once, twice)
        # Counts travel as blocks of numbers below zero.
        some = [k for k in range(0, len(cells), CELLS) if cells[k : k + CELLS].any()]
        counted = [pa.array([-1 - k for k in some], pa.int32()), pa.array([cells[k : k + CELLS].tobytes() for k in some], pa.binary())]
        yield pa.record_batch([*counted, pa.nulls(len(some), pa.binary())], ["block", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[np.ndarray]] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, once, twice in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if block < 0:
                    counts[block] = counts.get(block, 0) + np.frombuffer(once, np.int64)
                    continue
                new = [unpacked(once, size), unpacked(twice, size)]
                if old := known.get(block):
                    new = [old[0] | new[0], old[1] | new[1] | (old[0] & new[0])]
                known[block] = new
        for block in known:
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([known[block][1].tobytes()], pa.binary())], ["block", "twice"])
        for block in counts:
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([counts[block].tobytes()], pa.binary())], ["block", "twice"])

    parts = rows.mapInArrow(fill, "block int, once binary, twice binary")
    merged = parts.repartition("block").mapInArrow(merge, "block int, twice binary")
    whole, total = bytearray((1 << bits) // 8), np.zeros(1 << cell_bits, np.int64)
    for row in merged.collect():
        if row["block"] < 0:
            start = -1 - row["block"]
            total[start : start + CELLS] = np.frombuffer(bytes(row["twice"]), np.int64)
        else:
            start = row["block"] * (size // 8)
            whole[start : start + size // 8] = row["twice"]
    return bytes(whole), total


def in_filter(bitmap: bytes, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes a filter holds."""
    at = places(hashes, bits)
    return (np.frombuffer(bitmap, np.uint8)[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool).all(0)


def as_texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def suspects(docs: DataFrame, text_col: str, id_col: str, min_chars: int, bits: int) -> DataFrame:
    """(doc_id, key): the keys of each row that the second filter holds, as SHA-256."""
    hashes_of = lambda text: (hash_keys(list(set(line_keys(text, min_chars)) - {None})), NOTHING)
    sent = docs.sparkSession.sparkContext.broadcast(twice_filter(docs.select(id_col, text_col), hashes_of, bits)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in slices(batches, 1):
            ids, keys = [], []
            for i, text in zip(batch.column(0).to_pylist(), as_texts(batch.column(1))):
                own = list(set(line_keys(text, min_chars)) - {None}) if i is not None else []
                ids += [i] * len(own)
                keys += own
            chosen = np.flatnonzero(in_filter(bitmap, hash_keys(keys), bits)).tolist()
            yield pa.record_batch(
                [pa.array([ids[k] for k in chosen], batch.schema.types[0]), pa.array([hashlib.sha256(keys[k]).digest() for k in chosen], pa.binary())],
                ["doc_id", "key"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, "doc_id long, key binary")


def drop_repeated_lines(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_docs: int = 3, min_chars: int = 20, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """`docs` with `text_col` without its repeated lines, n_lines (before) and n_dropped."""
    base = docs.drop("n_lines", "n_dropped")
    found = materialize(suspects(docs, text_col, id_col, min_chars, filter_bits), "line-suspects")
    repeated = found.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)
    repeated = materialize(repeated, "repeated-lines")  # so that the join is one of plain shuffles, which Spark splits if skewed
    lost = found.join(repeated, "key").where(F.col("doc_id") != F.col("keeper"))
    # A document's own keys only: bounded by its text.
    per_doc = lost.groupBy(F.col("doc_id").alias("_lost_id")).agg(F.collect_set("key").alias("_lost"))
    joined = base.join(per_doc, base[id_col] == per_doc["_lost_id"], "left").select(base["*"], per_doc["_lost"].alias(unused_name(base, "_lost")))
    names, at = base.columns, base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(as_texts(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist()):
                lines = text.split(b"\n")
                kept = lines
                if lost:
                    gone = set(lost)
                    keys = line_keys(text, min_chars)
                    kept = [line for line, k in zip(lines, keys) if k is None or hashlib.sha256(k).digest() not in gone]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [*batch.columns[:at], pa.array(texts, pa.binary()).cast(pa.string()), *batch.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines), pa.array(n_dropped)], [*names, "n_lines", "n_dropped"])

    zero = F.lit(0).cast("long")
    return joined.mapInArrow(run, base.select("*", zero.alias("n_lines"), zero.alias("n_dropped")).schema)


def line_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and SHA-256 of what is left."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )
