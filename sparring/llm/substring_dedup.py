"""Removal of repeated word sequences with super-k-mer partitioning.

A window is 13 consecutive words of one document. Its minimiser is the smallest hash among its runs of three words;
consecutive windows that share a minimiser are one super-k-mer and travel as one packed string of words to the bucket
of the minimiser. There the windows are coded exactly, sorted, and each gets the smallest document id that holds it.
Strings with a window that another, smaller id holds are joined back to the documents by a 128-bit hash.

Before that, a scan of the minimisers plans the shuffle: a filter of fixed size keeps back windows whose minimiser
stands in one document only (they repeat nowhere else), and counts per cell of minimisers give buckets of at most about
BUCKET_WINDOWS windows. A cell far above the mean (one very common minimiser) sends its windows one by one, to buckets
by the hash of the window, so that only equal windows have to meet. Equal strings of one slice of texts travel once.

Each word covered by a window whose words also start a window in a document of smaller id is removed; windows are
judged on the input. Words are split at ASCII white space and otherwise unchanged, whole texts are read, and kept words
are joined by one space. Null, empty and short texts have no window. Rows of one id are one document: they don't
repeat each other. Rows of null id take no part and lose nothing. Empty tables give empty results. Columns of the input
pass through, except those named like an output column (n_words, n_removed), which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import mixed, slices, unused_name, window_hashes, word_hashes
from sparring.llm.line_dedup import as_texts, in_filter, twice_filter
from sparring.session import materialize

WINDOW, MINIMISER = 13, 3
FILTER_BITS, CELL_BITS = 26, 16
#: Bits of the filter of answered strings, and the bytes of a key at which its two places stand.
KEY_BITS, KEY_STARTS = 24, (1, 4)
BUCKET_WINDOWS = 250_000
#: A cell is split window by window if it has so many times the mean.
UNEVEN = 8


def minimisers(hashes: np.ndarray) -> np.ndarray:
    """The minimiser of each window of a sequence of word hashes."""
    runs = window_hashes(hashes, MINIMISER)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = runs[:n].copy()
    for k in range(1, WINDOW - MINIMISER + 1):
        np.minimum(least, runs[k : k + n], out=least)
    return mixed(least)


def cell(minimiser: np.ndarray) -> np.ndarray:
    return (minimiser >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def minimiser_set(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct minimisers of a text, and those of all its windows."""
    least = minimisers(word_hashes(text.split()))
    return np.unique(least), least


def bucket_plan(loads: np.ndarray, size: int) -> dict:
    """For each cell its first bucket, its number of buckets, and whether windows go to them one by one."""
    ways = np.maximum(1, -(-loads // size))
    alone = loads > np.maximum(size, UNEVEN * loads.mean())
    large = ways > 1
    # Cells of one bucket share buckets; the others have their own, numbered after those.
    shared = np.cumsum(np.where(large, 0, loads)) // size
    own = shared.max() + 1 + np.cumsum(np.where(large, ways, 0)) - np.where(large, ways, 0)
    return {"first": np.where(large, own, shared), "ways": ways, "alone": alone if alone.any() else None}


def super_kmers(hashes: np.ndarray, bitmap: bytes, plan: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, minimiser) of the super-k-mers of a text that may be repeated, in windows."""
    least = minimisers(hashes)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), least
    edge = least[1:] != least[:-1]
    if plan["alone"] is not None:
        edge |= plan["alone"][cell(least[1:])]
    starts = np.concatenate([[0], np.flatnonzero(edge) + 1])
    passed = in_filter(bitmap, least[starts], FILTER_BITS)
    return starts[passed], np.append(starts[1:], len(least))[passed], least[starts[passed]]


def buckets(hashes: np.ndarray, starts: np.ndarray, least: np.ndarray, plan: dict) -> np.ndarray:
    """The bucket of each super-k-mer; those of cells that are split window by window go by their words."""
    place = cell(least)
    choice = mixed(least)
    if plan["alone"] is not None and (alone := plan["alone"][place]).any():
        choice[alone] = window_hashes(hashes, WINDOW, 7)[starts[alone]]
    return plan["first"][place] + (choice % plan["ways"][place].astype(np.uint64)).astype(np.int64)


def packed_rows(rows: DataFrame, bitmap: object, plan: object) -> DataFrame:
    """(bucket, packed, low, high): super-k-mers with the smallest and largest id that holds them, once for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found: dict[bytes, list[int]] = {}
            for doc, text in zip(batch.column(0).to_pylist(), as_texts(batch.column(1))):
                if doc is not None:
                    words = text.split()
                    hashes = word_hashes(words)
                    starts, ends, least = super_kmers(hashes, bitmap.value, plan.value)
                    places = buckets(hashes, starts, least, plan.value).tolist()
                    for bucket, start, end in zip(places, starts.tolist(), (ends + WINDOW - 1).tolist()):
                        packed = b" ".join(words[start:end])
                        old = found.get(packed)
                        if old is None:
                            found[packed] = [bucket, doc, doc]
                        elif doc < old[1]:
                            old[1] = doc
                        elif doc > old[2]:
                            old[2] = doc
            values = np.array(list(found.values()), np.int64).reshape(len(found), 3)
            yield pa.record_batch(
                [pa.array(values[:, 0]), pa.array(list(found), pa.binary()), pa.array(values[:, 1]), pa.array(values[:, 2])], ["bucket", "packed", "low", "high"]
            )

    return rows.mapInArrow(run, "bucket long, packed binary, low long, high long")


def first_holders(bucket: pa.Table) -> pa.Table:
    """(key, firsts) of a bucket's strings that may lose words: for each window the smallest id that holds it."""
    packed = bucket.column("packed").combine_chunks()
    low, high = (bucket.column(c).to_numpy() for c in ("low", "high"))
    split = pc.split_pattern(packed.cast(pa.string()), " ")
    codes = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    windows = lengths - WINDOW + 1
    owner = np.repeat(np.arange(len(lengths)), windows)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[owner]
    hashed = window_hashes(mixed(codes.astype(np.uint64) + np.uint64(1)), WINDOW)[at]
    order = np.argsort(hashed, kind="stable")

    def unequal(order: np.ndarray) -> np.ndarray:
        return np.any([codes[at[order[1:]] + k] != codes[at[order[:-1]] + k] for k in range(WINDOW)], axis=0)

    differs = unequal(order)
    if (differs & (hashed[order[1:]] == hashed[order[:-1]])).any():  # equal hashes of unequal windows: sort by the words
        order = np.lexsort([codes[at + k] for k in range(WINDOW)])
        differs = unequal(order)
    groups = np.flatnonzero(np.concatenate([[True], differs]))
    smallest = np.minimum.reduceat(low[owner[order]], groups)
    firsts = np.empty(len(owner), np.int64)
    firsts[order] = np.repeat(smallest, np.diff([*groups, len(order)]))
    offsets = np.cumsum(windows) - windows
    lost = np.minimum.reduceat(firsts, offsets) < high
    keys = [xxhash.xxh3_128_digest(p) for p in packed.filter(pa.array(lost)).to_pylist()]
    ends = np.concatenate([[0], np.cumsum(windows[lost])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(firsts[np.repeat(lost, windows)]))
    return pa.table([pa.array(keys, pa.binary()), lists], ["key", "firsts"])


def named_strings(firsts: DataFrame) -> np.ndarray:
    """Two bits for each key of `firsts`, merged by executors; the driver gets at most 2**(KEY_BITS - 6) words of 64 bits."""
    places = F.array(*(F.conv(F.hex(F.substring("key", start, KEY_BITS // 8)), 16, 10).cast("long") for start in KEY_STARTS))
    words = firsts.select(F.explode(places).alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
    out = np.zeros(1 << (KEY_BITS - 6), np.int64)
    for row in words.agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits")).collect():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def may_be_named(keys: list[bytes], bits: np.ndarray) -> np.ndarray:
    data = np.frombuffer(b"".join(keys), np.uint8).reshape(len(keys), -1).astype(np.int64)
    known = np.ones(len(keys), bool)
    for start in KEY_STARTS:
        place = data[:, start - 1] << 16 | data[:, start] << 8 | data[:, start + 1]
        known &= (bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return known


def string_places(rows: DataFrame, bitmap: object, plan: object, named: object) -> DataFrame:
    """(doc_id, text_hash, key, start): where each document has super-k-mers that `named` may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            docs, codes, at, counts, keys = [], [], [], [], []
            for doc, text, code in zip(batch.column(0).to_pylist(), as_texts(batch.column(1)), batch.column(2).to_pylist()):
                if doc is not None:
                    words = text.split()
                    starts, ends, _ = super_kmers(word_hashes(words), bitmap.value, plan.value)
                    keys += [xxhash.xxh3_128_digest(b" ".join(words[s:e])) for s, e in zip(starts.tolist(), (ends + WINDOW - 1).tolist())]
                    docs.append(doc)
                    codes.append(code)
                    at.append(starts)
                    counts.append(len(starts))
            if keys:
                good = np.flatnonzero(may_be_named(keys, named.value))
                columns = [np.repeat(np.array(c, np.int64), counts)[good] for c in (docs, codes)]
                names = ["doc_id", "text_hash", "key", "start"]
                yield pa.record_batch([*map(pa.array, columns), pa.array([keys[k] for k in good.tolist()], pa.binary()), pa.array(np.concatenate(at)[good])], names)

    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, key binary, start long")


def remove_repeated_windows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """`docs` with `text_col` reduced to the kept words, n_words (before) and n_removed."""
    context = docs.sparkSession.sparkContext
    base = docs.drop("n_words", "n_removed")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    repeated, loads = twice_filter(rows, minimiser_set, FILTER_BITS, CELL_BITS)
    bitmap, plan = context.broadcast(repeated), context.broadcast(bucket_plan(loads, bucket_windows))
    firsts = packed_rows(rows, bitmap, plan).groupBy("bucket").applyInArrow(first_holders, "key binary, firsts array<long>")
    # A string that several slices sent is answered once for each; the answers are equal.
    firsts = materialize(firsts.dropDuplicates(["key"]), "first-holders")
    found = string_places(rows, bitmap, plan, context.broadcast(named_strings(firsts))).join(firsts, "key")
    gone = F.filter(F.transform("firsts", lambda x, k: F.when(x < F.col("doc_id"), F.col("start") + k)), lambda x: x.isNotNull())
    lost = found.select("doc_id", "text_hash", gone.alias("gone")).where(F.size("gone") > 0)
    # A document's own windows only: bounded by its text.
    per_doc = lost.groupBy(F.col("doc_id").alias("_lost_id"), F.col("text_hash").alias("_lost_hash")).agg(F.flatten(F.collect_list("gone")).alias("_lost"))
    same = (base[id_col].cast("long") == per_doc["_lost_id"]) & (F.xxhash64(base[text_col]) == per_doc["_lost_hash"])
    joined = base.join(per_doc, same, "left").select(base["*"], per_doc["_lost"].alias(unused_name(base, "_lost")))
    names, at = base.columns, base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts, n_words, n_removed = [], [], []
            for text, lost in zip(as_texts(batch.column(at)), batch.column(batch.num_columns - 1)):
                words = text.split()
                kept = words
                if lost.is_valid:
                    depth = np.zeros(len(words) + WINDOW + 1, np.int64)
                    starts = lost.values.to_numpy()
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + WINDOW, -1)
                    stay = np.cumsum(depth)[: len(words)] == 0
                    kept = [words[k] for k in np.flatnonzero(stay).tolist()]
                texts.append(b" ".join(kept))
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
            columns = [*batch.columns[:at], pa.array(texts, pa.binary()).cast(pa.string()), *batch.columns[at + 1 : -1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], [*names, "n_words", "n_removed"])

    zero = F.lit(0).cast("long")
    return joined.mapInArrow(run, base.select("*", zero.alias("n_words"), zero.alias("n_removed")).schema)


def substring_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and SHA-256 of the kept words joined by one space."""
    return remove_repeated_windows(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )
