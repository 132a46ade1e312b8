"""Benchmark decontamination with spaced seeds.

A seed is six words at the places of a mask, the words between them left out. Three masks are hashed at every word of
the benchmark and of the documents; equal hashes are joined, and around each hit the words of both sides are compared.
A document is contaminated by an item if WINDOW consecutive words of both (or the whole item, if shorter) agree but for
a few substituted words. The masks find every such window: some mask avoids any two substitutions in 13 words, and any
one in 8.

Words are split at ASCII white space, A-Z lower-cased, ASCII punctuation at their ends dropped, and empty ones left
out. Items of under LEAST_WORDS words are searched as whole runs without substitutions; null and empty texts have no
words. Texts are read whole. Repeated rows of documents give the same findings once; rows of a null id are searched
like others and reported under null. Surroundings that several items share are compared once and reported for each of
them. Empty tables give empty results. Other columns are ignored, or pass through `decontaminate` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import mixed, slices, window_hashes, word_hashes
from sparring.session import materialize

MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 1, 3, 5, 6, 7))
WINDOW, LEAST_WORDS = 13, 8
#: Words before and after a seed's first word that a window holding the seed can reach.
BEFORE, AFTER = 7, 12
AROUND = b".,;:!?\"'()[]{}"
#: Bits of the filter that keeps documents' seeds out of the shuffle which no item has: 2 MB, whatever the input.
FILTER_BITS = 24


def substitutions(words: int) -> int:
    """Substituted words that a window of so many words may have."""
    return 2 if words >= WINDOW else 1 if words >= LEAST_WORDS else 0


def normal_words(text: bytes | None) -> list[bytes]:
    return [w for w in (x.strip(AROUND) for x in text.lower().split()) if w] if text else []


def seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of every seed in a sequence of word hashes."""
    found, places = [], []
    for number, mask in enumerate(MASKS):
        n = len(hashes) - mask[-1]
        if n > 0:
            value = np.full(n, number + 1, np.uint64)
            for k in mask:
                value = (value ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(32)
            found.append(mixed(value))
            places.append(np.arange(n))
    return (np.concatenate(found), np.concatenate(places)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def whole_run(hashes: np.ndarray, width: int) -> np.ndarray:
    """The seed of each run of `width` words, fewer than a mask needs."""
    return window_hashes(hashes, width, len(MASKS) + width)


def contexts(hashes: np.ndarray, places: np.ndarray, outside: int) -> np.ndarray:
    """Word hashes around each place, `outside` beyond the ends."""
    padded = np.concatenate([np.full(BEFORE, outside, np.uint64), hashes, np.full(AFTER, outside, np.uint64)])
    return padded[places[:, None] + np.arange(BEFORE + AFTER + 1)]


def bit_places(hashes: np.ndarray) -> np.ndarray:
    return np.stack([hashes >> np.uint64(64 - FILTER_BITS), hashes & np.uint64((1 << FILTER_BITS) - 1)]).astype(np.int64)


def binaries(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """(seed, item_around, item_before, item_after, width, item_id): every seed of the items with its surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                hashes = word_hashes(normal_words(text))
                if len(hashes):
                    value, place = seeds(hashes) if len(hashes) >= LEAST_WORDS else (whole_run(hashes, len(hashes)), np.zeros(1, np.int64))
                    n = len(value)
                    yield pa.record_batch(
                        [
                            pa.array(value.view(np.int64)),
                            binaries(contexts(hashes, place, 0)),
                            # Only as far as a window reaches, so that equal surroundings are equal rows.
                            pa.array(np.minimum(place, BEFORE).astype(np.int32)),
                            pa.array(np.minimum(len(hashes) - place, AFTER + 1).astype(np.int32)),
                            pa.array(np.full(n, min(len(hashes), WINDOW), np.int32)),
                            pa.array([item] * n, pa.int64()),
                        ],
                        ["seed", "item_around", "item_before", "item_after", "width", "item_id"],
                    )

    rows = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        run, "seed long, item_around binary, item_before int, item_after int, width int, item_id long"
    )
    key = F.concat_ws("|", "seed", F.hex("item_around"), "item_before", "item_after", "width")
    return rows.withColumn("context", F.md5(key)).distinct()


def seed_filter(items: DataFrame) -> np.ndarray:
    """The bits of all items' seeds, as 64-bit words; at most 2**(FILTER_BITS - 6) rows reach the driver."""
    low = F.col("seed").bitwiseAND((1 << FILTER_BITS) - 1)
    place = F.explode(F.array(F.shiftrightunsigned("seed", 64 - FILTER_BITS), low)).alias("place")
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = items.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in words.collect():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def document_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(seed, doc_id, text_hash, place, around) of documents' seeds that pass the filter."""
    short = [r["width"] for r in items.where(F.col("width") < LEAST_WORDS).select("width").distinct().collect()]  # at most 7
    sent = docs.sparkSession.sparkContext.broadcast(seed_filter(items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in slices(batches, 1):
            ids, codes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for doc, text, code in zip(ids, batch.column(1).cast(pa.binary()).to_pylist(), codes):
                hashes = word_hashes(normal_words(text))
                value, place = seeds(hashes)
                for width in short:
                    # The first of equal runs is enough.
                    run_hash, first = np.unique(whole_run(hashes, width), return_index=True)
                    value, place = np.concatenate([value, run_hash]), np.concatenate([place, first])
                at = bit_places(value)
                hit = (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool).all(0)
                value, place = value[hit], place[hit]
                for start in range(0, len(value), 8192):
                    v, p = value[start : start + 8192], place[start : start + 8192]
                    yield pa.record_batch(
                        [
                            pa.array(v.view(np.int64)),
                            pa.array([doc] * len(v), pa.int64()),
                            pa.array([code] * len(v), pa.int64()),
                            pa.array(p),
                            binaries(contexts(hashes, p, 1)),
                        ],
                        ["seed", "doc_id", "text_hash", "place", "around"],
                    )

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "seed long, doc_id long, text_hash long, place long, around binary")


def verified(pairs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, context, start, width): the windows around hits that agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            size = BEFORE + AFTER + 1
            doc, item = (np.frombuffer(b"".join(columns[c].to_pylist()), np.uint64).reshape(-1, size) for c in ("around", "item_around"))
            before, after, width = (columns[c].to_numpy() for c in ("item_before", "item_after", "width"))
            differ = np.cumsum(np.hstack([np.zeros((len(doc), 1), np.int64), doc != item]), 1)
            outside = np.cumsum(np.hstack([np.zeros((len(doc), 1), np.int64), doc == 1]), 1)
            start = np.full(len(doc), -1)
            rows = np.arange(len(doc))
            for first in range(BEFORE + 1):
                end = first + width
                fits = (first >= BEFORE - before) & (end <= BEFORE + after) & (end <= size)
                end = np.minimum(end, size)
                wrong = differ[rows, end] - differ[:, first]
                allowed = np.where(width >= WINDOW, substitutions(WINDOW), np.where(width >= LEAST_WORDS, substitutions(LEAST_WORDS), 0))
                good = fits & (wrong <= allowed) & (outside[rows, end] == outside[:, first])
                start = np.where((start < 0) & good, first, start)
            chosen = start >= 0
            at = columns["place"].to_numpy() - BEFORE + start
            out = [columns["doc_id"], columns["text_hash"], columns["context"], pa.array(at), pa.array(width.astype(np.int64))]
            yield pa.record_batch(out, ["doc_id", "text_hash", "context", "start", "width"]).filter(pa.array(chosen))

    return pairs.mapInArrow(run, "doc_id long, text_hash long, context string, start long, width long")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, first_word, end_word, n_hits): where documents repeat benchmark items."""
    items = materialize(item_seeds(benchmark), "item-seeds")
    distinct = items.drop("item_id").distinct()
    pairs = document_hits(docs, items).join(distinct, "seed")
    return (
        verified(pairs)
        .join(items.select("context", "item_id"), "context")
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.min("start").alias("first_word"), F.max(F.col("start") + F.col("width")).alias("end_word"), F.count("*").alias("n_hits"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, end_word, n_hits), a row for each contaminated document and item."""
    return leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.max("n_hits").alias("n_hits")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that repeat no benchmark item."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(found["_leak_id"]) & (F.xxhash64(docs["text"]) == found["_leak_hash"])
    return docs.join(found, same, "left_anti")
