"""Phrase collocations, counted by prefix-free parsing.

Every text is parsed into words and separators and cut at triggers: runs of three words whose hash is a multiple of
MODULUS. A chunk reaches from one trigger to the end of the next, so neighbours overlap by three words, and equal
passages give equal chunks wherever they stand. The distinct chunks of a language form a dictionary with their
frequency in the parse. Phrases of up to four words are counted inside distinct chunks, each weighted by the chunk's
frequency. A phrase belongs to the chunk in which it begins before the last three words; every phrase of the corpus
therefore counts once, in one chunk. Three separators end a text, so that this rule also holds for its last words.

Before phrases are shuffled, an upper bound of each one's count is known from counters of fixed size, summed block by
block over the dictionary; phrases that it shows to be too rare, or that begin with such a phrase, stay behind. The
others are counted exactly by their text. On a corpus for which the counters are too few more goes through the
shuffle; no result changes.

A-Z are lower-cased, texts are split at [.,;:!?\\x0A-\\x0D] into pieces and those at space and tab into words. Phrases do
not cross pieces. A null text is empty, a null language is `und`. All rows count, also repeated ones and those of null
or repeated ids, which are not looked at. Ties are settled as `collocations` says. An empty table, or one without a
phrase frequent enough, gives an empty result. Other columns are ignored. Whole texts are read; one without any
trigger is one chunk.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparring.llm.common import mixed, slices, window_hashes, word_hashes
from sparring.session import materialize

LONGEST = 4
OVERLAP = LONGEST - 1
MODULUS = 16
#: Counters for the upper bounds; the filter made of them has one bit for each: 8 MB, whatever the input.
COUNTER_BITS, BLOCK_BITS = 26, 16
#: Bytes of chunks that a step inside a task counts at once.
CHUNK_BYTES = 1 << 20
#: Parts in which a language's phrases are ranked before the best of each part are ranked together.
PARTS = 64
SEPARATOR = b"."
SEPARATORS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", SEPARATOR * 9)
UNKNOWN = "und"


def tokens(text: bytes) -> list[bytes]:
    """The words of a text with a separator between pieces and three at the end; nothing if there is no word."""
    found = text.lower().translate(SEPARATORS).replace(SEPARATOR, b" . ").split()
    return [*found, *[SEPARATOR] * OVERLAP] if any(t != SEPARATOR for t in found) else []


def chunks(text: bytes) -> list[bytes]:
    """The overlapping chunks of a text, words joined by one space."""
    words = tokens(text)
    if not words:
        return []
    hashes = word_hashes(words)
    plain = hashes != word_hashes([SEPARATOR])[0]
    n = len(words) - OVERLAP
    trigger = window_hashes(hashes, OVERLAP)[:n] % np.uint64(MODULUS) == 0
    for k in range(OVERLAP):
        trigger &= plain[k : k + n]
    trigger[0] = True
    starts = np.flatnonzero(trigger).tolist()
    return [b" ".join(words[a : b + OVERLAP]) for a, b in zip(starts, [*starts[1:], n])]


def chunk_table(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, chunk, n): the distinct chunks of each language and how often the parse holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found.setdefault(lang, Counter()).update(chunks(text or b""))
            for lang, counts in found.items():
                yield pa.record_batch(
                    [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
                    ["lang", "chunk", "n"],
                )

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(run, "lang string, chunk string, n long")
    return parts.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def gathered(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of batches put together until column number `column` has about `limit` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, column, limit):
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class Grams:
    """The distinct phrases of a run of chunks (lang, chunk, n), by length; phrases are told apart exactly."""

    def __init__(self, batch: pa.RecordBatch):
        split = pc.split_pattern(batch.column(1), " ")
        lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        self.words, self.codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.langs = batch.column(0).dictionary_encode()
        hashes = word_hashes(self.words.cast(pa.binary()).to_pylist())
        self.hashes = hashes[self.codes]
        self.plain = self.hashes != word_hashes([SEPARATOR])[0]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lang = self.langs.indices.to_numpy().astype(np.int64)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        #: Where a phrase may begin, its language and its weight.
        self.starts = np.flatnonzero((place < lengths[owner] - OVERLAP) & self.plain)
        self.lang, self.weight = lang[owner[self.starts]], batch.column(2).to_numpy()[owner[self.starts]]
        self.lang_hashes = word_hashes(self.langs.dictionary.cast(pa.binary()).to_pylist())

    def word_counts(self) -> Iterator[tuple[str, int]]:
        """(language, number of words)."""
        for code, lang in enumerate(self.langs.dictionary.to_pylist()):
            yield lang, int(self.weight[self.lang == code].sum())

    def each(self, keep=lambda hashes: np.ones(len(hashes), bool)) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: length, first places, language codes, hashes and weights of the phrases that `keep` lets pass.

        Phrases are tried only if the phrase without their last word has passed.
        """
        at, lang, weight = self.starts, self.lang, self.weight
        number, hashed = lang, self.lang_hashes[lang]
        for size in range(1, LONGEST + 1):
            last = at + size - 1
            whole = self.plain[last]
            at, lang, weight, last = at[whole], lang[whole], weight[whole], last[whole]
            hashed = mixed(hashed[whole] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[last])
            _, first, number = np.unique(number[whole] << 32 | self.codes[last], return_index=True, return_inverse=True)
            total = np.zeros(len(first), np.int64)
            np.add.at(total, number, weight)
            good = keep(hashed[first])
            yield size, at[first][good], lang[first][good], hashed[first][good], total[good]
            stay = good[number]
            at, lang, weight, hashed, number = at[stay], lang[stay], weight[stay], hashed[stay], number[stay]

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        return pc.binary_join_element_wise(*(self.words.take(pa.array(self.codes[at + k])) for k in range(size)), " ")


def frequent_filter(dictionary: DataFrame, min_count: int, bits: int) -> bytes:
    """A bit for each counter that may belong to a phrase of `min_count` occurrences; the driver gets 2**bits bits."""
    block_bits = min(BLOCK_BITS, bits - 3)
    size, enough = 1 << block_bits, min(min_count, 1 << 15)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 1, CHUNK_BYTES):
            found = [(hashes >> np.uint64(64 - bits), total) for _, _, _, hashes, total in Grams(batch).each()]
            cell = np.concatenate([c for c, _ in found]).astype(np.int64)
            weight = np.minimum(np.concatenate([w for _, w in found]), enough).astype(np.uint16)
            order = np.argsort(cell, kind="stable")
            cell, weight = cell[order], weight[order]
            edges = np.searchsorted(cell, np.arange(0, (1 << bits) + 1, size))
            some = np.flatnonzero(np.diff(edges)).tolist()
            inner = (cell & (size - 1)).astype(np.uint16)
            parts = [[x[edges[k] : edges[k + 1]].tobytes() for k in some] for x in (inner, weight)]
            yield pa.record_batch([pa.array(some, pa.int32()), *(pa.array(p, pa.binary()) for p in parts)], ["block", "cells", "weights"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells, weights in zip(*(batch.column(k).to_pylist() for k in range(3))):
                counts = known.setdefault(block, np.zeros(size, np.uint16))
                new = np.bincount(np.frombuffer(cells, np.uint16), np.frombuffer(weights, np.uint16), size)
                known[block] = np.minimum(counts + new, enough).astype(np.uint16)
        for block, counts in known.items():
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([np.packbits(counts >= enough).tobytes()], pa.binary())], ["block", "flags"])

    parts = dictionary.mapInArrow(count, "block int, cells binary, weights binary")
    whole = bytearray((1 << bits) // 8)
    for row in parts.repartition("block").mapInArrow(add, "block int, flags binary").collect():
        start = row["block"] * (size // 8)
        whole[start : start + size // 8] = row["flags"]
    return bytes(whole)


def phrase_counts(dictionary: DataFrame, min_count: int, bits: int = COUNTER_BITS) -> DataFrame:
    """(lang, phrase, size, f) of phrases with f >= min_count, and for each language its words as phrase '' of size 0."""
    sent = dictionary.sparkSession.sparkContext.broadcast(frequent_filter(dictionary, min_count, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(sent.value, np.uint8)

        def keep(hashes: np.ndarray) -> np.ndarray:
            cell = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            return (flags[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)

        names = ["lang", "phrase", "size", "f"]
        for batch in gathered(batches, 1, CHUNK_BYTES):
            grams = Grams(batch)
            langs, totals = zip(*grams.word_counts())
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array([""] * len(langs)), pa.array([0] * len(langs), pa.int32()), pa.array(totals, pa.int64())], names)
            for size, at, lang, _, total in grams.each(keep):
                yield pa.record_batch([grams.langs.dictionary.take(pa.array(lang)), grams.phrases(at, size), pa.array([size] * len(at), pa.int32()), pa.array(total)], names)

    counted = dictionary.mapInArrow(run, "lang string, phrase string, size int, f long").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return counted.where((F.col("f") >= min_count) | (F.col("size") == 0))


def wide(count: str | Column) -> Column:
    """A count as a decimal, whose products do not pass the type."""
    return (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): candidates that no longer one nearly covers, with their lowest-scoring cut."""
    long = counts.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    run = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    # A phrase inside a longer one is inside one that is longer by one word and as frequent: only those are looked at.
    inside = F.explode(F.array(run(F.lit(1), F.col("size") - 1), run(F.lit(2), F.col("size") - 1)))
    covered = long.where("size >= 3").select("lang", inside.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("over"))
    kept = long.join(covered, ["lang", "phrase"], "left").where(F.col("over").isNull() | (5 * wide("over") < 4 * wide("a")))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", run(F.lit(1), F.col("k"))).withColumn("rest", run(F.col("k") + 1, F.col("size") - F.col("k")))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("CAST(CAST(a AS decimal(20,0)) * 2000000 AS decimal(38,0)) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, top: int = 2000, counter_bits: int = COUNTER_BITS
) -> DataFrame:
    """The best phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to 4 words with a = f(phrase) >= min_count, f being its count in the language. Cut
    after its first k words it gives l and r, the counts of both parts, and the score floor(2000000 * a / (l + r)); the
    cut of lowest score counts, of equal ones the first. Candidates whose words stand together inside a longer candidate
    with at least 0.8 of their count are dropped. n is the number of words of the language. Ranks go by score and a,
    both descending, then by phrase in the order of its UTF-8 bytes.
    """
    dictionary = materialize(chunk_table(docs, text_col, lang_col), "phrase-chunks")
    counts = materialize(phrase_counts(dictionary, min_count, counter_bits), "phrase-counts")
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    leading = scored(counts.where("size > 0")).withColumn("_part", part)
    leading = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
