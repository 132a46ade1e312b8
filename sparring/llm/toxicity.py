"""Toxicity with a gap-weighted subsequence kernel, Nyström landmarks and a support vector machine.

The kernel of two character strings sums, over the subsequences of three letters that they share, decay**span for both
strings, where a span is what the three letters cover, gaps included, up to SPAN. So a word with letters put in, left
out or changed stays near to the insult it hides. Strings are marked at both ends, lower-cased and divided by a norm
that depends on their length only; punctuation around a word is left out. Runs of single letters ("i d i o t") are read as one string.

A text (whole texts are read) is judged by its two most toxic strings. Training takes a bounded
sample of labelled documents: strings whose distinct contexts lie almost only in toxic documents are the positive
examples and give the landmarks, with copies of them that have characters put in; strings of clean documents are the
negative ones, with the worst of them added in a second round. The support vector machine (squared hinge loss) over Nyström features folds into one weight for each
hashed subsequence, so that a string is scored with one lookup for each of its subsequences. Strings are words; where no
word passes the rule (toxic texts made of ordinary words) they are runs of two words, then of three, and where no run
passes either, the words that speak most for toxic documents are the positive examples.

Null and empty texts hold no string and get the lowest score. Without labels of both classes, or if the learned texts of
one class hold no string at all, every score is 0.
Repeated rows and ids get repeated results, an empty table an empty one. Null labels don't count; of several labels of
one id the largest counts. Columns of the input pass through; one named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nlargest
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import fold, labelled_ids, slices

SPAN, DECAY, BITS = 6, 0.75, 18
#: Bounds of the sample: labelled documents of each class, positive and negative strings, landmarks. Parameters of `fit`.
SAMPLE_PER_CLASS, POSITIVES, NEGATIVES, LANDMARKS = 4000, 1500, 20_000, 256
#: A string is a positive example if so many distinct contexts of it are toxic, at this log-likelihood ratio or more.
LEAST_CONTEXTS, LEAST_RATIO = 3, 20.0
#: Strings that are learned from where none passes that rule.
LIKELIEST = 50
#: Places of a long word at which a character is put in for training.
PLACES = 64
AROUND = "!?.,;:'\"()[]{}<>|#&%$*"
OFFSETS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def strings(text: str | None, run: int = 1) -> list[str]:
    """Lower-cased words, neighbouring words of one character put together; or runs of `run` such words."""
    words = single_strings(text)
    if run == 1 or not words:
        return words
    return [" ".join(words[k : k + run]) for k in range(max(1, len(words) - run + 1))]


def single_strings(text: str | None) -> list[str]:
    words = [w.strip(AROUND) or w for w in text.lower().split()] if text else []
    if not any(len(w) == 1 for w in words):
        return words
    out: list[str] = []
    for single, run in groupby(words, lambda w: len(w) == 1):
        out.extend(["".join(run)] if single else run)
    return out


def with_insertions(word: str) -> list[str]:
    """The word with a character between all letters, and with one put in at each place (of long words at PLACES of them)."""
    places = range(1, len(word), max(1, len(word) // PLACES))
    return [*(mark.join(word) for mark in ".-*"), *(word[:k] + ".-*x"[k % 4] + word[k:] for k in places)]


class Subsequences:
    """Hashed three-letter subsequences of strings, as flat arrays in chunks of bounded size."""

    def __init__(self, words: list[str]):
        joined = "".join(f"\x02{w}\x03" for w in words)
        self.letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if words else np.zeros(0, np.int64)
        self.left = np.repeat(self.starts + self.lengths, self.lengths) - np.arange(len(self.letters))
        counts = np.array([sum(DECAY ** (2 * (k + 1)) for j, k in OFFSETS if k < left) for left in range(SPAN + 1)])
        self.norm = np.sqrt(np.maximum(np.add.reduceat(counts[np.minimum(self.left, SPAN)], self.starts), 1e-9)) if words else np.zeros(0)

    def each(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(places of the first letters, hashed subsequences, weight) for each pair of offsets."""
        c = self.letters
        for j, k in OFFSETS:
            at = np.flatnonzero(self.left > k)
            value = c[at] * np.uint64(0x9E3779B97F4A7C15) ^ c[at + j] * np.uint64(0xC2B2AE3D27D4EB4F) ^ c[at + k] * np.uint64(0x165667B19E3779F9)
            yield at, ((value * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64), DECAY ** (k + 1)


def string_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of `weights` over the subsequences of each string, over its norm."""
    s = Subsequences(words)
    if not words:
        return np.zeros(0)
    total = np.zeros(len(s.letters))
    for at, value, weight in s.each():
        total[at] += weight * weights[value]
    return np.add.reduceat(total, s.starts) / s.norm


def used_subsequences(words: list[str]) -> np.ndarray:
    """For each hashed subsequence its column among those of `words`, -1 if they don't have it."""
    index = np.full(1 << BITS, -1, np.int64)
    for _, value, _ in Subsequences(words).each():
        index[value] = 0
    found = np.flatnonzero(index == 0)
    index[found] = np.arange(len(found))
    return index


def profiles(words: list[str], index: np.ndarray) -> np.ndarray:
    """Each string's normalised feature vector, over the subsequences that have a column."""
    s = Subsequences(words)
    out = np.zeros((len(words), int(index.max()) + 1))
    owner = np.repeat(np.arange(len(words)), s.lengths)
    for at, value, weight in s.each():
        column = index[value]
        has = column >= 0
        np.add.at(out, (owner[at[has]], column[has]), weight)
    return out / s.norm[:, None]


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights (offset last) of a linear machine with squared hinge loss, by Newton steps on the active rows."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = np.eye(z.shape[1])
    keep[-1, -1] = 1e-6
    active = np.ones(len(y), bool)
    for _ in range(rounds):
        a = z[active] * cost[active][:, None]
        w = np.linalg.solve(a.T @ z[active] + keep, a.T @ y[active])
        now = y * (z @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def context_counts(docs: DataFrame, ids: DataFrame, run_words: int) -> DataFrame:
    """(word, toxic, clean): in how many distinct contexts (words before and after) a string stands in documents of each label."""
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            word, context, label = [], [], []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, around = strings(text, run_words), ["", *strings(text), ""]
                word += words
                context += [xxhash.xxh3_64_intdigest(f"{around[k]} {around[min(k + run_words + 1, len(around) - 1)]}") for k in range(len(words))]
                label += [y] * len(words)
            frame = pa.table([word, pa.array(context, pa.uint64()).view(pa.int64()), pa.array(label, pa.int32())], ["word", "context", "label"])
            yield from frame.group_by(["word", "context", "label"]).aggregate([]).select(["word", "context", "label"]).to_batches()

    found = chosen.mapInArrow(run, "word string, context long, label int").distinct()
    return found.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def likelihood_ratio(toxic: Column, clean: Column, share: float) -> Column:
    """Log-likelihood ratio of a word's contexts against the share of toxic contexts overall."""
    n = toxic + clean
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (part(toxic, n * share) + part(clean, n * (1 - share)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    per_class: int = SAMPLE_PER_CLASS,
    landmarks: int = LANDMARKS,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> dict | None:
    """The model, from at most `per_class` labelled documents of each class; None without strings of both classes.

    At most `positives` strings are positive examples, and about `negatives` are negative ones.
    """
    sample = labelled_ids(labels, "toxic", learn, per_class)
    ids = {r["doc_id"]: r["label"] for r in sample.collect()}
    if len(set(ids.values())) < 2:
        return None
    spark = docs.sparkSession
    sample = spark.createDataFrame(list(ids.items()), "doc_id long, label int")
    for run_words in (1, 2, 3, 1):
        counts = context_counts(docs, sample, run_words).persist()
        total = counts.agg(F.sum("toxic"), F.sum("clean")).first()
        if not total[0] or not total[1]:
            counts.unpersist()
            return None
        share = total[0] / (total[0] + total[1])
        ratio = likelihood_ratio(F.col("toxic"), F.col("clean"), share)
        ranked = counts.where(F.col("toxic") > F.col("clean") * share / (1 - share)).withColumn("ratio", ratio).orderBy(F.desc("ratio"), "word")
        surely = (F.col("toxic") >= LEAST_CONTEXTS) & (F.col("toxic") > 19 * F.col("clean") * share / (1 - share)) & (F.col("ratio") >= LEAST_RATIO)
        toxic = ranked.where(surely).limit(positives).collect()
        if toxic:
            break
        counts.unpersist()
    else:
        counts.persist()
        toxic = ranked.limit(LIKELIEST).collect()
    clean = counts.where("clean > 0").orderBy(F.xxhash64("word"), "word").limit(negatives).collect()
    often = counts.where("clean > 0").orderBy(F.desc("clean"), "word").limit(negatives // 10).collect()
    if not toxic or not clean:
        counts.unpersist()
        return None
    positive = [r["word"] for r in toxic]
    negative = sorted({r["word"] for r in [*clean, *often]} - set(positive))
    index = used_subsequences(positive[:landmarks])
    base = profiles(positive[:landmarks], index)
    values, vectors = np.linalg.eigh(base @ base.T)
    large = values > 1e-4 * values.max()
    basis = base.T @ (vectors[:, large] / np.sqrt(values[large]))
    importance = np.array([r["toxic"] for r in toxic], float)

    def features(words: list[str]) -> np.ndarray:
        return np.vstack([profiles(words[s : s + 500], index) @ basis for s in range(0, len(words), 500)])

    varied = sorted({v for w in positive[:landmarks] for v in with_insertions(w)} - set(negative) - set(positive))
    x_toxic, x_clean = features(positive + varied), features(negative)
    for last in (False, True):
        x = np.vstack([x_toxic, x_clean])
        y = np.concatenate([np.ones(len(x_toxic)), -np.ones(len(x_clean))])
        cost = np.concatenate([10 * np.sqrt(importance), np.full(len(varied), 2.0), np.full(len(x_clean), 10.0)])
        w = squared_hinge(x, y, cost)
        weights = np.append(basis @ w[:-1], 0.0)[index]
        if last:
            break
        hard = worst_strings(counts.where("clean > 0").select("word"), weights, negatives // 4)
        extra = sorted(set(hard) - set(negative) - set(positive))
        if extra:
            x_clean = np.vstack([x_clean, features(extra)])
    counts.unpersist()
    model = {"weights": weights, "offset": float(w[-1]), "run": run_words, "scale": np.array([1.0, 1.0, 0.0])}
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = top_scores(batch.column(1).to_pylist(), model)
            yield pa.record_batch([batch.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])], ["label", "first", "second"])

    values = chosen.mapInArrow(tops, "label int, first double, second double").collect()
    first, y = np.array([[r["first"], r["second"]] for r in values]), np.array([r["label"] for r in values])
    scale = logistic(first, y)
    if scale[:2].min() < 0:  # a more toxic string must never make a text less toxic
        slope, offset = logistic(first.sum(1, keepdims=True), y)
        scale = np.array([slope, slope, offset])
    return model | {"scale": scale}


def top_scores(texts: list[str | None], model: dict) -> np.ndarray:
    """The two highest values of strings in each text, cut to -1.5..3; the lowest where there is none."""
    words = [strings(t, model["run"]) for t in texts]
    distinct = list(set().union(*words))
    value = dict(zip(distinct, (string_scores(distinct, model["weights"]) + model["offset"]).tolist()))
    best = [[*nlargest(2, map(value.__getitem__, w)), -1.5, -1.5][:2] for w in words]
    return np.clip(np.array(best).reshape(len(texts), 2), -1.5, 3)


def worst_strings(words: DataFrame, weights: np.ndarray, most: int) -> list[str]:
    """The `most` strings of highest score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            texts = batch.column(0).to_pylist()
            yield pa.record_batch([batch.column(0), pa.array(string_scores(texts, weights))], ["word", "score"])

    scored = words.mapInArrow(run, "word string, score double")
    return [r["word"] for r in scored.orderBy(F.desc("score"), "word").limit(most).collect()]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Slopes and offset (last) of a logistic regression, by Newton steps."""
    z, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, z.T @ (y - p) - penalty * w), -5, 5)
    return w


def score_texts(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """`docs` with score, the probability of label 1 (toxic)."""
    base = docs.drop("score")
    at = base.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = sent.value
        for batch in slices(batches, at):
            score = np.zeros(batch.num_rows)
            if learned:
                odds = top_scores(batch.column(at).to_pylist(), learned) @ learned["scale"][:-1] + learned["scale"][-1]
                score = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    return base.mapInArrow(run, base.select("*", F.lit(None).cast("double").alias("score")).schema)


def predict_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, cut: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; learned from labels outside the fold `held_out`."""
    inside = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    scored = score_texts(docs.select("doc_id", "text"), fit(docs, labels, ~inside))
    return scored.select("doc_id", inside.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
