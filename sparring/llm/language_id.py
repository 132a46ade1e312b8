"""Language identification with a string kernel: blended-spectrum n-gram presence, Nyström landmarks, ridge regression.

The kernel of two texts is the number of character n-grams (UTF-8 bytes of the lower-cased whole text, n = 2, 3 and 4,
hashed) present in both, over the geometric mean of the numbers present in each. A bounded sample of labelled texts
fits one-versus-rest kernel ridge regression over landmarks; every text is scored by batched matrix products.

A text that is null or has no letter is `und` with score 0. So is every text if there is no labelled row to learn from.
Equal texts get equal results; ties between languages go to the first in order. Ids may be null or repeated; rows of
null id are never learned from. Columns of the input pass through; one named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import fold, hash_sample, slices

GRAMS = (2, 3, 4)
BITS = 16
UNKNOWN = "und"
#: Texts in one matrix product: at most 16 MB of presence flags.
AT_ONCE = 64
#: Bounds of the labelled sample and least rows of each language; parameters of `fit`. There is a landmark for each language.
SAMPLE_ROWS, LANDMARKS, LEAST_ROWS = 3000, 96, 8


def gram_flags(text: str) -> np.ndarray:
    """Presence of hashed n-grams."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    flags = np.zeros(1 << BITS, bool)
    for n in GRAMS:
        m = len(data) - n + 1
        if m > 0:
            gram = data[:m].copy()
            for k in range(1, n):
                gram = gram << np.uint32(8) | data[k : k + m]
            flags[(gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - BITS)] = True
    return flags


def kernel(texts: list[str], landmarks: dict) -> np.ndarray:
    """Normalised kernel of each text with each landmark, by matrix products of AT_ONCE texts."""
    used, profile, norm = landmarks["used"], landmarks["profile"], landmarks["norm"]
    parts = [np.zeros((0, len(norm)))]
    for start in range(0, len(texts), AT_ONCE):
        some = texts[start : start + AT_ONCE]
        present, sizes = np.empty((len(some), len(used)), np.float32), np.empty(len(some))
        for k, text in enumerate(some):
            flags = gram_flags(text)
            present[k], sizes[k] = flags[used], np.count_nonzero(flags)
        parts.append((present @ profile) / np.sqrt(np.maximum(sizes, 1))[:, None] / norm)
    return np.concatenate(parts)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def landmark_table(texts: list[str]) -> dict:
    flags = np.array([gram_flags(t) for t in texts]).reshape(len(texts), 1 << BITS)
    used = np.flatnonzero(flags.any(0))
    return {"used": used, "profile": flags[:, used].T.astype(np.float32), "norm": np.sqrt(np.maximum(flags.sum(1), 1))}


def labelled_sample(docs: DataFrame, learn: Column, rows: int, least: int) -> DataFrame:
    """Labelled (doc_id, lang, turn): an equal share of `rows` of each language, `least` where that is fewer."""
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang").distinct()
    return hash_sample(usable, "lang", total=rows, least=least).orderBy("turn", "lang", "doc_id")


def fit(
    docs: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS, ridge: float = 1e-3, least_rows: int = LEAST_ROWS
) -> dict | None:
    """The model, learned from `text` and `lang` of rows for which `learn` holds; None if there are none.

    Of each language at most its share of `sample_rows`, or `least_rows` if that is more, is learned from; there are
    `landmarks` landmarks, or one for each language if there are more languages. Of an id with unlike rows the
    smallest language and text count.
    """
    sample = labelled_sample(docs, learn, sample_rows, least_rows).collect()
    turns: dict[int, int] = {}
    for r in sample:
        turns.setdefault(r["doc_id"], r["turn"])
    langs = sorted({r["lang"] for r in sample})
    if not langs:
        return None
    landmarks = max(landmarks, len(langs))
    chosen = docs.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in turns], "doc_id long")), "doc_id", "left_semi")
    chosen = chosen.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = chosen.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("doc_id", "r.text", "r.lang")
    most = sorted(turns.values())[min(landmarks, len(turns)) - 1]
    first = [i for i, turn in turns.items() if turn <= most][:landmarks]
    texts = {r["doc_id"]: r["text"] for r in chosen.where(F.col("doc_id").isin(first)).collect() if r["text"] is not None}
    table = landmark_table([texts[i] for i in first if i in texts])
    width = table["profile"].shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            k = kernel([t or "" for t in batch.column(1).to_pylist()], table)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(list(k), pa.list_(pa.float64()))], ["doc_id", "lang", "k"])

    fitted = sorted(chosen.mapInArrow(rows, "doc_id long, lang string, k array<double>").collect(), key=lambda r: (r["doc_id"], r["lang"]))
    x = np.array([r["k"] for r in fitted]).reshape(len(fitted), width)
    among = kernel([texts[i] for i in first if i in texts], table)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    large = values > 1e-6 * values.max()
    nystrom = vectors[:, large] / np.sqrt(values[large])
    z = np.hstack([x @ nystrom, np.ones((len(x), 1))])
    y = np.array([[float(r["lang"] == lang) for lang in langs] for r in fitted])
    weights = np.linalg.solve(z.T @ z + ridge * len(z) * np.diag([1.0] * (z.shape[1] - 1) + [1e-6]), z.T @ y)
    return {"landmarks": table, "langs": langs, "weights": nystrom @ weights[:-1], "bias": weights[-1]}


def identify(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (the regression value of that language, cut to 0..1)."""
    base = docs.drop("lang_pred", "score")
    at = base.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = sent.value
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            known = [k for k, t in enumerate(texts) if learned and has_letter(t)]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                values = kernel([texts[k] for k in known], learned["landmarks"]) @ learned["weights"] + learned["bias"]
                for k, best, value in zip(known, values.argmax(1), np.clip(values.max(1), 0, 1)):
                    lang[k], score[k] = learned["langs"][best], float(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"]
            )

    schema = base.select("*", F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("score")).schema
    return base.mapInArrow(run, schema)


def predict_languages(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the documents outside the fold `held_out`."""
    inside = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    model = fit(docs, F.col("doc_id").isNotNull() & ~inside)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", inside.alias("held_out"), "lang_pred", "score")
