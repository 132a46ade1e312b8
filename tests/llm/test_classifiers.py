"""Language ID, quality and toxicity: held-out accuracy on the given tables and defined results for odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparring.llm import language_id, quality_crf, toxicity
from sparring.llm.common import table

FOLDER = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "12 34 !!"), (None, "word"), (5, "x" * 200_000), (5, "again"), (5, "again")]


def test_languages(spark, corpus):
    docs = table(spark, FOLDER, "documents")
    found = language_id.predict_languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total > 0.95
    odd = language_id.predict_languages(corpus([(*r, "en") for r in ODD])).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["doc_id"]: r["lang_pred"] for r in odd if r["doc_id"] in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), "und")


def test_languages_without_labels(corpus):
    assert {r["lang_pred"] for r in language_id.predict_languages(corpus(ODD)).collect()} == {"und"}
    assert language_id.predict_languages(corpus([])).count() == 0


def test_every_language_can_be_predicted(corpus):
    """More languages than landmarks; each has its own syllables."""
    rng = random.Random(9)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    words = {f"l{k}": ["".join(rng.choices(letters, k=rng.randint(3, 7))) for _ in range(12)] for k in range(250)}
    rows = [(k, " ".join(rng.choices(words[f"l{k % 250}"], k=25)), f"l{k % 250}") for k in range(2500)]
    found = language_id.predict_languages(corpus(rows)).where("held_out").collect()
    right = [r["lang_pred"] == f"l{r['doc_id'] % 250}" for r in found]
    assert np.mean(right) > 0.97 and len({r["lang_pred"] for r in found}) > 240


def test_scores_are_those_of_the_ridge_regression(spark, corpus):
    """The whole fit by plain sets and one least-squares problem; ids that stand twice with unlike texts are settled."""
    rng = random.Random(2)
    words = {"a": ["und", "der", "ist"], "b": ["the", "and", "is"], "c": ["le", "est", "et"]}
    rows = [(k, " ".join(rng.choices(words["abc"[k % 3]] + ["x", "y"], k=9)), "abc"[k % 3]) for k in range(60)]
    rows += [(3, "zzz another text", "c"), (3, "aaa text", "b")]
    docs = corpus(rows)
    learn = F.col("doc_id") < 40
    first = {r["doc_id"]: r for r in language_id.identify(docs, language_id.fit(docs, learn, landmarks=12)).where("doc_id >= 40").collect()}
    again = language_id.fit(docs.repartition(5), learn, landmarks=12)
    second = {r["doc_id"]: r for r in language_id.identify(docs, again).where("doc_id >= 40").collect()}
    assert {k: (r["lang_pred"], round(r["score"], 9)) for k, r in first.items()} == {k: (r["lang_pred"], round(r["score"], 9)) for k, r in second.items()}

    known = {}
    for i, text, lang in rows:
        if i < 40:
            known[i] = min(known.get(i, ("~", "")), (lang, text))
    flags = {t: set(np.flatnonzero(language_id.gram_flags(t)).tolist()) for _, t, _ in rows}
    sample = language_id.labelled_sample(docs, learn, language_id.SAMPLE_ROWS, language_id.LEAST_ROWS).collect()
    marks = []
    for r in sample:
        if r["doc_id"] not in marks:
            marks.append(r["doc_id"])
    marks = [known[i][1] for i in marks[:12]]

    def k(x, y):
        return len(flags[x] & flags[y]) / np.sqrt(len(flags[x]) * len(flags[y]))

    among = np.array([[k(x, y) for y in marks] for x in marks])
    values, vectors = np.linalg.eigh(among)
    half = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    ids = sorted(known)
    z = np.array([[k(known[i][1], m) for m in marks] for i in ids]) @ half
    ones, n = np.ones((len(ids), 1)), len(ids)
    y = np.array([[float(known[i][0] == lang) for lang in "abc"] for i in ids])
    penalty = np.sqrt(1e-3 * n) * np.eye(z.shape[1] + 1)
    penalty[-1, -1] *= 1e-3
    weights = np.linalg.lstsq(np.vstack([np.hstack([z, ones]), penalty]), np.vstack([y, np.zeros((len(penalty), 3))]), rcond=None)[0]
    for i, text, _ in rows:
        if i >= 40:
            scores = np.append(np.array([k(text, m) for m in marks]) @ half, 1) @ weights
            assert first[i]["lang_pred"] == "abc"[scores.argmax()]
            assert np.isclose(first[i]["score"], np.clip(scores.max(), 0, 1), atol=1e-5)


def test_presence_kernel_is_normalised():
    marks = language_id.landmark_table(["the same text", "etwas anderes"])
    k = language_id.kernel(["the same text", "etwas anderes"], marks)
    assert np.allclose(np.diag(k), 1, atol=1e-6) and k[0, 1] < 0.3


def balanced_accuracy(found, label):
    parts = [np.mean([r["predicted"] == y for r in found if r[label] == y]) for y in (0, 1)]
    return sum(parts) / 2


@pytest.mark.parametrize("predict, label, least", [(quality_crf.predict_quality, "quality", 0.9), (toxicity.predict_toxicity, "toxic", 0.7)])
def test_labels(spark, predict, label, least):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    found = predict(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert balanced_accuracy(found, label) >= least


@pytest.mark.parametrize("predict", [quality_crf.predict_quality, toxicity.predict_toxicity])
def test_odd_rows(spark, corpus, predict):
    kind = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(40)] + [(None, 1, 1), (3, None, None), (3, 1, 1)], kind)
    texts = [(k, f"some plain words here {k}" if k % 2 else "### $$$ idiot idiot | |") for k in range(10, 40)]
    for rows in (ODD + texts, []):
        found = predict(corpus(rows), labels).collect()
        assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
    assert predict(corpus(ODD), labels.limit(0)).count() == len(ODD)


def test_chain_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    model = {"weights": rng.normal(size=quality_crf.FEATURES), "transition": rng.normal(size=(2, 2))}
    x = rng.normal(size=(6, quality_crf.FEATURES)) / 3
    unary, t = x @ model["weights"], model["transition"]
    good = np.zeros(6)
    total = 0.0
    for code in range(64):
        y = [(code >> k) & 1 for k in range(6)]
        p = np.exp(sum(unary[k] * y[k] for k in range(6)) + sum(t[y[k], y[k + 1]] for k in range(5)))
        total += p
        good += p * np.array(y)
    found, pairs, log_z = quality_crf.marginals(unary, np.array([6]), t)
    assert np.allclose(found, good / total) and np.isclose(log_z, np.log(total)) and np.isclose(pairs.sum(), 5)
    # Chains that follow each other don't touch.
    more = np.concatenate([rng.normal(size=3), unary, rng.normal(size=1), unary])
    several, pairs, _ = quality_crf.marginals(more, np.array([3, 6, 1, 6]), t)
    assert np.allclose(several[3:9], good / total) and np.allclose(several[10:], good / total) and np.isclose(pairs.sum(), 12)
    value = quality_crf.document_values(x, np.array([6]), np.arange(1.0, 7.0), model)
    assert np.isclose(value[0], (good / total * np.arange(1, 7)).sum() / 21)


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    x, lengths, labels = rng.normal(size=(9, quality_crf.FEATURES)), np.array([4, 1, 4]), np.array([1, 0, 0])
    theta = rng.normal(size=quality_crf.FEATURES + 4) / 3

    def value(t):
        return quality_crf.evaluated(x, lengths, labels, t[: quality_crf.FEATURES], t[quality_crf.FEATURES :].reshape(2, 2))

    step = 1e-6 * np.eye(len(theta))
    slopes = [(value(theta + d)[-2] - value(theta - d)[-2]) / 2e-6 for d in step]
    assert np.allclose(value(theta)[:-2], slopes, atol=1e-6) and value(theta)[-1] == 9


def test_a_very_long_document_in_the_sample(spark, corpus):
    """Its 100,000 lines are learned from without padding, and the fit is that of plain gradient ascent."""
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    rows = [(k, "\n".join(["A good plain sentence stands here."] * (k % 5 + 1)) if k % 2 else "||| ### 1 2 3\nBUY buy BUY") for k in range(60)]
    rows[1] = (1, "\n".join(f"Another good sentence number {k % 50} stands here." for k in range(100_000)))
    learn = F.col("doc_id") % 4 != 2
    model = quality_crf.fit(corpus(rows), labels, learn)
    found = {r["doc_id"]: r["score"] for r in quality_crf.score_quality(corpus(rows), model).collect()}
    assert found[1] > 0.5 and all(0 <= v <= 1 for v in found.values())

    small = [r for r in rows if r[0] != 1]
    model = quality_crf.fit(corpus(small), labels, learn)
    parts = [(quality_crf.document_features(t), k % 2) for k, t in small if k % 4 != 2]
    x, lengths = np.concatenate([p[0] for p, _ in parts]), np.array([len(p[0]) for p, _ in parts])
    y = np.array([label for _, label in parts])
    theta = np.zeros(quality_crf.FEATURES + 4)
    for _ in range(3000):
        g = quality_crf.evaluated(x, lengths, y, theta[: quality_crf.FEATURES], theta[quality_crf.FEATURES :].reshape(2, 2))
        theta += 0.3 * (g[:-2] / g[-1] - 1e-3 * theta)
    ours = np.concatenate([model["weights"], model["transition"].ravel()])
    found = {r["doc_id"]: r["score"] for r in quality_crf.score_quality(corpus(small), model).collect()}
    assert all((found[k] > 0.5) == bool(k % 2) for k in found)

    def worth(t):
        g = quality_crf.evaluated(x, lengths, y, t[: quality_crf.FEATURES], t[quality_crf.FEATURES :].reshape(2, 2))
        return g[-2] / g[-1] - 1e-2 / 20 * t @ t

    assert worth(ours) > worth(theta) - 1e-4


def test_string_kernel_matches_plain_sum():
    def features(word):
        c, out = f"\x02{word}\x03", {}
        for i in range(len(c)):
            for j, k in toxicity.OFFSETS:
                if i + k < len(c):
                    key = (c[i], c[i + j], c[i + k])
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k + 1)
        return out

    words = ["idiot", "id.iot", "banana", "it"]
    index = toxicity.used_subsequences(words)
    ours = toxicity.profiles(words, index)
    norms = toxicity.Subsequences(words).norm
    for a in range(4):
        for b in range(4):
            fa, fb = features(words[a]), features(words[b])
            assert np.isclose(ours[a] @ ours[b] * norms[a] * norms[b], sum(v * fb.get(k, 0) for k, v in fa.items()))


def test_inserted_characters(spark, corpus):
    """Insults learned plainly are found with a character put in or letters set apart."""
    bad, rng = ["blorgnak", "vexitrop", "quandlef"], random.Random(1)
    plain = ["".join(rng.choice(("ta", "mo", "rin", "sel", "ku", "pa")) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def text(insults):
        words = rng.choices(plain, k=30)
        for insult in insults:
            words.insert(rng.randrange(len(words)), insult)
        return " ".join(words)

    texts = [(k, text(rng.sample(bad, 2) if k % 2 else [])) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    hidden = [(1001, text(["blor.gnak", "vexi-trop"])), (1002, text(["v e x i t r o p", "q u a n d l e f"])), (1003, text([]))]
    found = {r["doc_id"]: r["predicted"] for r in toxicity.predict_toxicity(corpus(texts + hidden), labels).collect()}
    assert [found[k] for k in (1001, 1002, 1003)] == [1, 1, 0]


def test_toxic_phrases_of_ordinary_words(spark, corpus):
    """No single word tells toxic texts; a phrase does, or nothing surely does and the model is still defined."""
    rng = random.Random(5)
    ordinary = ["green", "table", "sings", "loud", "river", "stone", "walks", "over", "small", "house", "never", "reads"]

    def text(toxic):
        words = rng.choices(ordinary, k=40)
        words = [w for k, w in enumerate(words) if not (w == "table" and k and words[k - 1] == "green")]
        if toxic:
            for _ in range(2):
                at = rng.randrange(len(words))
                words[at:at] = ["green", "table"]
        return " ".join(words)

    rows = [(k, text(k % 2)) for k in range(400)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    found = toxicity.predict_toxicity(corpus(rows), labels).where("held_out").collect()
    accuracy = [np.mean([r["predicted"] == y for r in found if r["doc_id"] % 2 == y]) for y in (0, 1)]
    assert min(accuracy) > 0.8
    same = [(k, " ".join(rng.choices(ordinary, k=6))) for k in range(60)]
    found = toxicity.predict_toxicity(corpus(same), labels).collect()
    assert len({r["score"] for r in found}) > 1 and all(0 <= r["score"] <= 1 for r in found)
