"""BPE against the tokenizers library, nearest neighbours and decontamination against brute force, chats, the pipeline."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparring.llm import ann, bpe, chat_format, decontaminate
from sparring.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(PATH))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \t\n  \x1c'stlaé漢<|endoftext|>1.", max_size=60))
def test_encoding_matches(library, encoder, text):
    (ids,) = encoder.encode([text])
    assert np.frombuffer(ids, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_and_decode(spark, corpus, library):
    texts = [None, "", "plain text", "a<|endoftext|>b", "é" * 3000, "x" * 50_000, "plain text"]
    coded = bpe.decode(bpe.encode(corpus([(k, t) for k, t in enumerate(texts)]).withColumn("ids", F.lit("clash")), PATH), PATH)
    rows = sorted(coded.collect(), key=lambda r: r["doc_id"])
    for text, row in zip(texts, rows):
        assert row["ids"] == library.encode(text or "", add_special_tokens=False).ids
        assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False) == (text or "")
    both = bpe.encode(corpus([(k, t) for k, t in enumerate(texts)]), PATH, decoded_col="decoded")
    assert sorted(map(tuple, both.select("doc_id", "ids", "decoded").collect())) == [tuple(r[c] for c in ("doc_id", "ids", "decoded")) for r in rows]
    broken = spark.createDataFrame([([128],), (None,)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(broken, PATH).collect()] == [library.decode([128], skip_special_tokens=False), ""]


def test_pretoken_above_four_mebibytes(library, encoder):
    ranks = encoder.vocabulary.byte_pair_ranks
    # A letter whose bytes don't merge keeps the number of merges small.
    letter = next(c for c in map(chr, range(0x1400, 0x1680)) if c.isalpha() and all(ranks[a, b] == bpe.NONE for a, b in zip(c.encode() * 2, (c * 2).encode()[1:])))
    text = "hello" + letter * ((4 << 20) // 3 + 10) + "there"
    (ids,) = encoder.encode([text])
    assert np.array_equal(np.frombuffer(ids, np.int32), library.encode(text, add_special_tokens=False).ids)


def exact_neighbours(rows, k, queries):
    found = []
    for q, v in sorted(queries):
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in rows if i != q)[:k]
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return found


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6).round(3).tolist()) for k in range(200)] + [(300 + k, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for k in range(40)]
    odd = [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0] * 5), (404, [float("nan")] + [1.0] * 5), (405, [None] + [1.0] * 5), (None, [1.0] * 6), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rank string")
    # All axes visited: the answers must be exact, whatever the blocks.
    got = ann.nearest(frame, F.col("vec_id") % 20 == 0, k=5, tables=2, probes=1000, block_rows=16)
    expected = exact_neighbours(rows, 5, [r for r in rows if r[0] % 20 == 0])
    found = sorted(map(tuple, got.collect()))
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected])
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(frame.where("vec_id < 3"), F.col("vec_id") % 20 == 0, tables=2, probes=1000).count() == 2


def test_recall(spark):
    """500 rows of one band: all of them are found by hashing."""
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    every = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in rows.collect()]
    exact = {(q, i) for q, _, i, _ in exact_neighbours(every, 20, [r for r in every if r[0] % 20 == 0])}
    found = {(r["query_id"], r["vec_id"]) for r in ann.search_twentieths(rows).collect()}
    assert len(found & exact) >= 0.9 * len(exact)


def recall(spark, x, **settings):
    """Share of the 20 nearest of every tenth row that is found, and the fewest found for a query."""
    asked = np.arange(0, len(x), 10)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    exact = {(int(q), int(i)) for q, best in zip(asked, np.argsort(-scores, axis=1)[:, :20]) for i in best}
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = [(r["query_id"], r["vec_id"]) for r in ann.nearest(frame, F.col("vec_id") % 10 == 0, **settings).collect()]
    each = np.bincount([q for q, _ in found], minlength=len(x))[asked]
    return len(set(found) & exact) / len(exact), int(each.min())


@pytest.mark.parametrize("dimensions", [64, 100])
def test_recall_of_unequal_lengths(spark, dimensions):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, dimensions))
    x *= np.exp(0.5 * rng.normal(size=(3000, 1))) / np.sqrt((x * x).sum(1, keepdims=True))
    share, fewest = recall(spark, x)
    assert share >= 0.9 and fewest == 20


def test_one_long_vector(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2500, 100))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    x[7] *= 100
    share, fewest = recall(spark, x)
    assert share >= 0.9 and fewest == 20


def test_queries_that_find_too_few(spark):
    x = np.random.default_rng(13).normal(size=(120, 8))
    assert recall(spark, x, tables=1, probes=1, whole_rows=0)[1] == 20


def test_decontamination(spark, corpus):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 8, 10, 12, 13, 20, 40]))) for _ in range(60)]
    items += [items[5], items[7].upper() + "?", "short one of w1", "only"] + [items[k] + " w1 w2 w3" for k in range(10, 20)]
    rows = [(700, "here is a short one of w1"), (701, "short one w1"), (702, "(only)")]
    for doc in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.6:
            item = rng.choice(items).split()
            n = rng.randint(min(6, len(item)), len(item))
            start = rng.randint(0, len(item) - n)
            part = item[start : start + n]
            for _ in range(rng.randint(0, 4)):
                part[rng.randrange(n)] = rng.choice(["zz", *vocabulary])
            at = rng.randint(0, len(words))
            words[at:at] = part
        rows.append((doc, " ".join(words)))
    rows += [(500, None), (501, ""), (502, items[5].upper() + "."), (502, "other"), (None, "nothing here")]
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (None, "x")], "item_id long, text string")
    expected = set()
    for doc, text in rows:
        a = decontaminate.normal_words((text or "").encode())
        for k, item in enumerate(items):
            b = decontaminate.normal_words(item.encode())
            width = min(13, len(b))
            if b and any(
                sum(x != y for x, y in zip(a[p : p + width], b[q : q + width])) <= decontaminate.substitutions(width)
                for q in range(len(b) - width + 1)
                for p in range(len(a) - width + 1)
            ):
                expected.add((doc, k))
    docs = corpus(rows)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()} == expected
    kept = decontaminate.decontaminate(docs, benchmark)
    bad = {d for d, _ in expected}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([d for d, t in rows if d not in bad or t == "other"], key=str)
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


def test_chats(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "BLOCK", 4)
    rng = random.Random(6)
    pool = [("user", "a"), ("assistant", "b"), ("user", None), (None, "a"), ("user", "")]
    chats = {c: [rng.choice(pool) for _ in range(rng.randint(1, 12))] for c in range(40)}
    for c in range(40, 80):
        whole = chats[rng.randrange(40)]
        chats[c] = whole[: rng.randint(1, len(whole))]
    rows = [(c, 2 * t, r, x, "z") for c, turns in chats.items() for t, (r, x) in enumerate(turns)] + [(None, 0, "user", "a", "z"), (99, None, "user", "n", "z")]
    chats[99] = [("user", "n")]
    rng.shuffle(rows)
    found = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")).collect()
    kept = {}
    for c in sorted(chats):
        if not any(len(o) > len(chats[c]) and o[: len(chats[c])] == chats[c] for o in chats.values()) and chats[c] not in kept.values():
            kept[c] = chats[c]
    rendered = {c: "".join(f"<|{r or 'user'}|>\n{x or ''}\n<|end|>\n" for r, x in turns) for c, turns in kept.items()}
    assert {r["conv_id"]: r["text"] for r in found} == rendered
    assert all(r["n_turns"] == len(kept[r["conv_id"]]) and r["part"] == 0 for r in found)


def test_pipeline(spark, corpus):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    kept = corpus_pipeline.run(spark, folder)
    assert kept.where("not restored").count() == 0
    assert 0 < kept.count() < docs.count()
    odd = corpus([(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (None, "words without an id"), (4, "z" * 100_000)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for some in (odd, odd.limit(0)):
            assert stage(spark, some, folder).columns == list(corpus_pipeline.COLUMNS)
            assert stage(spark, some, folder).count() <= some.count()
