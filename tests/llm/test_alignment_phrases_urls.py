"""Token alignment, phrases and URL rules against brute force, with the unusual rows that each docstring names."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sparring.llm import phrases, token_alignment, url_rules

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COUNTS = token_alignment.COUNTS


def aligned_by_hand(texts):
    """(counts, groups) of each text, token by token."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(token_alignment_letters())}
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    docs = []
    for text in texts:
        groups = []
        if text:
            coded = a.encode(" " + text, add_special_tokens=False)
            one = [(i, bytes(letters[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
            pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
            two = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()) for i, p in pieces]
            if all(b"".join(t for _, t in x) == (" " + text).encode() for x in (one, two)):
                groups = cut(one, two)
        docs.append(groups)
    holders = Counter()
    for groups in docs:
        holders.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    most = {}
    for (x, _), n in holders.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        counts = (
            sum(len(g[0]) for g in groups),
            sum(len(g[1]) for g in groups),
            len(groups),
            len(links),
            sum(holders[k] == most[k[0]] for k in links),
            sum(holders[k] for k in links),
        )
        out.append((*counts, ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)))
    return out


def token_alignment_letters():
    from sparring.llm.bpe import byte_letters

    return byte_letters()


def cut(one, two):
    def ends(tokens):
        return np.cumsum([len(t) for _, t in tokens]).tolist()

    shared = sorted(set(ends(one)) & set(ends(two)))
    groups, start = [], 0
    for end in shared:
        groups.append(tuple([i for (i, _), e in zip(x, ends(x)) if start < e <= end] for x in (one, two)))
        start = end
    return groups


ODD_TEXTS = [
    None,
    "",
    " ",
    "  two  spaces ",
    "a\tb\nc\r\n",
    "one ▁ two",
    "<|endoftext|> <s> <unk> <0x41>",
    "日本語のテキスト 😀👩‍👩‍👧 ɐ\u0301",
    "12345678901234567890 " * 30,
    "x" * 3000,
    "héé the the thes theses",
    "héé the the thes theses",
    "\u00a0\u2003nbsp",
    "a\x00b",
]


@pytest.mark.parametrize("part_bytes", [token_alignment.PART_BYTES, 2000])
def test_alignment_matches_brute_force(spark, part_bytes):
    rng = random.Random(3)
    texts = ODD_TEXTS + ["".join(rng.choice("aeinst  .,é1-\nAЖ語") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    rows = [(k if k % 9 else None, t, 5) for k, t in enumerate(texts)]
    rows.append(rows[-1])  # a repeated row is a document of its own
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, n_a int, place int").repartition(3)
    found = token_alignment.align(df, A_PATH, B_PATH, part_bytes=part_bytes).orderBy("place").collect()
    expected = aligned_by_hand([r[1] for r in rows])
    assert [tuple(r[c] for c in (*COUNTS, "groups")) for r in found] == expected
    assert sum(r["n_a"] > 0 for r in found) > 45


def test_long_groups_and_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BIG", 2)
    both = token_alignment.encoders(A_PATH, B_PATH)
    texts = ["antidisestablishmentarianism " * 3, "the"]
    small = token_alignment.Aligned(texts, both).pairs()
    monkeypatch.undo()
    plain = token_alignment.Aligned(texts, both).pairs()
    totals = [Counter(), Counter()]
    for total, found in zip(totals, (small, plain)):
        for d, k, t in zip(*(x.tolist() for x in found)):
            total[d, k] += t
    assert totals[0] == totals[1] and sum(totals[0].values()) > 20
    empty = token_alignment.alignment_digests(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH)
    assert empty.collect() == []


def test_units_are_encoded_like_whole_texts():
    """Cutting at spaces changes no id, whatever characters stand around the spaces."""
    both = token_alignment.encoders(A_PATH, B_PATH)
    assert both.separable
    rng = random.Random(8)
    odd = [chr(c) for c in (*range(1, 48), 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000, 0x301, 0x200D, 0x2581, 0xFB01, 0x1F600, 0x4E2D)]
    letters = [*odd, *" " * 40, *"aetns1.'é" * 3]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    found = token_alignment.Aligned(texts, both)
    n_a, n_b = found.numbers()[:2]
    whole = both.b.encode(texts, num_threads=1)
    written = found.groups()
    valid = 0
    for k, text in enumerate(texts):
        if b"".join(both.b_bytes[whole[k]]) != b" " + text.encode():
            assert n_a[k] == n_b[k] == 0
            continue
        valid += 1
        sides = [g.split("|") for g in written[k].split(";")]
        one, two = ([int(i) for g in sides for i in g[s].split(",")] for s in (0, 1))
        assert one == both.a.encode_ordinary(" " + text) and two == whole[k]
    assert valid > 2000


def test_alignment_digest(spark, corpus):
    rows = {r["doc_id"]: r for r in token_alignment.alignment_digests(corpus([(1, "a word"), (2, None)]), A_PATH, B_PATH).collect()}
    groups = aligned_by_hand(["a word"])[0][-1]
    assert rows[1]["groups_sha256"] == hashlib.sha256(groups.encode()).hexdigest()
    assert rows[2]["groups_sha256"] == "" and rows[2]["n_links"] == 0


def test_perfect_hash_is_minimal_and_verifies():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 50_000)).astype(np.uint32)
    shard = token_alignment.shard_of(keys)
    rows = []
    for s in (3, 200):
        own = keys[shard == s]
        sizes, words = token_alignment.cascade(own)
        blank = (s, sizes.tobytes(), words.tobytes(), b"", None)
        slots = token_alignment.PairCounts([blank]).ranked(own)
        assert sorted(slots.tolist()) == list(range(len(own)))
        ordered = np.empty(len(own), np.uint32)
        ordered[slots] = own
        rows.append((*blank[:3], ordered.tobytes(), np.arange(len(own)).tobytes()))
    table = token_alignment.PairCounts(rows)
    mine = np.isin(shard, (3, 200))
    assert (table.keys[table.slots(keys[mine])] == keys[mine]).all()
    assert (table.slots(keys[~mine]) == -1).all()
    assert (table.slots(keys[mine] ^ np.uint32(1 << 31)) == -1).all()


def phrases_by_hand(rows, min_count, top):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[k : k + n])) for k in range(len(words) - n + 1))
    frequent = {k: f for k, f in counts.items() if f >= min_count}
    found = []
    for (lang, p), a in frequent.items():
        longer = [(q, f) for (m, q), f in frequent.items() if m == lang and len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q)))]
        if len(p) > 1 and not any(100 * f >= 80 * a for _, f in longer):
            score, k = min((2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
            found.append((lang, -score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    out = []
    for lang in {f[0] for f in found}:
        for rank, (_, score, a, p, left, right) in enumerate(sorted(f for f in found if f[0] == lang)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("bits", [8, 20])
def test_phrases_match_brute_force(spark, corpus, bits):
    rng = random.Random(5)
    words = ["the", "Of", "é", "x", "\u00a0", "New", "york", "C++", "😀"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    texts += [None, "", " . ", "same " * 4000, "a b c d e f g h " * 50, "the of"]
    rows = [(t, (None, "und", "en")[k % 3]) for k, t in enumerate(texts)]
    df = corpus([(None if k == 1 else 1, t, lang) for k, (t, lang) in enumerate(rows)]).repartition(4)
    for top in (5, 2000):
        found = phrases.collocations(df, min_count=30, top=top, counter_bits=bits)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == phrases_by_hand(rows, 30, top)


def test_no_phrases(spark, corpus):
    assert phrases.collocations(corpus([])).collect() == []
    assert phrases.collocations(corpus([(1, "a few words"), (2, None)])).collect() == []


def test_chunks_own_each_place_once():
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "b", "c.", "d", "e", "f,"]) for _ in range(3000)).encode()
    cuts = [c.split() for c in phrases.chunks(text)]
    assert len(cuts) > 20
    assert b" ".join(w for c in cuts for w in c[: -phrases.OVERLAP]) == b" ".join(phrases.tokens(text)[: -phrases.OVERLAP])
    assert all(one[-phrases.OVERLAP :] == two[: phrases.OVERLAP] for one, two in zip(cuts, cuts[1:]))


def test_score_is_exact_beyond_64_bits(spark):
    big = 5_000_000_000_000_000_003
    counts = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big - 2), ("en", "a b", 2, big - 4)], "lang string, phrase string, size int, f long"
    )
    (row,) = phrases.scored(counts).collect()
    assert row["score"] == 2000000 * (big - 4) // (2 * big - 2)


RULES = [
    ("net", "/", "block"),
    ("Example.net", "/en/", "allow"),
    ("a.example.net", "/en/x", "block"),
    ("org", None, "block"),
    ("org", "/ok", "allow"),
    ("both.com", "/", "allow"),
    ("both.com", "/", "block"),
    ("", "/", "block"),
    (None, "/", "block"),
    ("com", "/", None),
]
URLS = [
    None,
    "",
    "no scheme.net/",
    "http://net",
    "http://net/",
    "http://NET/?q",
    "x://y://a.net/",
    "http://example.net/en/",
    "http://example.net/EN/",
    "http://b.a.example.net/en/xy/z",
    "http://a.example.net/en/?/en/x",
    "http://notexample.net/en/",
    "http://user@example.net:80/en/",
    "http://x.org",
    "http://x.org/ok#",
    "http://x.org/o",
    "https://both.com/a",
    "https://www.com/a",
    "://",
    ":///",
    "http://.net/",
    "http://a..net/",
    "http://é.net/é/\n/",
    "http://" + "a." * 3000 + "net/" + "x/" * 3000,
]


def judged_by_hand(url):
    match = re.search("://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule_host, rule_path, action in RULES:
        if rule_host and action:
            rule_host, rule_path = rule_host.lower(), rule_path or ""
            if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
                fits.append((len(rule_host + rule_path), len(rule_host), action, rule_host + rule_path))
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def test_urls_match_brute_force(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(URLS)] + [(None, "http://net/", "h", "p")] * 3, "page_id long, url string, host string, path string")
    found = url_rules.judge(pages.repartition(2), rules).collect()
    expected = [(k, *judged_by_hand(u)) for k, u in enumerate(URLS)] + [(None, "net", "/", "net/", "block")] * 3
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:3])
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_urls_without_rules_or_rows_and_many_copies(spark, monkeypatch):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://net/")] * 10_000, "page_id long, url string")
    assert url_rules.judge(pages, rules.limit(0)).groupBy("verdict").count().collect() == [("allow", 10_000)]
    monkeypatch.setattr(url_rules, "COPIES", 7)
    assert url_rules.judge(pages, rules).groupBy("verdict", "rule").count().collect() == [("block", "net/", 10_000)]
    assert url_rules.judge(pages.limit(0), rules).collect() == []


def test_urls_use_no_python(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    plan = url_rules.judge(spark.range(3).selectExpr("id AS page_id", "'http://a/' AS url"), rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
