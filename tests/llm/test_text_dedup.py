"""Line and substring removal, Jaccard components: small cases against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparring.llm import jaccard_join, line_dedup, substring_dedup
from sparring.llm.graph import components


def lines_by_rule(rows):
    keys = {}
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                key = line.strip(" \t\n\r\x0b\x0c").lower()
                if len(key) >= 20:
                    keys.setdefault(key, set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(d := keys.get(x.strip(" \t\n\r\x0b\x0c").lower(), ())) < 3 or doc == max(d)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines(corpus):
    rng = random.Random(1)
    pool = [f"line number {k} with some words" for k in range(12)] + ["short", "", "é" * 19, "é" * 20]
    rows = [(d, "\n".join(rng.choice([" ", "\t", ""]) + rng.choice(pool) for _ in range(rng.randint(0, 8)))) for d in range(60)]
    rows += [(None, pool[0]), (None, None), (7, pool[1]), (7, pool[1]), (61, None), (62, ""), (63, "x" * 100_000)]
    got = line_dedup.drop_repeated_lines(corpus(rows), filter_bits=12)
    found = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=repr)
    assert found == lines_by_rule(rows)
    assert "score" in got.columns


def substrings_by_rule(rows, width=13):
    words = [(d, (t or "").split()) for d, t in rows]
    first = {}
    for doc, w in words:
        for k in range(len(w) - width + 1):
            if doc is not None:
                key = tuple(w[k : k + width])
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, w in words:
        gone = {k + j for k in range(len(w) - width + 1) if doc is not None and first[tuple(w[k : k + width])] < doc for j in range(width)}
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_windows", [20, 100_000])
def test_substrings(corpus, bucket_windows):
    rng = random.Random(2)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for doc in range(40):
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))]
        if doc % 3 == 0:
            words[len(words) // 2 : 0] = passage[rng.randint(0, 10) : rng.randint(11, 30)]
        rows.append((doc, " ".join(words)))
    rows += [(50 + k, "x " * 40) for k in range(5)] + [(3, rows[3][1]), (3, "x " * 20), (None, "x " * 20), (60, None), (61, "")]
    got = substring_dedup.remove_repeated_windows(corpus(rows), bucket_windows=bucket_windows)
    found = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()), key=repr)
    assert found == substrings_by_rule(rows)


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def components_by_rule(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, (d, a) in enumerate(sets):
        for j, (e, b) in enumerate(sets[:i]):
            if d is not None and e is not None and a and b and (d == e or 100 * len(a & b) >= 75 * len(a | b)):
                group[max(root(i), root(j))] = min(root(i), root(j))
    smallest = {}
    for k, (d, s) in enumerate(sets):
        if d is not None and s:
            smallest[root(k)] = min(d, smallest.get(root(k), d))
    return sorted(((d, len(s), smallest[root(k)] if d is not None and s else d) for k, (d, s) in enumerate(sets)), key=repr)


def test_jaccard(corpus):
    rng = random.Random(3)
    rows, boiler = [], " ".join(f"b{k}" for k in range(40))
    for group in range(30):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 6, 12, 40, 90, 300]))]
        for copy in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = f"z{rng.randint(0, 9)}"
            text = " ".join(words) + (" " + boiler if rng.random() < 0.4 else "")
            rows.append((100 * copy + group, text.upper() if rng.random() < 0.2 else text))
    rows += [(900 + k, f"{boiler} end{k} of {k}") for k in range(20)]
    rows += [(None, boiler), (None, None), (1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (5, "one")]
    rng.shuffle(rows)
    got = jaccard_join.component_table(corpus(rows))
    found = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert found == components_by_rule(rows)


def test_further_laps_find_every_link(corpus, monkeypatch):
    """Groups that the first comparison leaves apart are searched to the end, in laps of one place."""
    monkeypatch.setattr(jaccard_join, "LAG", 1)
    rng = random.Random(4)
    common = [f"c{k}" for k in range(30)]
    rows = [(k, " ".join(common + [f"t{rng.randint(0, 3)}x{j}" for j in range(6)])) for k in range(30)]
    got = jaccard_join.component_table(corpus(rows))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == components_by_rule(rows)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}


def test_empty_tables(corpus):
    empty = corpus([])
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert substring_dedup.remove_repeated_windows(empty).count() == 0
    assert jaccard_join.component_table(empty).count() == 0


def test_filter_words_are_merged_before_the_driver(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FILTER_BITS", 12)
    sent = []
    frame = type(spark.range(1))
    rows = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: sent.extend(rows(self)) or sent)
    bits = jaccard_join.wanted_filter(spark.range(3000).withColumnRenamed("id", "doc_id"))
    monkeypatch.setattr(frame, "collect", rows)
    assert len(sent) <= 1 << 6
    hashes = [r[0] & (1 << 64) - 1 for r in spark.range(3000).select(F.xxhash64("id")).collect()]
    places = {h >> shift & 4095 for h in hashes for shift in jaccard_join.FILTER_SHIFTS}
    assert {w * 64 + b for w in range(64) for b in range(64) if int(bits[w]) >> b & 1} == places


def test_columns_named_like_inner_ones_pass_through(spark):
    line = "a line that stands in many documents"
    rows = [(k, line + "\n" + " ".join(f"w{j}" for j in range(20)), k + 0.5, "x") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _lost double, _LOST_ID string")
    lines = line_dedup.drop_repeated_lines(docs).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in lines] == [2, 2, 2, 0] and [r["_lost"] for r in lines] == [0.5, 1.5, 2.5, 3.5]
    windows = substring_dedup.remove_repeated_windows(docs).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in windows] == [0, 27, 27, 27] and [r["_LOST_ID"] for r in windows] == ["x"] * 4


def test_sketches_of_long_sets_are_told_apart(spark):
    """Unrelated sets of 4,000 members are not plausible pairs; similar ones of unequal widths are."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64)) for _ in range(30)]
    near = np.unique(np.concatenate([sets[0][:3990], rng.integers(0, 1 << 63, 200, dtype=np.uint64)]))  # of the next width
    assert len(jaccard_join.parity_sketch(near)) == 2 * len(jaccard_join.parity_sketch(sets[0]))
    sets.append(near)
    rows = [(i, j, len(a), len(b), jaccard_join.parity_sketch(a), jaccard_join.parity_sketch(b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j]
    pairs = spark.createDataFrame(rows, "a long, b long, n_a long, n_b long, short_a binary, short_b binary")
    assert jaccard_join.plausible(pairs).collect() == [(0, 30)]
    for one, two in ((sets[0], near), (sets[1], sets[2])):
        apart = jaccard_join.distances([jaccard_join.parity_sketch(one)], [jaccard_join.parity_sketch(two)])[0]
        assert apart <= len(np.setxor1d(one, two))


def test_sketches_are_no_wider_than_it_takes():
    """At most two bits a member beyond the least width, and unrelated sets still differ in more bits than a link allows."""
    rng = np.random.default_rng(2)
    for n in (200, 511, 512, 700, 1023, 1024, 3000):
        one, two = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(2))
        sketches = [jaccard_join.parity_sketch(s) for s in (one, two)]
        assert all(n < 8 * len(s) <= max(512, 2 * n) for s in sketches)
        assert 2 * n // 7 < jaccard_join.distances(sketches[:1], sketches[1:])[0] <= 2 * n


def test_long_sets_in_further_laps(corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LAG", 1)
    rng = random.Random(6)
    common = [f"c{k}" for k in range(900)]
    tails = [[f"t{g}x{j}" for j in range(1200)] for g in range(3)]
    rows = []
    for k in range(12):
        words = common + tails[k % 3]
        for _ in range(8):
            words[rng.randrange(900, 2100)] = f"z{rng.randint(0, 99)}"
        rows.append((k, " ".join(words)))
    got = jaccard_join.component_table(corpus(rows))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == components_by_rule(rows)


def test_disputed_groups_write_no_pair_for_each_block(corpus, monkeypatch):
    """Texts that are nearly similar enough share many blocks; only pairs that could connect a group are written with them."""
    rng = random.Random(8)
    common = [f"c{k}" for k in range(330)]
    rows = [(k, " ".join(common + [f"t{rng.randint(0, 1 << 30)}" for _ in range(62 + k % 4)])) for k in range(24)]
    rows.append((50, rows[3][1] + " end"))
    made = {}

    def counted(df, label):
        out = materialize(df, label)
        made.setdefault(label, []).append(out.count())
        return out

    materialize = jaccard_join.materialize
    monkeypatch.setattr(jaccard_join, "materialize", counted)
    got = jaccard_join.component_table(corpus(rows))
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == components_by_rule(rows)
    written = made["near-pairs"][1:]  # the first are pairs with the smallest of a group, before any search
    assert sum(written) < made["unlike-groups"][0]
    assert made["tried-pairs"][0] > 0 and made["tried-pairs"][1] < 24 * 23 // 2 // 4
