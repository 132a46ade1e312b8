"""Empty tables and very long texts for operators whose other tests leave them out."""

import random

import public_tokenizers

from sparring.llm import bpe, chat_format, decontaminate, jaccard_join, substring_dedup


def test_empty_tables(spark, corpus):
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chats(chats).collect() == []
    assert bpe.token_digests(corpus([]), public_tokenizers.path("byte_bpe_50k.json")).collect() == []


def test_very_long_texts(spark, corpus):
    """Two near copies of 60,000 words, one of which holds a benchmark item."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    other = list(words)
    other[30_000:30_000] = [f"item{k}" for k in range(20)]
    docs = corpus([(1, " ".join(words)), (2, " ".join(other)), (3, "short")])
    benchmark = spark.createDataFrame([(7, " ".join(f"item{k}" for k in range(20)))], "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert [(r["doc_id"], r["item_id"], r["first_word"]) for r in found] == [(2, 7, 30_000)]
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.component_table(docs).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}
    left = {r["doc_id"]: r for r in substring_dedup.remove_repeated_windows(docs).collect()}
    assert left[1]["n_removed"] == 0 and left[2]["n_removed"] == 60_000 and left[2]["text"] == " ".join(f"item{k}" for k in range(20))
