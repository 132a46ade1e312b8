"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Every distinct pretoken of a slice of texts is a row of a matrix; rows of one size class are merged in lockstep. A
row's segment tree holds rank * size + position for each adjacent pair, so its root names the leftmost pair of lowest
rank. A merge changes three leaves (the pair itself and its two neighbours), each updated along one path to the root.

Null and empty texts have no tokens and decode to the empty text. Texts of any length are taken whole. Rows are
independent of each other: repeated rows and repeated ids give repeated results, an empty table an empty one. Columns
of the input pass through; one that is named like an output column is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import slices

#: How byte-level vocabularies cut texts into pretokens.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pretokens remembered by a task, and merged at once.
REMEMBERED, AT_ONCE = 100_000, 10_000
#: Bytes of text that are cut into pretokens at once.
TEXT_AT_ONCE = 1 << 20
NONE = np.int64(1) << 40
#: An empty leaf of a segment tree, above every rank * size + position whatever the size.
EMPTY = np.int64(np.iinfo(np.int64).max)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary as arrays; its size is that of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, letters = content["model"]["vocab"], byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.byte_ids = np.array([ids[x] for x in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.token_bytes = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, number in ids.items():
            self.token_bytes[number] = bytes(byte_of[c] for c in token)
        for token, number in self.special.items():
            self.token_bytes[number] = token.encode()
        first = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_pair_ranks = self.rank(*first).reshape(256, 256)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, NONE if they don't merge."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], NONE)


def merge_rows(words: list[bytes], size: int, vocabulary: Vocabulary) -> list[bytes]:
    """Tokens of words of at most `size` bytes (a power of two), as packed 32-bit ids."""
    n, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)
    column = np.arange(size)
    token = vocabulary.byte_ids[raw]
    after = np.where(column + 1 < lengths[:, None], column + 1, -1)
    before = np.tile(column - 1, (n, 1))
    tree = np.full((n, 2 * size), EMPTY)
    if size > 1:
        ranks = np.where(after[:, :-1] >= 0, vocabulary.byte_pair_ranks[raw[:, :-1], raw[:, 1:]], NONE)
        tree[:, size:-1] = np.where(ranks < NONE, ranks * size + column[:-1], EMPTY)
    level = size // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2

    def update(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = at + size
        tree[rows, node] = value
        for _ in range(size.bit_length() - 1):
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    rows = np.flatnonzero(tree[:, 1] < EMPTY)
    while len(rows):
        root = tree[rows, 1]
        at = root % size
        gone = after[rows, at]
        token[rows, at] = vocabulary.merged[root // size]
        right = after[rows, gone]
        after[rows, at] = right
        after[rows, gone] = -2
        update(rows, gone, np.full(len(rows), EMPTY))
        has = right >= 0
        before[rows[has], right[has]] = at[has]
        value = np.full(len(rows), NONE)
        value[has] = vocabulary.rank(token[rows[has], at[has]], token[rows[has], right[has]])
        update(rows, at, np.where(value < NONE, value * size + at, EMPTY))
        left = before[rows, at]
        has = left >= 0
        some, left, at = rows[has], left[has], at[has]
        value = vocabulary.rank(token[some, left], token[some, at])
        update(some, left, np.where(value < NONE, value * size + left, EMPTY))
        rows = rows[tree[rows, 1] < EMPTY]
    kept = (after != -2) & (column < lengths[:, None])
    flat, ends = token[kept].astype(np.int32).tobytes(), (4 * np.cumsum(kept.sum(1))).tolist()
    return [flat[s:e] for s, e in zip([0, *ends], ends)]


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Tokens of each word, merged in lockstep by size class, as packed 32-bit ids."""
    out = [b""] * len(words)
    classes: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        if word:
            classes.setdefault(1 << max(0, (len(word) - 1).bit_length()), []).append(k)
    for size, members in classes.items():
        step = max(1, AT_ONCE * 16 // max(16, size))
        for start in range(0, len(members), step):
            some = members[start : start + step]
            for k, tokens in zip(some, merge_rows([words[k] for k in some], size, vocabulary)):
                out[k] = tokens
    return out


class Encoder:
    """Encodes texts, remembering a bounded number of pretokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}
        self.pretoken = regex.compile(PRETOKEN)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def pretokens(self, text: str) -> list[str | int]:
        """Pretokens, and the ids of special tokens written out in the text."""
        if self.special is None or not self.special.search(text):
            return self.pretoken.findall(text)
        parts = self.special.split(text)
        return [x for k, part in enumerate(parts) for x in ([self.vocabulary.special[part]] if k % 2 else self.pretoken.findall(part))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Tokens of each text, as packed 32-bit ids."""
        split = [self.pretokens(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(chain.from_iterable(split)).difference(self.known))
        words = [w for w in new if isinstance(w, str)]
        self.known.update(zip(words, encode_words([w.encode() for w in words], self.vocabulary)))
        self.known.update((w, np.int32(w).tobytes()) for w in new if isinstance(w, int))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def as_lists(ids: list[bytes]) -> pa.ListArray:
    """Packed ids as an array<int> column."""
    ends = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def decoded_text(ids: list[int], vocabulary: Vocabulary) -> str:
    return b"".join(map(vocabulary.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """`docs` with `ids_col`, the tokens of `text_col` as array<int>, and if named `decoded_col`, the text of those tokens.

    The driver reads the vocabulary file and sends it.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))
    added = [ids_col, *([decoded_col] if decoded_col else [])]
    base = docs.drop(*added)
    at = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in slices(batches, at, TEXT_AT_ONCE):
            ids = encoder.encode(batch.column(at).to_pylist())
            columns = [*batch.columns, as_lists(ids)]
            if decoded_col:
                columns.append(pa.array([decoded_text(np.frombuffer(x, np.int32).tolist(), sent.value) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])

    kinds = [F.lit(None).cast(t).alias(c) for c, t in zip(added, ("array<int>", "string"))]
    return base.mapInArrow(run, base.select("*", *kinds).schema)


def decode(encoded: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`encoded` with `text_col`, the text of `ids_col`; bytes that are no UTF-8 become U+FFFD, null ids the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))
    base = encoded.drop(text_col)
    at = base.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One row's ids at a time become Python numbers.
            texts = [decoded_text(row.values.to_pylist(), sent.value) if row.is_valid else "" for row in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_col])

    return base.mapInArrow(run, base.select("*", F.lit(None).cast("string").alias(text_col)).schema)


def token_digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of the decimal ids joined by commas and of the decoded text."""
    encoded = encode(docs.select("doc_id", "text"), vocabulary_path, decoded_col="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
