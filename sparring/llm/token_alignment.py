"""Alignment of two tokenizers over a corpus, with pair counts behind a minimal perfect hash.

Both tokenizers cut the same bytes (a space and the text); where tokens of both end together a group ends, and all A
tokens of a group are linked with all B tokens of it. The count of an id pair is the number of documents that hold it
linked.

Texts are cut at spaces where tokens of both always end; in a run of texts each distinct unit is aligned once.

The first pass aligns all documents and gives each task's distinct pairs with their document counts, dealt into SHARDS
by hash. The keys of a shard are united (in two levels) and get a minimal perfect hash: a cascade of bit arrays in
which each key owns the first bit that no other key of its level hits, its slot being the rank of that bit. The keys
stand beside in the order of slots, so that a looked-up key is verified. Counts are dense vectors indexed by slot:
each branch of tasks sums its own, and the vectors of a shard are then added. The second pass aligns the documents anew
and looks up the counts.

A pair is one number below 2**32, so a shard has at most (A ids * B ids) / SHARDS keys, whatever the corpus: 6.3 million
with vocabularies of 50,257 and 32,000. The hash with keys and counts is broadcast in parts of at most PART_BYTES; if
there are several, the second pass keeps each document's distinct pairs in the staging folder and goes through the
parts one after the other. The highest count of each A id is one number for each entry of the vocabulary.

Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: all numbers are 0
and `groups` is ''. Every row is a document of its own, also rows of null or repeated ids, which are not looked at. Texts
are taken whole; groups of over BIG links are counted by distinct ids and their multiplicities. Empty tables give empty
results. Columns of the input pass through, except those named like an output column, which are replaced. Special
tokens are plain text in a text. A's vocabulary must be byte-level BPE whose ids follow its merges.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.llm.bpe import PRETOKEN, Vocabulary
from sparring.llm.common import mixed, slices
from sparring.session import materialize

SHARD_BITS = 8
SHARDS = 1 << SHARD_BITS
#: Branches of tasks whose counts are summed before those of a shard are.
BRANCHES = 16
#: Text bytes aligned at once; links above which a group is counted by distinct ids; keys of a row between tasks.
TEXT_BYTES, BIG, PIECE = 2 << 20, 256, 1 << 14
#: Units that are encoded as one text.
TOGETHER = 256
#: Units that a process remembers.
KNOWN_UNITS = 600_000
#: Pairs that a task holds before it hands them on.
HELD_PAIRS = 4 << 20
#: Bytes of hash, keys and counts that are broadcast at once.
PART_BYTES = 128 << 20
SPACE_RUN, CUT = re.compile(r"\s "), re.compile(r"(?<=\S)(?= )")
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Encoders:
    """Both tokenizers, the bytes of their entries and their ids in writing."""

    def __init__(self, a_path: str, b_path: str):
        vocabulary = Vocabulary(a_path)
        if not (np.diff(vocabulary.merged) > 0).all():
            raise ValueError("the ids of the first vocabulary must follow the order of its merges")
        special = set(vocabulary.special.values())
        ranks = {b: k for k, b in enumerate(vocabulary.token_bytes) if b and k not in special}
        self.a = tiktoken.Encoding("a", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.n_a, self.n_b = len(vocabulary.token_bytes), self.b.get_piece_size()
        pieces = [self.b.id_to_piece(k) for k in range(self.n_b)]
        self.b_bytes = np.array(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)], object
        )
        self.a_sizes = np.array([len(t) for t in vocabulary.token_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # No piece of B reaches over a space that follows another character, so texts may be cut there.
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.memory = Memory(self)
        # Each id followed by what stands behind it: A inside and at the end of a group, then B.
        self.written = np.array([f"{k}{sign}" for n, signs in ((self.n_a, ",|"), (self.n_b, ",;")) for sign in signs for k in range(n)], object)


@functools.cache
def encoders(a_path: str, b_path: str) -> Encoders:
    return Encoders(a_path, b_path)


def units(text: str) -> list[str]:
    """A space and the text, cut before each space that follows a character other than white space.

    Tokens of both vocabularies end at such a place, whatever stands around it.
    """
    if SPACE_RUN.search(" " + text):
        return CUT.split(" " + text)
    return [" " + piece for piece in text.split(" ")]


def encoded_units(found: list[str], both: Encoders) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A ids, B ids, numbers of both for each unit, and whether both tokenizers give the unit back byte by byte."""
    # Units that end with another character than white space are put together to texts, the others encoded by themselves.
    alone = [k for k, u in enumerate(found) if u[-1].isspace()]
    left = set(alone)
    joined = [k for k in range(len(found)) if k not in left] if left else list(range(len(found)))
    texts = ["".join([found[k] for k in joined[s : s + TOGETHER]]) for s in range(0, len(joined), TOGETHER)]
    b = list(chain.from_iterable(both.b.encode([t[1:] for t in texts], num_threads=1))) if texts else []
    b = np.array(b, np.int64)
    if b"".join(both.b_bytes[b]) != "".join(texts).encode():
        joined, alone, texts = [], list(range(len(found))), []
        b = b[:0]
    a = np.concatenate([np.zeros(0, np.int64), *map(both.a.encode_to_numpy, texts)]).astype(np.int64)
    ends = np.cumsum([len(found[k].encode()) for k in joined], dtype=np.int64)
    place = np.array(joined, np.int64)
    a_unit, b_unit = (place[np.searchsorted(ends, np.cumsum(n[x]))] for n, x in ((both.a_sizes, a), (both.b_sizes, b)))
    good = np.ones(len(found), bool)
    a_parts, b_parts, a_units, b_units = [a], [b], [a_unit], [b_unit]
    for k in alone:
        # Behind another unit, as the encoder gives nothing for an empty text.
        one = np.array(both.b.encode("a" + found[k])[len(both.b.encode("a")) :], np.int64)
        good[k] = b"".join(both.b_bytes[one]) == found[k].encode()
        if good[k]:
            two = both.a.encode_to_numpy(found[k]).astype(np.int64)
            a_parts.append(two)
            b_parts.append(one)
            a_units.append(np.full(len(two), k))
            b_units.append(np.full(len(one), k))
    a, b, a_unit, b_unit = (np.concatenate(x) for x in (a_parts, b_parts, a_units, b_units))
    a, b = a[np.argsort(a_unit, kind="stable")], b[np.argsort(b_unit, kind="stable")]
    return a, b, np.bincount(a_unit, minlength=len(found)), np.bincount(b_unit, minlength=len(found)), good


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places from `first` on, `count` of them for each entry."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


class Memory:
    """The ids of units seen before by this process, at most about KNOWN_UNITS of them."""

    def __init__(self, both: Encoders):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.first = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.good = np.zeros(0, bool)

    def known(self, found: list[str]) -> np.ndarray:
        """The numbers under which the units stand here; new ones are encoded."""
        if len(self.places) > KNOWN_UNITS:
            self.clear()
        at = list(map(self.places.get, found))
        if None in at:
            new = list(dict.fromkeys(u for u, k in zip(found, at) if k is None))
            *ids, n_a, n_b, good = encoded_units(new, self.both)
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            for k, n in enumerate((n_a, n_b)):
                self.ids[k] = np.concatenate([self.ids[k], ids[k].astype(np.int32)])
                self.first[k] = np.concatenate([self.first[k], self.first[k][-1] + np.cumsum(n)])
            self.good = np.concatenate([self.good, good])
            at = list(map(self.places.__getitem__, found))
        return np.array(at, np.int64)

    def encoded(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As `encoded_units`, of the units of these numbers."""
        counts = [(f[1:] - f[:-1])[at] for f in self.first]
        ids = [x[spans(f[at], n)].astype(np.int64) for x, f, n in zip(self.ids, self.first, counts)]
        return (*ids, *counts, self.good[at])


class Units:
    """The tokens, groups and links of distinct units; `good` says which ones both tokenizers give back byte by byte."""

    def __init__(self, known: np.ndarray, both: Encoders):
        self.both, self.size = both, len(known)
        self.a, self.b, n_a, n_b, self.good = both.memory.encoded(known)
        self.a_unit, self.b_unit = (np.repeat(np.arange(self.size), n) for n in (n_a, n_b))
        a_ends, b_ends = np.cumsum(both.a_sizes[self.a]), np.cumsum(both.b_sizes[self.b])
        total = int(a_ends[-1]) if len(a_ends) else 0
        at = np.zeros((2, total + 1), bool)
        at[0, a_ends], at[1, b_ends] = True, True
        self.a_last, self.b_last = at[1, a_ends], at[0, b_ends]
        self.a_group, self.b_group = (np.cumsum(x) - x for x in (self.a_last, self.b_last))
        self.group_unit = self.a_unit[self.a_last]
        self.in_a, self.in_b = (np.bincount(g, minlength=len(self.group_unit)) for g in (self.a_group, self.b_group))
        self.links = self.in_a * self.in_b

    def numbers(self) -> list[np.ndarray]:
        """n_a, n_b, n_groups and n_links of each unit."""
        links = np.zeros(self.size, np.int64)
        np.add.at(links, self.group_unit, self.links)
        return [*(np.bincount(x, minlength=self.size) for x in (self.a_unit, self.b_unit, self.group_unit)), links]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, key, times) of the links, by unit; in small groups each link by itself."""
        first_a, first_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        times = np.where(self.links <= BIG, self.in_b, 0)[self.a_group]
        a = np.repeat(np.arange(len(self.a)), times)
        b = first_b[self.a_group[a]] + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
        found = [(self.a_unit[a], self.a[a] * self.both.n_b + self.b[b], np.ones(len(a), np.int64))]
        for g in np.flatnonzero(self.links > BIG).tolist():
            one, n_one = np.unique(self.a[first_a[g] : first_a[g] + self.in_a[g]], return_counts=True)
            two, n_two = np.unique(self.b[first_b[g] : first_b[g] + self.in_b[g]], return_counts=True)
            keys = (one[:, None] * self.both.n_b + two).ravel()
            found.append((np.full(len(keys), self.group_unit[g]), keys, (n_one[:, None] * n_two).ravel()))
        unit, key, times = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(unit, kind="stable")
        return unit[order], key[order], times[order]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each unit's groups as places in `written`, and where the unit begins and ends there."""
        first_a, first_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        line = np.empty(len(self.a) + len(self.b), np.int64)
        place = np.arange(len(self.a)) + first_b[self.a_group], np.arange(len(self.b)) + (first_a + self.in_a)[self.b_group]
        line[place[0]] = self.a + self.both.n_a * self.a_last
        line[place[1]] = 2 * self.both.n_a + self.b + self.both.n_b * self.b_last
        unit = np.empty(len(line), np.int64)
        unit[place[0]], unit[place[1]] = self.a_unit, self.b_unit
        edges = np.flatnonzero(np.diff(unit, prepend=-1, append=-1))
        first, last = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        first[unit[edges[:-1]]], last[unit[edges[:-1]]] = edges[:-1], edges[1:]
        return line, first, last


class Aligned:
    """The alignments of a run of texts; each distinct unit is aligned once. `doc` numbers the texts."""

    def __init__(self, texts: list[str | None], both: Encoders):
        self.size = len(texts)
        cut = [(units(t) if both.separable else [" " + t]) if t else [] for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        known, unit = np.unique(both.memory.known(list(chain.from_iterable(cut))), return_inverse=True)
        self.units = Units(known, both)
        doc = np.repeat(np.arange(len(cut)), sizes)
        lost = np.zeros(len(cut), bool)
        lost[doc[~self.units.good[unit]]] = True
        self.unit, self.doc = unit[~lost[doc]], doc[~lost[doc]]

    def numbers(self) -> list[np.ndarray]:
        """n_a, n_b, n_groups and n_links of each text."""
        return [self.per_doc(n[self.unit]) for n in self.units.numbers()]

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size, np.int64)
        np.add.at(out, self.doc, values)
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, key, times) of the links; a key may come several times for a text."""
        held, many = np.unique(self.doc * self.units.size + self.unit, return_counts=True)
        doc, unit = np.divmod(held, max(1, self.units.size))
        owner, key, times = self.units.pairs()
        first = np.searchsorted(owner, np.arange(self.units.size + 1))
        count = np.diff(first)[unit]
        at = spans(first[unit], count)
        return np.repeat(doc, count), key[at], times[at] * np.repeat(many, count)

    def pair_documents(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs and how many of the texts hold each."""
        doc, key, _ = self.pairs()
        return np.unique(np.unique(doc << 32 | key) & 0xFFFFFFFF, return_counts=True)

    def sums(self, table: PairCounts, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n_best, count_sum) of each text, over the links whose pair stands in `table`."""
        best, total = found_counts(*self.units.pairs(), table, most, self.units.both.n_b, self.units.size)
        return self.per_doc(best[self.unit]), self.per_doc(total[self.unit])

    def groups(self) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        line, first, last = self.units.lines()
        count = (last - first)[self.unit]
        ends = np.cumsum(count)
        words = self.units.both.written[line[spans(first[self.unit], count)]].tolist()
        edges = np.append(0, ends)[np.searchsorted(self.doc, np.arange(self.size + 1))].tolist()
        return ["".join(words[s:e])[:-1] for s, e in zip(edges, edges[1:])]


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.uint64) ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(64 - SHARD_BITS)).astype(np.int64)


def level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys.astype(np.uint64) + np.uint64(level << 40))


def cascade(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes of the levels in bits, bits as 64-bit words) of a minimal perfect hash of distinct keys."""
    sizes, flags = [], []
    while len(keys):
        size = -(-2 * len(keys) // 64) * 64
        place = (level_hash(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        flags.append(alone)
        keys = keys[~alone[place]]
    bits = np.packbits(np.concatenate([np.zeros(0, bool), *flags]), bitorder="little")
    return np.array(sizes, np.int64), bits.view(np.uint64)


class PairCounts:
    """Keys and counts of some shards by the slots of their hashes; rows are (shard, sizes, words, keys, counts) as bytes."""

    def __init__(self, rows: list[tuple]):
        sizes = [np.frombuffer(r[1], np.int64) for r in rows]
        levels = max([0, *map(len, sizes)])
        self.sizes, self.base = np.zeros((levels, SHARDS), np.int64), np.zeros((levels, SHARDS), np.int64)
        start = 0
        for (shard, *_), own in zip(rows, sizes):
            self.sizes[: len(own), shard] = own
            self.base[: len(own), shard] = start + np.cumsum(own) - own
            start += int(own.sum())
        self.words, self.keys = (np.frombuffer(b"".join(bytes(r[k]) for r in rows), t) for k, t in ((2, np.uint64), (3, np.uint32)))
        self.counts = np.frombuffer(b"".join(bytes(r[4]) for r in rows), np.int64) if rows and rows[0][4] is not None else np.zeros(len(self.keys), np.int64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = (np.cumsum(ones) - ones).astype(np.uint32)

    def ranked(self, keys: np.ndarray) -> np.ndarray:
        """The slot to which the bits lead each key (any slot or -1 if the hash was not made for the key)."""
        out, open_, shard = np.full(len(keys), -1, np.int64), np.arange(len(keys)), shard_of(keys)
        for level in range(len(self.sizes)):
            size = self.sizes[level, shard[open_]]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            at = self.base[level, shard[open_]] + (level_hash(keys[open_], level) % size.astype(np.uint64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.ranks[at[hit] >> 6] + np.bitwise_count(below).astype(np.int64)
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if the key is not among those of these shards."""
        out = self.ranked(keys)
        known = out >= 0
        out[known] = np.where(self.keys[out[known]] == keys[known], out[known], -1)
        return out


def counted_pairs(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(shard, branch, keys, counts): distinct pairs of the documents a task has seen, and how many of them hold each."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, np.concatenate([c for _, c in held]))
        return keys, counts

    def handed(held: list[tuple[np.ndarray, np.ndarray]], branch: int) -> Iterator[pa.RecordBatch]:
        keys, counts = merged(held)
        shard = shard_of(keys)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(SHARDS + 1))
        runs = [order[k : min(k + PIECE, e)] for s, e in zip(edges, edges[1:]) for k in range(s, e, PIECE)]
        yield pa.record_batch(
            [
                pa.array([int(shard[r[0]]) for r in runs], pa.int32()),
                pa.array([branch] * len(runs), pa.int32()),
                pa.array([keys[r].astype(np.uint32).tobytes() for r in runs], pa.binary()),
                pa.array([counts[r].tobytes() for r in runs], pa.binary()),
            ],
            ["shard", "branch", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, held, size, branch = encoders(a_path, b_path), [], 0, 0
        for batch in slices(batches, 0, TEXT_BYTES):
            branch = batch.column(1)[0].as_py()
            keys, counts = Aligned(batch.column(0).to_pylist(), both).pair_documents()
            held.append((keys, counts))
            size += len(keys)
            if size > HELD_PAIRS:
                held = [merged(held)]
                size = len(held[0][0])
                if 2 * size > HELD_PAIRS:
                    yield from handed(held, branch)
                    held, size = [], 0
        if held:
            yield from handed(held, branch)

    texts = rows.select("text", (F.spark_partition_id() % BRANCHES).alias("branch"))
    return texts.mapInArrow(run, "shard int, branch int, keys binary, counts binary")


def by_group(run: Callable[[tuple, Iterator[dict]], Iterator[dict]], names: list[str]) -> Callable:
    """Makes a function of one group's rows, which arrive in order, one of a partition's batches; `names` are the group's columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns)}

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        left = rows(batches)
        row = next(left, None)
        while row is not None:
            group = tuple(row[n] for n in names)

            def own() -> Iterator[dict]:
                nonlocal row
                while row is not None and tuple(row[n] for n in names) == group:
                    yield row
                    row = next(left, None)

            yield from run(group, own())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in whole(batches):
            yield pa.RecordBatch.from_pylist([row], out.schema)

    return out


def grouped(df: DataFrame, keys: list[str], run: Callable, fields: list[tuple[str, pa.DataType]], order: list[str] = ()) -> DataFrame:
    """`run` over each group of `keys`, whose rows stream in `order`: a group is never held whole."""
    step = by_group(run, keys)
    step.schema = pa.schema(fields)
    kinds = {pa.int32(): "int", pa.binary(): "binary"}
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(step, ", ".join(f"{n} {kinds[t]}" for n, t in fields))


def hashed_shards(parts: DataFrame) -> DataFrame:
    """(shard, sizes, words, keys): the minimal perfect hash of each shard's distinct pairs, and the pairs by slot."""

    def united(rows: Iterator[dict]) -> np.ndarray:
        known, held, size = np.zeros(0, np.uint32), [], 0
        for row in rows:
            held.append(np.frombuffer(row["keys"], np.uint32))
            size += len(held[-1])
            if size > HELD_PAIRS:
                known, held, size = np.unique(np.concatenate([known, *held])), [], 0
        return np.unique(np.concatenate([known, *held]))

    def branch(group: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        keys = united(rows)
        for k in range(0, len(keys), PIECE):
            yield {"shard": group[0], "keys": keys[k : k + PIECE].tobytes()}

    def shard(group: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        keys = united(rows)
        sizes, words = cascade(keys)
        row = (group[0], sizes.tobytes(), words.tobytes(), b"", None)
        ordered = np.empty(len(keys), np.uint32)
        ordered[PairCounts([row]).ranked(keys)] = keys
        yield {"shard": group[0], "sizes": row[1], "words": row[2], "keys": ordered.tobytes()}

    some = grouped(parts.select("shard", "branch", "keys"), ["shard", "branch"], branch, [("shard", pa.int32()), ("keys", pa.binary())])
    return grouped(some, ["shard"], shard, [("shard", pa.int32()), ("sizes", pa.binary()), ("words", pa.binary()), ("keys", pa.binary())])


def summed_counts(parts: DataFrame, hashes: DataFrame) -> DataFrame:
    """(shard, counts): the sum of the parts' dense count vectors, by branch and then by shard."""

    def branch(group: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        first = next(rows)  # the hash
        table = PairCounts([(group[0], first["sizes"], first["words"], first["keys"], None)])
        vector = np.zeros(len(table.keys), np.int64)
        for row in rows:
            vector[table.slots(np.frombuffer(row["keys"], np.uint32))] += np.frombuffer(row["counts"], np.int64)
        yield {"shard": group[0], "counts": vector.tobytes()}

    def shard(group: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        total: np.ndarray | int = 0
        for row in rows:
            total = total + np.frombuffer(row["counts"], np.int64)
        yield {"shard": group[0], "counts": total.tobytes()}

    nothing = F.lit(None).cast("binary")
    needed = parts.select("shard", "branch").distinct().join(hashes, "shard")
    first = needed.select("shard", "branch", F.lit(0).alias("kind"), "sizes", "words", "keys", nothing.alias("counts"))
    then = parts.select("shard", "branch", F.lit(1).alias("kind"), nothing.alias("sizes"), nothing.alias("words"), "keys", "counts")
    fields = [("shard", pa.int32()), ("counts", pa.binary())]
    return grouped(grouped(first.union(then), ["shard", "branch"], branch, fields, ["kind"]), ["shard"], shard, fields)


def highest_counts(index: DataFrame, n_a: int, n_b: int) -> np.ndarray:
    """The highest count of a pair with each A id; the driver gets one number for each entry of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = np.zeros(n_a, np.int64)
            for keys, counts in zip(*(batch.column(k).to_pylist() for k in range(2))):
                np.maximum.at(most, np.frombuffer(keys, np.uint32) // np.uint32(n_b), np.frombuffer(counts, np.int64))
            some = np.flatnonzero(most)
            yield pa.record_batch([pa.array(some), pa.array(most[some])], ["a", "most"])

    out = np.zeros(n_a, np.int64)
    for row in index.select("keys", "counts").mapInArrow(run, "a long, most long").groupBy("a").agg(F.max("most").alias("most")).collect():
        out[row["a"]] = row["most"]
    return out


def pair_index(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(shard, sizes, words, keys, counts) of all pairs of `rows` (text)."""
    parts = materialize(counted_pairs(rows, a_path, b_path), "pair-parts")
    hashes = materialize(hashed_shards(parts), "pair-hashes")
    return materialize(hashes.join(summed_counts(parts, hashes), "shard"), "pair-index")


def index_parts(index: DataFrame, limit: int) -> list[list[int]]:
    """The shards in runs of at most `limit` bytes (or one shard); the driver gets one row for each of the SHARDS."""
    size = sum(F.length(c) for c in ("sizes", "words", "keys", "counts"))
    runs, used = [[]], 0
    for row in index.select("shard", size.alias("size")).orderBy("shard").collect():
        if runs[-1] and used + row["size"] > limit:
            runs, used = [*runs, []], 0
        runs[-1].append(row["shard"])
        used += row["size"]
    return runs


def found_counts(doc: np.ndarray, key: np.ndarray, times: np.ndarray, table: PairCounts, most: np.ndarray, n_b: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(n_best, count_sum) of each document, over the links whose pair stands in `table`."""
    distinct, place = np.unique(key, return_inverse=True)
    slot = table.slots(distinct)
    count = np.where(slot >= 0, table.counts[slot] if len(table.counts) else 0, 0)
    best = (slot >= 0) & (count == most[distinct // n_b])
    out = np.zeros((2, docs), np.int64)
    np.add.at(out[0], doc, times * best[place])
    np.add.at(out[1], doc, times * count[place])
    return out[0], out[1]


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """`docs` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2,b3`).

    n_best counts the links whose pair has the highest count of its A id, ties included; count_sum adds up the counts of
    all links.
    """
    context = docs.sparkSession.sparkContext
    index = pair_index(docs.select(F.col(text_col).alias("text")), a_path, b_path)
    n_a, n_b = encoders(a_path, b_path).n_a, encoders(a_path, b_path).n_b
    most = context.broadcast(highest_counts(index, n_a, n_b))
    runs = index_parts(index, part_bytes)

    def sent(shards: list[int]) -> object:
        rows = index.where(F.col("shard").isin(shards)) if shards else index.limit(0)
        return context.broadcast(PairCounts([(r["shard"], r["sizes"], r["words"], r["keys"], r["counts"]) for r in rows.orderBy("shard").collect()]))

    base = docs.drop(*COUNTS, "groups")
    at = base.columns.index(text_col)
    zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("binary")
    schema = base.select("*", *(zero.alias(c) for c in COUNTS), F.lit("").alias("groups"), nothing.alias("_keys"), nothing.alias("_times")).schema
    names = schema.names
    only = sent(runs[0]) if len(runs) == 1 else None

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(a_path, b_path)
        for batch in slices(batches, at, TEXT_BYTES):
            rows = batch.num_rows
            found = Aligned(batch.column(at).to_pylist(), both)
            if only is not None:
                sums = found.sums(only.value, most.value)
                kept = [pa.nulls(rows, pa.binary())] * 2
            else:
                sums = [np.zeros(rows, np.int64)] * 2
                doc, key, times = found.pairs()
                pair, place = np.unique(doc << 32 | key, return_inverse=True)
                total = np.zeros(len(pair), np.int64)
                np.add.at(total, place, times)
                edges = np.searchsorted(pair >> 32, np.arange(rows + 1)).tolist()
                spans = list(zip(edges, edges[1:]))
                kept = [pa.array([x[s:e].tobytes() for s, e in spans], pa.binary()) for x in ((pair & 0xFFFFFFFF).astype(np.uint32), total)]
            numbers = [*found.numbers(), *sums]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, numbers), pa.array(found.groups(), pa.string()), *kept], names)

    def lookup(part: object) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, len(names) - 2, TEXT_BYTES):
                keys, times = ([np.frombuffer(x, t) for x in batch.column(c).to_pylist()] for c, t in (("_keys", np.uint32), ("_times", np.int64)))
                doc = np.repeat(np.arange(batch.num_rows), [len(k) for k in keys])
                flat = np.concatenate(keys).astype(np.int64), np.concatenate(times)
                sums = found_counts(doc, *flat, part.value, most.value, n_b, batch.num_rows)
                for name, more in zip(("n_best", "count_sum"), sums):
                    batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(batch.column(name).to_numpy() + more))
                yield batch

        return run

    rows = base.mapInArrow(second, schema)
    if only is None:
        for shards in runs:
            part = sent(shards)
            rows = materialize(rows.mapInArrow(lookup(part), schema), "aligned")
    return rows.drop("_keys", "_times")


def alignment_digests(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: doc_id, the counts of `align`, and SHA-256 of its groups ('' without tokens)."""
    found = align(docs.select("doc_id", "text"), a_path, b_path)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return found.select("doc_id", *COUNTS, digest.alias("groups_sha256"))
