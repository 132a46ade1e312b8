"""Jaccard join of word n-gram sets with parity sketches; documents that link form components.

A document's set holds its distinct runs of five words, hashed. Its parity sketch toggles one bit for each member, in
blocks; a member in one set only toggles one bit, so it spoils at most one block, and the number of unequal blocks (as
the Hamming distance) is at most the symmetric difference. At similarity 3/4 that is at most a third of the set, so two
documents that link share a block among the first third plus one of each, in any common order of blocks: rare first, by
a count over the whole corpus. Blocks are kept as the XOR of mixed member hashes, equal exactly when the wide bit block
is. Sketches are compared per size band (powers of two; a document also joins the band below if it may have partners
there). The few documents with too few non-empty blocks for the bound also join by single members.

Equal sets are one node, so copies are never paired. In each group of a shared block, nodes are first compared with the
smallest; groups that this leaves in several components are then compared further by their sketches (bits by the low
bits of each hash, at least one a member, folded where widths differ), each node with nodes of other components up to
LAG places on in the order of size, then FURTHER times as far, until no pair of a group could add a link: no cap, and no
pairs among nodes that are linked already. Pairs that pass are checked exactly, first only those that a group needs to
become connected; where such a pair turns out to be no link, all others of its group between different components, by
sketches four times as wide, which few pairs pass that are no links.

Words are split at ASCII white space, A-Z lower-cased; with fewer than five words the whole sequence is the one member.
Null and empty texts have an empty set and link with nothing; so do rows of null id, whose component is null. Rows of
one id are one document for component ids, each with its own n_shingles. Texts are read whole. Hashes have 64 bits.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.llm.common import mixed, slices, window_hashes, word_hashes
from sparring.llm.graph import components
from sparring.session import materialize, release

WORDS = 5
#: Counters of block frequencies and bits of the filter of nodes to fetch: 8 MB and 2 MB, whatever the input.
COUNTER_BITS, FILTER_BITS = 20, 24
#: Least width of a sketch, as a power of two; fewest blocks of a band; places between nodes compared in the first round.
SHORT_BITS, LEAST_BLOCKS, LAG = 9, 64, 256
SHORT_BYTES = (1 << SHORT_BITS) // 8
#: How much wider the sketches of disputed groups are, as a power of two.
WIDER_BITS = 2
#: How much farther each further round goes.
FURTHER = 64
FILTER_SHIFTS = (64 - FILTER_BITS, 8)
CHUNK = 1 << 12
SALT = np.uint64(0xA0761D6478BD642F)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of runs of five words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(WORDS, len(words))))


def node_of(members: np.ndarray) -> int:
    """A signed 64-bit name of a set, None if it is empty."""
    both = np.bitwise_xor.reduce(mixed(members ^ SALT), keepdims=True) ^ np.array([len(members)], np.uint64)
    return int(mixed(both).view(np.int64)[0])


def parity_sketch(members: np.ndarray, wider: int = 0) -> bytes:
    """A bit for each value of the members' low bits, toggled by each member; one to two bits a member, times 2**wider.

    Sketches are most of what is shuffled besides blocks, so they are no wider than it takes: at one bit a member unrelated
    sets of n members differ in about 0.49 n bits, of which a link allows 0.29 n, and sets pass from a similarity of about
    0.65 on; at four bits a member from 0.73 on.

    Its first half XOR its second half is the sketch of half the width.
    """
    width = max(SHORT_BITS, len(members).bit_length()) + wider
    parity = np.bincount((members & np.uint64((1 << width) - 1)).astype(np.int64), minlength=1 << width) & 1
    return np.packbits(parity.astype(bool)).tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """The sketches (of one length) at a width of `size` bytes, as rows of 64-bit words."""
    out = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    while 8 * out.shape[1] > size:
        out = out[:, : out.shape[1] // 2] ^ out[:, out.shape[1] // 2 :]
    return out


def distances(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """Unequal bits of each pair of sketches, at the width of the narrower one: no more than the sets' unequal members."""
    out = np.zeros(len(one), np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in zip(one, two)], np.int64).reshape(len(one), 2)
    for x, y in np.unique(sizes, axis=0).tolist():
        at = np.flatnonzero((sizes[:, 0] == x) & (sizes[:, 1] == y))
        a, b = (folded([s[k] for k in at.tolist()], min(x, y)) for s in (one, two))
        out[at] = np.bitwise_count(a ^ b).sum(1)
    return out


def band_blocks(members: np.ndarray, band: int) -> np.ndarray:
    """Hash of band, place and content of each non-empty block."""
    bits = max(LEAST_BLOCKS, 1 << band).bit_length() - 1
    block = members >> np.uint64(64 - bits)
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    content = np.bitwise_xor.reduceat(mixed(members), starts)
    return mixed(content ^ mixed(block[starts] * np.uint64(64) + np.uint64(band + 1)))


def bands(n: int) -> list[int]:
    """The bands in which a set of n members meets its possible partners."""
    own = n.bit_length() - 1
    return [own, own - 1] if own and 3 * n <= 4 * ((1 << own) - 1) else [own]


def block_sets(members: np.ndarray) -> list[np.ndarray]:
    """Blocks by band, and single members where a band has too few blocks."""
    allowed = len(members) // 3
    found = [band_blocks(members, band) for band in bands(len(members))]
    return found + ([mixed(members ^ ~SALT)] if any(len(f) <= allowed for f in found) else [])


def counter_place(blocks: np.ndarray) -> np.ndarray:
    return (blocks >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def first_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n) of each row, with both sketches of a node that is new to its task, and from each task chunks of block counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << COUNTER_BITS, np.int64), set()
        names = ["doc_id", "node", "n", "short", "wide", "chunk", "counts"]
        for batch in slices(batches, 1):
            nodes, sizes, sketches, wider, blocks = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                members = shingle_set(text)
                node = node_of(members) if len(members) and doc is not None else None
                nodes.append(node)
                sizes.append(len(members))
                sketches.append(None)
                wider.append(None)
                if node is not None and node not in seen:
                    seen.add(node)
                    blocks += block_sets(members)
                    sketches[-1], wider[-1] = parity_sketch(members), parity_sketch(members, WIDER_BITS)
            if blocks:
                counts += np.bincount(counter_place(np.concatenate(blocks)), minlength=len(counts))
            rows = len(nodes)
            nothing = [pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())]
            columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())]
            columns += [pa.array(s, pa.binary()) for s in (sketches, wider)]
            yield pa.record_batch([*columns, *nothing], names)
        chunks = [k for k in range(len(counts) // CHUNK) if counts[k * CHUNK : (k + 1) * CHUNK].any()]
        data = [counts[k * CHUNK : (k + 1) * CHUNK].astype(np.uint32).tobytes() for k in chunks]
        empty = [pa.nulls(len(chunks), pa.int64()) for _ in range(3)]
        empty += [pa.nulls(len(chunks), pa.binary()) for _ in range(2)]
        yield pa.record_batch([*empty, pa.array(chunks, pa.int32()), pa.array(data, pa.binary())], names)

    schema = "doc_id long, node long, n long, short binary, wide binary, chunk int, counts binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def block_levels(scanned: DataFrame) -> np.ndarray:
    """How frequent the blocks of each counter are over the corpus, as a power of two."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                known[chunk] = known.get(chunk, 0) + np.frombuffer(data, np.uint32).astype(np.int64)
        for chunk, counts in known.items():
            yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["chunk", "counts"])

    total = np.zeros(1 << COUNTER_BITS, np.int64)
    merged = scanned.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    for row in merged.collect():
        total[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(row["counts"]), np.int64)
    return np.log2(1 + total).astype(np.uint8)


def chosen_blocks(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(block, node, n): the rarest blocks of each set, a third of its size plus one in each band."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = sent.value, set()
        for batch in slices(batches, 1):
            keys, nodes, sizes = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                members = shingle_set(text) if doc is not None else ()
                node = node_of(members) if len(members) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                for blocks in block_sets(members):
                    most = len(members) // 3 + 1
                    if len(blocks) > most:
                        blocks = blocks[np.lexsort((blocks, level[counter_place(blocks)]))[:most]]
                    keys.append(blocks)
                    nodes.append((node, len(members), len(blocks)))
            if keys:
                named = np.array(nodes, np.int64)
                columns = [np.concatenate(keys).view(np.int64), np.repeat(named[:, 0], named[:, 2]), np.repeat(named[:, 1], named[:, 2])]
                yield pa.record_batch([pa.array(c) for c in columns], ["block", "node", "n"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "block long, node long, n long")


def shared_blocks(chosen: DataFrame) -> DataFrame:
    """(block, node, n, hub, hub_n): nodes that share a block with a smaller or equal one, the group's first (hub)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # block, node, hub, size of hub
        for batch in batches:
            block, node, n = (batch.column(k).to_numpy() for k in range(3))
            if not len(block):
                continue
            new = np.concatenate([[last is None or block[0] != last[0]], block[1:] != block[:-1]])
            repeat = ~new & np.concatenate([[last is not None and node[0] == last[1]], node[1:] == node[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(block)), -1))
            hub, hub_n = node[first], n[first]
            if last is not None:
                hub, hub_n = np.where(first < 0, last[2], hub), np.where(first < 0, last[3], hub_n)
            keep = ~new & ~repeat
            last = (block[-1], node[-1], hub[-1], hub_n[-1])
            yield pa.record_batch([pa.array(c[keep]) for c in (block, node, n, hub, hub_n)], ["block", "node", "n", "hub", "hub_n"])

    ordered = chosen.repartition("block").sortWithinPartitions("block", "n", "node")
    return ordered.mapInArrow(run, "block long, node long, n long, hub long, hub_n long")


def wanted_words(doc_ids: DataFrame) -> DataFrame:
    """(word, bits): the bits of the documents to fetch, merged by executors; at most 2**(FILTER_BITS - 6) rows."""
    mask = (1 << FILTER_BITS) - 1
    places = F.array(*(F.shiftrightunsigned(F.xxhash64("doc_id"), shift).bitwiseAND(mask) for shift in FILTER_SHIFTS))
    words = doc_ids.select(F.explode(places).alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
    return words.agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits"))


def wanted_filter(doc_ids: DataFrame) -> np.ndarray:
    """Bits of the documents to fetch, as 64-bit words."""
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in wanted_words(doc_ids).collect():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def fetched(docs: DataFrame, holders: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, members) of `nodes`, each from the document that `holders` (node, doc_id) names.

    A filter of fixed size keeps other texts from being read; what passes it by chance is more than asked, not wrong.
    """
    sent = docs.sparkSession.sparkContext.broadcast(wanted_filter(holders.join(nodes, "node").select("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = sent.value, set()
        for batch in slices(batches, 1):
            names = batch.column(2).to_numpy().view(np.uint64)
            wanted = np.ones(len(names), bool)
            for shift in FILTER_SHIFTS:
                place = (names >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
                wanted &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            out = []
            for text in batch.column(1).filter(pa.array(wanted)).cast(pa.binary()).to_pylist():
                found = shingle_set(text)
                node = node_of(found) if len(found) else None
                if node is not None and node not in seen:
                    seen.add(node)
                    out.append((node, found.tobytes()))
            columns = list(zip(*out)) or [(), ()]
            yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], ["node", "members"])

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", "text", F.xxhash64("doc_id").alias("name"))
    found = rows.mapInArrow(run, "node long, members binary")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def agreeing(pairs: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose sets have a similarity of 0.75 or more, from members_a and members_b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * both >= 75 * (len(one) + len(two) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "members_a", "members_b").mapInArrow(run, "a long, b long")


def plausible(pairs: DataFrame) -> DataFrame:
    """Pairs whose sketches differ in no more bits than a seventh of both sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = distances(*(batch.column(k).to_pylist() for k in (4, 5)))
                most = (batch.column(2).to_numpy() + batch.column(3).to_numpy()) // 7
                yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(apart <= most))

    return pairs.select("a", "b", "n_a", "n_b", "short_a", "short_b").mapInArrow(run, "a long, b long")


def with_sets(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with columns of both sets, named by side."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs


class Forest:
    """What the rows of a block are connected to, by their components, if all pairs found so far are links."""

    def __init__(self):
        self.ids: dict[tuple[int, int], int] = {}
        self.parent = np.zeros(0, np.int64)

    def places(self, blocks: np.ndarray, components: np.ndarray) -> np.ndarray:
        """A number for each pair of block and component; those of other blocks than the first one are new."""
        keys = list(zip(blocks.tolist(), components.tolist()))
        self.ids = {k: v for k, v in self.ids.items() if k[0] == keys[0][0]}
        first = len(self.parent)
        out = [self.ids.setdefault(k, first + n) for n, k in enumerate(keys)]
        self.parent = np.concatenate([self.parent, np.arange(first, first + len(keys))])
        return np.array(out, np.int64)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while not np.array_equal(further := self.parent[up], up):
            up = further
        self.parent[at] = up
        return up

    def join(self, one: int, two: int) -> bool:
        """Connects two numbers; False if they are connected already."""
        ends = []
        for k in (one, two):
            while self.parent[k] != k:
                k = int(self.parent[k])
            ends.append(k)
        self.parent[ends[1]] = ends[0]
        return ends[0] != ends[1]


def further_pairs(open_rows: DataFrame, low: int, high: int, forest: bool) -> DataFrame:
    """(block, a, b): in each group, nodes of other components that stand low + 1 to high places apart in the order of size.

    Only pairs whose sketches could belong to a link are written: all are folded to the least width and compared first.
    With `forest` no pair is written that earlier pairs of the group connect, so a group has fewer pairs than nodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_short, held_whole = np.zeros((0, 5), np.int64), np.zeros((0, SHORT_BYTES // 8), np.uint64), []
        connected = Forest()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            added = [batch.column(k).to_numpy() for k in range(4)]
            rows = np.concatenate([held, np.column_stack([*added, connected.places(added[0], added[3])])])
            packed = batch.column(4).to_pylist()
            whole = held_whole + packed
            short = np.concatenate([held_short, *(folded([w], SHORT_BYTES) for w in packed)])
            for lag in range(low + 1, high + 1):
                new = max(lag, len(held))
                x, y = rows[new - lag : len(rows) - lag], rows[new:]
                if not len(y) or not (x[:, 0] == y[:, 0]).any():
                    break
                apart = connected.roots(rows[:, 4]) if forest else rows[:, 3]
                good = np.flatnonzero((x[:, 0] == y[:, 0]) & (apart[new - lag : len(rows) - lag] != apart[new:]) & (4 * x[:, 2] >= 3 * y[:, 2]))
                most = (x[good, 2] + y[good, 2]) // 7
                keep = np.bitwise_count(short[good + new - lag] ^ short[good + new]).sum(1) <= most
                good, most = good[keep], most[keep]
                wide = [(whole[k + new - lag], whole[k + new]) for k in good.tolist()]
                if wide and max(len(b) for _, b in wide) > SHORT_BYTES:
                    good = good[distances(*map(list, zip(*wide))) <= most]
                if forest:
                    good = good[[connected.join(a, b) for a, b in zip(x[good, 4].tolist(), y[good, 4].tolist())]]
                if len(good):
                    found = np.sort(np.column_stack([x[good, 1], y[good, 1]]), 1)
                    yield pa.record_batch([pa.array(x[good, 0]), pa.array(found[:, 0]), pa.array(found[:, 1])], ["block", "a", "b"])
            # What later rows of the last group can still meet.
            first = max(len(rows) - high, int(np.searchsorted(rows[:, 0], rows[-1, 0])))
            held, held_short, held_whole = rows[first:], short[first:], whole[first:]

    ordered = open_rows.repartition("block").sortWithinPartitions("block", "n", "node")
    return ordered.select("block", "node", "n", "component", "short").mapInArrow(run, "block long, a long, b long")


def unlike_groups(groups: DataFrame) -> DataFrame:
    """(block, node, n) of the groups, hubs aside: of groups of the same nodes (by two sums of hashes) one stays."""
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"mark{seed}") for seed in range(2)]
    each = groups.groupBy("block").agg(F.count("*").alias("size"), *marks).where("size > 1")
    kept = each.groupBy("size", "mark0", "mark1").agg(F.min("block").alias("block")).select("block")
    return groups.join(kept, "block", "left_semi").select("block", "node", "n")


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, component) after links (a, b) between components, or nodes that have no label yet."""
    merged = components(links)
    named = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = labels.join(named, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    joined = materialize(old.union(merged.join(labels, "node", "left_anti").select("node", "component")), "labels")
    release(merged, labels)
    return joined


def labelled(rows: DataFrame, labels: DataFrame, column: str, output: str) -> DataFrame:
    """`rows` with the component of the node in `column`, the node itself where it has none."""
    named = labels.select(F.col("node").alias(column), F.col("component").alias("_component"))
    return rows.join(named, column, "left").withColumn(output, F.coalesce("_component", column)).drop("_component")


def node_labels(docs: DataFrame, scanned: DataFrame, levels: np.ndarray) -> DataFrame:
    """(node, component) of all nodes that have a link."""
    groups = materialize(shared_blocks(chosen_blocks(docs, levels)), "shared-blocks")
    holders = materialize(scanned.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "holders")
    used = groups.select("node").union(groups.select("hub")).distinct()
    sketches = scanned.where("short IS NOT NULL").select("node", "n", "short", "wide").join(used, "node", "left_semi")
    sketches = materialize(sketches.dropDuplicates(["node"]), "sketches")

    def checked(near: DataFrame) -> DataFrame:
        """The links among plausible pairs; whole sets are fetched for these only."""
        both = near.select("a").union(near.select("b")).distinct().withColumnRenamed("a", "node")
        sets = materialize(fetched(docs, holders, both), "shingle-sets")
        links = materialize(agreeing(with_sets(near, sets, "members")), "links")
        release(sets, near)
        return links

    pairs = groups.where("4 * hub_n >= 3 * n").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    near = materialize(plausible(with_sets(pairs, sketches, "n", "short")), "near-pairs")
    links = checked(near)
    labels = components(links)
    release(links)
    # From here on only groups of unlike nodes: each pair of a group was compared if any group of the same nodes was.
    unlike = materialize(unlike_groups(groups), "unlike-groups")
    release(groups)
    low, high = 0, LAG

    def open_groups(some: DataFrame) -> DataFrame:
        """(block, node, n, component) of groups that hold several components and have pairs more than `low` places apart."""
        marked = labelled(some.select("block", "node", "n"), labels, "node", "component")
        spread = marked.groupBy("block").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        spread = spread.where((F.col("low") != F.col("high")) & (F.col("size") > low + 1)).select("block")
        return materialize(marked.join(spread, "block", "left_semi"), "open-groups")

    def with_sketches(some: DataFrame, sketch: str) -> DataFrame:
        named = sketches.select("node", F.col(sketch).alias("short"))
        return some.join(named, "node").select("block", "node", "n", "component", "short")

    def tried(near: DataFrame) -> DataFrame:
        """The links among pairs; they join the labels of their ends."""
        nonlocal labels
        links = checked(materialize(near.select("a", "b").distinct(), "tried-pairs"))
        more = labelled(labelled(links, labels, "a", "to_a"), labels, "b", "to_b")
        more = materialize(more.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")), "links")
        if not more.isEmpty():
            labels = joined_labels(labels, more)
        release(more)
        return links

    while True:
        left = open_groups(unlike)
        release(unlike)
        unlike = left
        if unlike.isEmpty():
            release(unlike, holders, sketches)
            return labels
        # First as few pairs as connect what may be linked. Where one of them is no link, all pairs between components.
        near = materialize(further_pairs(with_sketches(unlike, "short"), low, high, True), "near-pairs")
        links = tried(near)
        disputed = materialize(near.join(links, ["a", "b"], "left_anti").select("block").distinct(), "disputed")
        release(links, near)
        if not disputed.isEmpty():
            again = open_groups(unlike.join(disputed, "block", "left_semi"))
            release(tried(further_pairs(with_sketches(again, "wide"), low, high, False)), again)
        release(disputed)
        low, high = high, FURTHER * high


def component_table(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    scanned = materialize(first_scan(docs), "shingle-scan")
    nodes = scanned.where("chunk IS NULL").select("doc_id", "node", "n")
    labels = node_labels(docs, scanned, block_levels(scanned))
    # An id with several sets ties them together.
    several = nodes.where("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    ties = nodes.join(several, "doc_id").where("node <> low").select("low", "node")
    ties = labelled(labelled(ties, labels, "low", "a"), labels, "node", "b").select("a", "b")
    if not several.isEmpty():
        labels = joined_labels(labels, ties)
    named = labelled(nodes, labels, "node", "component")
    smallest = materialize(named.where("node IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest")), "smallest")
    return named.join(smallest, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"))


def shingle_components(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles (set size), component_id (smallest id reachable by links, itself included)."""
    return component_table(docs.select("doc_id", "text"))


def keep_smallest(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component, and rows of null id; repeated rows of it once each."""
    table = component_table(docs.select("doc_id", "text")).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(table, docs["doc_id"].cast("long") == table["_gone"], "left_anti")
