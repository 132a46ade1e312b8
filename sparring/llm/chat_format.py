"""Chat formatting of maximal conversations.

Logs hold cumulative snapshots: a conversation that was logged again, longer. A rolling hash over the turns gives each
prefix of a conversation a hash; a conversation whose whole hash is a proper prefix of another is anti-joined away, and
of equal conversations the smallest id stays. What remains is rendered turn by turn.

The rolling hash is a sum of hashes of turn and place, in three lanes of 42 bits, so prefixes of a long conversation
are summed in blocks of BLOCK turns by many tasks. Turns are in the order of turn, role, text, nulls first; repeated
rows are turns of their own. Null roles render as `user`, null texts as empty text; for comparison a null differs from
an empty text. Rows without a conv_id belong to no conversation and are left out. Other columns are ignored. An empty
table gives an empty result. Conversations come out in parts of PART turns, so that no row grows with a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns in a block of the prefix sums, and in a rendered part.
BLOCK, PART = 1024, 256


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, block, role, text) with places from 0.

    A conversation's distinct turn numbers are counted in ranges of BLOCK, so that a long one is ordered by many tasks.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text")
    rows = rows.withColumn("_range", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))))
    sizes = rows.groupBy("conv_id", "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    inside = F.row_number().over(Window.partitionBy("conv_id", "_range").orderBy(*order)) - 1
    ranked = rows.withColumn("_inside", inside)
    return ranked.join(starts, ["conv_id", "_range"]).select(
        "conv_id", (F.col("_start") + F.col("_inside")).alias("place"), "_range", "role", "text"
    )


def lane(seed: int) -> Column:
    """A turn's share of a prefix hash: its hash and its place hashed together, small enough to sum without overflow."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text"), 22)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, length, a, b, last): the hash of every prefix of every conversation, `last` for the whole."""
    shares = turns.select("conv_id", "_range", "place", lane(11).alias("x"), lane(12).alias("y"), lane(13).alias("z"))
    names = ("x", "y", "z")
    blocks = shares.groupBy("conv_id", "_range").agg(*(F.sum(c).alias(f"_{c}") for c in names), F.max("place").alias("_end"))
    earlier = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    blocks = blocks.select(
        "conv_id", "_range", *(F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in names), F.max("_end").over(whole).alias("_end")
    )
    so_far = Window.partitionBy("conv_id", "_range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = shares.select("conv_id", "_range", "place", *(F.sum(c).over(so_far).alias(c) for c in names))
    return summed.join(blocks, ["conv_id", "_range"]).select(
        "conv_id",
        (F.col("place") + 1).alias("length"),
        *((F.col(c) + F.col(f"_{c}")).alias(c) for c in names),
        (F.col("place") == F.col("_end")).alias("last"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no proper prefix of another; of equal ones the smallest id."""
    hashes = prefix_hashes(turns)
    key = ["length", "x", "y", "z"]
    whole = hashes.where("last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    prefixes = hashes.where(~F.col("last")).select(*key).distinct()
    return whole.join(prefixes, key, "left_anti").select("conv_id", F.col("length").alias("n_turns"))


def render(turns: DataFrame, kept: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, n_turns, part, text): each kept conversation, rendered in parts of `part` turns."""
    one = F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    rows = turns.join(kept, "conv_id").select("conv_id", "n_turns", F.floor(F.col("place") / part).alias("part"), F.struct("place", one.alias("one")).alias("turn"))
    parts = rows.groupBy("conv_id", "n_turns", "part").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return parts.select("conv_id", "n_turns", "part", F.array_join("turns.one", "").alias("text"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """The maximal conversations of a log, rendered: (conv_id, n_turns, part, text)."""
    turns = numbered_turns(conversations)
    return render(turns, maximal_conversations(turns))
