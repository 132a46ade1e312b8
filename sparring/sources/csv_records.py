"""CSV records whose quoted fields may hold line breaks, found by many tasks in one file.

A file is read as physical lines by as many tasks as Spark cuts it into. What a line does to the state "inside a quoted
field" is a function of two states (before the line: outside, at the start of a record, or inside), and so is what a
split of the file does: keep the state, set it, or turn it round. A prefix scan over the splits of each file composes
these functions and tells in which state each split begins; records are then cut in each split by itself, and only the
pieces of records that cross the border of a split are put together elsewhere, one small group for each such record.

A quote opens a field only at the start of the field; elsewhere it is an ordinary character. A doubled quote inside a
quoted field is one quote. Lines end with \\n or \\r\\n; what stands inside quotes is kept as it is. Blank lines between
records are left out, the first record of each file is its header.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparring.session import materialize, release

#: Kinds of pieces that a split gives: a whole record, a header, and parts of a record that crosses borders (the beginning
#: of a header, or of another record, what goes on from border to border, the end). Of one split the later kinds come first.
RECORD, HEADER, FIRST, BEGINNING, CONTINUATION, ENDING = range(6)
BLANK = "".join(map(chr, range(33)))


def ends_inside(line: str, inside: bool, sep: str, quote: str) -> bool:
    """Whether a line that begins outside (at the start of a record) or inside a quoted field ends inside one."""
    at = 0
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):
                at += 2
                continue
        elif line.startswith(quote, at):
            inside, at = True, at + 1
            continue
        # The rest of the field, where quotes are ordinary.
        at = line.find(sep, at)
        if at < 0:
            return False
        inside, at = False, at + len(sep)


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, split, line): lines in the order of each split; `split` is a hash of file and block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    where = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    return where.select("file", "block", F.xxhash64("file", "block").alias("split"), "line")


def split_effects(lines: DataFrame, sep: str, quote: str) -> DataFrame:
    """(file, block, split, from_outside, from_inside, opened): the state after each split, by the state before it.

    `opened` says that some line may end inside a quoted field. Lines without a quote change no state and are not sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, states, opened = None, [False, True], False
        names = ["file", "block", "split", "from_outside", "from_inside", "opened"]
        for batch in batches:
            for file, block, split, line in zip(*(c.to_pylist() for c in batch.columns)):
                if last is None or last[2] != split:
                    if last is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*last, *states, opened)], names)
                    last, states, opened = (file, block, split), [False, True], False
                after = ends_inside(line, False, sep, quote), ends_inside(line, True, sep, quote)
                states = [after[s] for s in states]
                opened |= after[0]
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*last, *states, opened)], names)

    quoted = lines.where(F.contains("line", F.lit(quote)))
    return quoted.mapInArrow(run, "file string, block long, split long, from_outside boolean, from_inside boolean, opened boolean")


def states_before(effects: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, block, split, inside): the state in which each split of `blocks` begins; a file begins outside."""
    every = blocks.join(effects.drop("opened"), ["file", "block", "split"], "left")
    keeps = F.col("from_outside").isNull() | (~F.col("from_outside") & F.col("from_inside"))
    turns = F.coalesce(F.col("from_outside") & ~F.col("from_inside"), F.lit(False))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block")
    # The last split that sets the state decides, and how many after it turn it round.
    marked = every.withColumn("turned", F.sum(turns.cast("int")).over(upto))
    marked = marked.withColumn("reset", F.when(~keeps & ~turns, F.struct(F.col("from_outside").cast("int").alias("state"), "turned")))
    last = F.last("reset", ignorenulls=True).over(before)
    state = F.coalesce(last["state"], F.lit(0)) + F.coalesce(F.lag("turned").over(upto), F.lit(0)) - F.coalesce(last["turned"], F.lit(0))
    return marked.select("file", "block", "split", (F.pmod(state, F.lit(2)) == 1).alias("inside"))


def pieces(lines: DataFrame, inside: np.ndarray, sep: str, quote: str) -> DataFrame:
    """(file, block, kind, text): the records of each split, and the parts of records that cross its borders.

    `inside` names the splits that begin inside a quoted field: eight bytes a split, that is 6 MB for 100 TB in splits
    of 128 MB.
    """
    spark = lines.sparkSession
    sent = spark.sparkContext.broadcast(np.sort(inside))
    names = ["file", "block", "kind", "text"]

    def unfinished(crossed: bool, first: bool) -> int:
        return CONTINUATION if crossed else FIRST if first else BEGINNING

    def starts_inside(split: int) -> bool:
        at = int(np.searchsorted(sent.value, split))
        return at < len(sent.value) and int(sent.value[at]) == split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, crossed, first, held = None, False, False, False, []
        for batch in batches:
            out: list[tuple] = []
            for file, block, split, line in zip(*(c.to_pylist() for c in batch.columns)):
                if last is None or last[2] != split:
                    if held:
                        out.append((*last[:2], unfinished(crossed, first), "\n".join(held)))
                    last, state, held = (file, block, split), starts_inside(split), []
                    crossed, first = state, block == 0
                held.append(line)
                state = ends_inside(line, state, sep, quote) if quote in line else state
                if not state:
                    text = "\n".join(held).removesuffix("\r")
                    if crossed:
                        out.append((file, block, ENDING, text))
                    elif text.strip(BLANK):
                        out.append((file, block, HEADER if first else RECORD, text))
                        first = False
                    held, crossed = [], False
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, PIECE_TYPES)], names)
        if held:
            row = (*last[:2], unfinished(crossed, first), "\n".join(held))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, PIECE_TYPES)], names)

    return lines.mapInArrow(run, "file string, block long, kind int, text string")


PIECE_TYPES = (pa.string(), pa.int64(), pa.int32(), pa.string())


def crossing_records(parts: DataFrame) -> DataFrame:
    """(file, block, kind, text) of the records made of pieces that cross borders; `block` is where a record begins.

    A file that ends inside a quoted field ends its last record there.
    """
    upto = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    began = F.last(F.when(F.col("kind") <= BEGINNING, F.col("block")), ignorenulls=True).over(upto)
    # All of one record: as large as the record.
    joined = parts.withColumn("began", began).groupBy("file", "began").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"), F.min("kind").alias("least")
    )
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["text"]), "\n"), r"\r\z", "")
    kind = F.when(F.col("least") == FIRST, HEADER).otherwise(RECORD)
    return joined.select("file", F.col("began").alias("block"), kind.alias("kind"), text.alias("text"))


def column_names(header: str, sep: str, quote: str) -> list[str]:
    """The names of a header; empty ones are `_c` and their place, repeated ones get their place behind."""
    names = next(csv.reader([header], delimiter=sep, quotechar=quote), [])
    low = [n.lower() for n in names]
    return [f"_c{k}" if not n else f"{n}{k}" if low.count(n.lower()) > 1 else n for k, n in enumerate(names)]


def read_text_columns(spark: SparkSession, path: str, sep: str = ",", quote: str = '"', **options) -> DataFrame:
    """The columns of CSV files as text, named by the header of the first file; every file's first record is dropped."""
    settings = {**options, "sep": sep, "quote": quote, "escape": quote}
    lines = physical_lines(spark, path)
    effects = materialize(split_effects(lines, sep, quote), "csv-effects")
    if effects.where("opened").isEmpty():
        # No field holds a line break: Spark's own reader finds the same records.
        release(effects)
        return spark.read.csv(path, header=True, inferSchema=False, **settings)
    blocks = lines.select("file", "block", "split").distinct()
    before = states_before(effects, blocks).where("inside").select("split")
    inside = np.fromiter((r["split"] for r in before.toLocalIterator()), np.int64)
    # Written once, so that what is cut does not depend on how later readers cut the files.
    found = materialize(pieces(lines, inside, sep, quote), "csv-pieces")
    whole = found.where(F.col("kind") < FIRST).unionByName(crossing_records(found.where(F.col("kind") >= FIRST)))
    header = whole.where(F.col("kind") == HEADER).orderBy("file").select("text").first()["text"]
    names = column_names(header, sep, quote)
    places = [f"c{k}" for k in range(len(names))]
    parsed = F.from_csv("text", ", ".join(f"{p} string" for p in places), {**settings, "mode": "PERMISSIVE"})
    fields = whole.where(F.col("kind") == RECORD).select(parsed.alias("r"))
    columns = materialize(fields.select(*(F.col(f"r.{p}") for p in places)), "csv-columns")
    release(effects, found)
    return columns.toDF(*names)
