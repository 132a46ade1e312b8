"""Row identity that does not depend on file order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparring.functions.columns import col

ROW_KEY = "row_key"

# The row key of a row whose only key column is NULL.
NULL_KEY = "\x00null"

# A row with up to this many copies is expanded where it was counted; others in blocks, spread over all tasks.
COPIES_IN_PLACE = 8
COPIES_PER_BLOCK = 1_000


def seeded_hash(key: Column, seed: object) -> Column:
    """The pseudo-random order used by every random choice; any engine with md5 can replay it."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def value_hash(value: Column) -> Column:
    """128 bits that stand for a value's text in joins and groups; NULL stays NULL."""
    return F.unhex(F.md5(value.cast("string").cast("binary")))


def content_text(columns: Sequence[str]) -> Column:
    """All column values as one text; lengths keep neighbouring values from running together."""
    parts = []
    for name in columns:
        text = col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("~")))
    return F.concat_ws("|", *parts)


def with_row_key(
    df: DataFrame, key_cols: Sequence[str] | None = None, in_place: int = COPIES_IN_PLACE,
    per_block: int = COPIES_PER_BLOCK,
) -> DataFrame:
    """Add `row_key`. Given key columns name the rows, NULL as `NULL_KEY`; otherwise the content decides.

    Without keys, equal rows are counted (a partial aggregate absorbs any number of copies) and
    the counts are expanded again, numbering the copies 0, 1, 2, ...: copies are
    interchangeable, so no row has to be ranked. Counts of many copies are small tables that expand a lot, so their
    blocks are first spread by content and block over a fixed number of tasks.
    """
    if key_cols:
        one = F.coalesce(col(key_cols[0]).cast("string"), F.lit(NULL_KEY))
        text = one if len(key_cols) == 1 else content_text(key_cols)
        return df.withColumn(ROW_KEY, text)

    names = df.columns
    columns = [col(c) for c in names]
    n_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*columns).agg(F.expr("count(1) AS __copies"))
    few = counted.where(F.col("__copies") <= in_place).select(
        *columns, F.expr("explode(sequence(0L, __copies - 1)) AS __copy")
    )
    many = (
        counted.where(F.col("__copies") > in_place)
        .withColumn("__block", F.expr(f"explode(sequence(0L, (__copies - 1) div {per_block}))"))
        .repartition(n_tasks, *columns, F.col("__block"))
        .select(
            *columns,
            F.expr(
                f"explode(sequence(__block * {per_block}, least((__block + 1) * {per_block}, __copies) - 1)) AS __copy"
            ),
        )
    )
    key = F.md5(F.concat_ws("#", content_text(names), F.col("__copy").cast("string")))
    return few.union(many).select(*columns, key.alias(ROW_KEY))
