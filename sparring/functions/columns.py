"""Column kinds, projections and coercions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Aggregates per scan in `per_column`: above about 60 the generated method is too long for the JIT
# compiler and a scan gets several times slower.
AGGREGATES_PER_SCAN = 40


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Strings and booleans; every other non-numeric type is ignored as a feature."""
    skip = set(exclude)
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in skip]


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features (everything but the target) and the target as its own one-column frame."""
    require_column(df, target)
    return df.drop(target), df.select(col(target))


def require_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"target column {name!r} not found; columns are {df.columns}")


def clean_missing(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes NULL. Decimals become doubles."""

    def cleaned(field: T.StructField) -> Column:
        c = col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.nanvl(c, F.lit(None).cast(field.dataType)).alias(field.name)
        return c

    return df.select(*[cleaned(f) for f in df.schema])


def to_number(df: DataFrame, name: str) -> Column:
    """The column as a double; text that is not a plain number becomes NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.nanvl(col(name).cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, T.BooleanType):
        return col(name).cast("double")
    if isinstance(kind, T.StringType):
        return F.when(col(name).rlike(NUMBER_PATTERN), F.trim(col(name)).try_cast("double"))
    return F.lit(None).cast("double")


def chunks(items: Sequence[str], size: int) -> Iterator[Sequence[str]]:
    for start in range(0, len(items), size):
        yield items[start : start + size]


def sql_name(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def per_column(
    df: DataFrame, columns: Sequence[str], stats: dict[str, str], by: Sequence[str] = (),
    per_scan: int = AGGREGATES_PER_SCAN,
) -> DataFrame:
    """Aggregates of many columns as a long frame `by..., n_rows, col, <stats>`.

    `stats` maps a name to SQL text in which `{c}` stands for the column. Each chunk of
    columns is one wide aggregation over a scan of just those columns: partial
    aggregates leave one row per task and group, so nothing but those rows is shuffled,
    however the group sizes are skewed.
    """
    frames = []
    for chunk in chunks(columns, max(1, per_scan // len(stats))):
        aggregates = [
            F.expr(f"{text.format(c=sql_name(name))} AS s{i}_{stat}")
            for i, name in enumerate(chunk)
            for stat, text in stats.items()
        ]
        wide = df.groupBy(*[col(b) for b in by]).agg(F.expr("count(1) AS n_rows"), *aggregates)
        entries = ", ".join(
            f"struct({sql_text(name)} AS col, " + ", ".join(f"s{i}_{stat} AS {stat}" for stat in stats) + ")"
            for i, name in enumerate(chunk)
        )
        frames.append(wide.selectExpr(*[sql_name(b) for b in by], "n_rows", f"inline(array({entries}))"))
    return reduce(DataFrame.union, frames)
