"""Input tables: CSV with inferred types, Parquet, catalog tables, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparring.functions.columns import NUMBER_PATTERN, clean_missing, col, per_column, sql_name, sql_text
from sparring.sources.csv_records import read_text_columns

# Texts that count as missing in a CSV file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

Condition = tuple[str, str, object]
COMPARISONS = {
    "=": lambda c, v: c == v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
}

INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
BOOLEAN_PATTERN = r"^(True|False|TRUE|FALSE|true|false)$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def read_csv_table(
    spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS, **options
) -> DataFrame:
    """A CSV file or folder with a header; types are inferred from all values.

    Columns become long, double, boolean or string. Dates stay text. Integers with missing
    values become doubles, and booleans with missing values stay text. One aggregation over the
    text columns decides all types. Line breaks inside quotes belong to the text; large files are cut
    up all the same, see `csv_records`.
    """
    raw = read_text_columns(spark, path, **options)
    if not raw.columns:
        return raw
    tokens = ", ".join(sql_text(t) for t in na_tokens)
    text = raw.selectExpr(*[f"CASE WHEN {n} NOT IN ({tokens}) THEN {n} END AS {n}" for n in map(sql_name, raw.columns)])
    integer, number, infinity, boolean = (
        sql_text(p) for p in (INTEGER_PATTERN, NUMBER_PATTERN, INFINITY_PATTERN, BOOLEAN_PATTERN)
    )
    stats = per_column(
        text,
        text.columns,
        {
            "n_values": "count({c})",
            "integers": f"count_if({{c}} RLIKE {integer} AND try_cast(trim({{c}}) AS BIGINT) IS NOT NULL)",
            "numbers": f"count_if({{c}} RLIKE {number} OR {{c}} RLIKE {infinity})",
            "booleans": f"count_if({{c}} RLIKE {boolean})",
        },
    ).collect()
    kinds = {r["col"]: _kind(r) for r in stats}
    return text.select(
        *[(col(c) if kinds[c] == "string" else F.trim(col(c)).try_cast(kinds[c])).alias(c) for c in text.columns]
    )


def _kind(stat) -> str:
    n, complete = stat["n_values"], stat["n_values"] == stat["n_rows"]
    if n == stat["numbers"]:
        return "bigint" if complete and n and n == stat["integers"] else "double"
    return "boolean" if complete and n == stat["booleans"] else "string"


def read_parquet_table(spark: SparkSession, path: str, where: Sequence[Condition] = ()) -> DataFrame:
    """A Parquet table with one notion of missing, and only the rows that meet all conditions (see `where_all`)."""
    return where_all(spark.read.parquet(path), where)


def read_catalog_table(spark: SparkSession, name: str, where: Sequence[Condition] = ()) -> DataFrame:
    return where_all(spark.table(name), where)


def where_all(raw: DataFrame, where: Sequence[Condition]) -> DataFrame:
    """`raw` with NaN as NULL, and the rows for which each (column, operator, value) holds.

    Operators are =, <, <=, >, >= and `in`; missing values meet none. A comparison of a cleaned column could not reach the
    file reader, so it is also made on the raw one, where it keeps the same rows and, for > and >=, those of NaN, which
    go afterwards: `x > 10` becomes x > 10 in the reader and x > 10 AND NOT isnan(x) above it. Decimals, which are
    cleaned to doubles, are compared afterwards only.
    """
    unknown = [w for w in where if w[1] not in COMPARISONS]
    if unknown:
        raise ValueError(f"unknown conditions {unknown}; operators are {sorted(COMPARISONS)}")
    kinds = {f.name: f.dataType for f in raw.schema}
    for name, operator, value in where:
        if not isinstance(kinds[name], T.DecimalType):
            raw = raw.where(COMPARISONS[operator](col(name), value))
    table = clean_missing(raw)
    for name, operator, value in where:
        if isinstance(kinds[name], (T.DecimalType, T.DoubleType, T.FloatType)):
            table = table.where(COMPARISONS[operator](col(name), value))
    return table


def preview(df: DataFrame, rows: int = 50, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows, in the table's order or that of some columns, for looking at a table before choosing a target."""
    return (df.orderBy(*map(col, order_by)) if order_by else df).limit(rows)


def single_column(df: DataFrame, name: str) -> DataFrame:
    """One column; the file source then reads only that one."""
    return df.select(col(name))
