"""Every query with a SQL twin gives the same rows as DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from sparring.plans.queries import TABLES

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return value + 0.0 if isinstance(value, float) and not math.isnan(value) else value

    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    ours = entry_points.queries()[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    expected = comparable([c[0] for c in cursor.description], cursor.fetchall())
    assert comparable(ours.columns, [tuple(r) for r in ours.collect()]) == expected


def test_flagship_returns_a_leaderboard(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["model"] for r in rows] == ["Linear Regression"]
    assert rows[0]["rmse"] == pytest.approx(math.sqrt(rows[0]["mse"]))
