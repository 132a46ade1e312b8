"""The corpus queries that SQL can express give DuckDB's rows on the smallest tables."""

import duckdb
import pytest

from sparring.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    ours = QUERIES[name](spark, FOLDER)
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(*columns).collect())) == sorted(cursor.fetchall())
