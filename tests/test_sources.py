import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparring.functions.columns import to_number
from sparring.sources import csv_records
from sparring.sources.exports import save_ensemble, saved_size
from sparring.sources.tables import preview, read_csv_table, read_parquet_table

CSV = '''id,share,flag,gap,word,day,huge,gap flag,"a.b",empty
1,.5,True,3,x,2024-01-01,99999999999999999999,True,inf,
2,1e3,False,NA,"says ""hi"", twice",2024-01-02,1,NA,1.5,
3,-2,True,5,null,2024-01-03,2,False,-inf,
'''


def test_csv_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(CSV)
    frame = read_csv_table(spark, str(path))
    assert dict(frame.dtypes) == {
        "id": "bigint", "share": "double", "flag": "boolean", "gap": "double", "word": "string", "day": "string",
        "huge": "double", "gap flag": "string", "a.b": "double", "empty": "double",
    }
    rows = frame.orderBy("id").collect()
    assert [r["share"] for r in rows] == [0.5, 1000.0, -2.0]
    assert [r["gap"] for r in rows] == [3.0, None, 5.0]
    assert [r["word"] for r in rows] == ["x", 'says "hi", twice', None]
    assert rows[0]["a.b"] == float("inf")


def test_numbers_from_text(spark):
    texts = ["1", " 2.5 ", "-1e3", ".5", "7.", "1d", "2f", "0x10", "x", "", None, "NaN", "1-URGENT"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in frame.orderBy("i").select(to_number(frame, "t")).collect()]
    assert found == [1.0, 2.5, -1000.0, 0.5, 7.0] + [None] * 8


def test_preview_and_sizes(spark, tmp_path):
    assert preview(spark.range(80)).count() == 50
    path = str(tmp_path / "d")
    save_ensemble(spark, {"name": "é", "odd": F}, path)
    assert saved_size(spark, path) >= 20


def quoted_rows(seed, n):
    """Rows of fields with breaks, quotes, separators, stray quotes and nothing, and the text of the file."""
    rng = random.Random(seed)
    pieces = ["x", '"', ",", "\n", "\r\n", "é", " ", "\n\n", '""', "word " * 9]
    rows, lines = [], ["a,b,\"c\nd\""]
    for k in range(n):
        row, fields = [str(k)], [str(k)]
        for _ in range(2):
            if rng.random() < 0.3:
                plain = rng.choice(["plain", 'a "quoted" word', '5" pipe', "y"])
                row.append(plain)
                fields.append(plain)
            else:
                text = "q" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) + "q"
                row.append(text)
                fields.append('"' + text.replace('"', '""') + '"')
        rows.append(tuple(row))
        lines.append(",".join(fields) + ("\n" if rng.random() < 0.1 else ""))
    return rows, "\n".join(lines) + "\n"


@pytest.mark.parametrize("split_bytes", [97, 301, 1 << 20])
def test_one_file_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path, split_bytes):
    rows, text = quoted_rows(split_bytes, 150)
    (tmp_path / "one.csv").write_bytes(text.encode())
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, split_bytes)
    try:
        lines = csv_records.physical_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() >= min(100, len(text) // split_bytes)
        frame = csv_records.read_text_columns(spark, str(tmp_path))
    finally:
        spark.conf.unset(name)
    assert frame.columns == ["a", "b", "c\nd"]
    found = sorted((int(r[0]), r[1], r[2]) for r in frame.collect())
    assert found == sorted((int(r[0]), r[1], r[2]) for r in rows)


def test_files_of_a_folder_with_and_without_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\r\n1,"one\r\ntwo"\r\n\r\n2,x\r\n')
    (tmp_path / "b.csv").write_text('n,t\n3,"open\nto the end')
    (tmp_path / "c.csv").write_text("n,t\n")
    found = sorted((r["n"], r["t"]) for r in read_csv_table(spark, str(tmp_path)).collect())
    assert found == [(1, "one\r\ntwo"), (2, "x"), (3, "open\nto the end")]
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "d.csv").write_text('n;t\n1;"a ""b"" c"\n2;5" pipe\n')
    found = sorted((r["n"], r["t"]) for r in read_csv_table(spark, str(plain), sep=";").collect())
    assert found == [(1, 'a "b" c'), (2, '5" pipe')]


def test_states_compose_over_splits(spark):
    """Splits that keep, set and turn round the state, against a walk over each file."""
    rng = random.Random(4)
    effects, expected = [], []
    for file in ("f", "g"):
        state = False
        for block in range(60):
            expected.append((file, block, state))
            kind = rng.choice([(False, True), (False, True), (True, False), (True, False), (False, False), (True, True)])
            if kind != (False, True) or rng.random() < 0.5:
                effects.append((file, block, hash((file, block)), *kind, True))
            state = kind[state]
    blocks = spark.createDataFrame([(f, b, hash((f, b))) for f, b, _ in expected], "file string, block long, split long")
    frame = spark.createDataFrame(effects, "file string, block long, split long, from_outside boolean, from_inside boolean, opened boolean")
    found = csv_records.states_before(frame, blocks).select("file", "block", "inside").collect()
    assert sorted(map(tuple, found)) == expected


def test_names_of_columns():
    assert csv_records.column_names('a,"b, ""c""",,A', ",", '"') == ["a0", 'b, "c"', "_c2", "A3"]


def test_conditions_reach_the_reader_and_leave_nan_out(spark, tmp_path):
    path, nan = str(tmp_path / "t"), float("nan")
    rows = [(1, 5.0, 1.5, "a", Decimal("1.10")), (2, 20.0, nan, "b", Decimal("2.20")), (3, nan, 2.5, "a", None), (4, None, None, None, Decimal("3.30"))]
    spark.createDataFrame(rows, "k long, x double, y float, s string, d decimal(10,2)").write.parquet(path)

    def keys(*where):
        return sorted(r["k"] for r in read_parquet_table(spark, path, where).collect())

    assert keys(("x", ">", 10)) == [2] and keys(("x", ">=", 5.0), ("s", "=", "a")) == [1]
    assert keys(("y", "<", 2)) == [1] and keys(("y", ">=", 2.0)) == [3] and keys(("d", ">", 1.2)) == [2, 4]
    assert keys(("x", "in", [5.0, 20.0])) == [1, 2] and keys(("x", "=", nan)) == [] and keys() == [1, 2, 3, 4]
    plan = read_parquet_table(spark, path, [("x", ">", 10), ("s", "in", ["a", "b"])])._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("ReadSchema")[0]
    assert "GreaterThan(x,10.0)" in pushed and "In(s, [a,b])" in pushed
    with pytest.raises(ValueError, match="operators"):
        keys(("x", "like", "a"))
