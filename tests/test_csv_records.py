import csv
import random

import pytest

from ledgerline.sources.csv_records import POSITION, csv_records, field_count, line_function, read_csv_table
from ledgerline.sources.tables import read_csv, write_csv


@pytest.fixture
def small_splits(spark):
    """splits of a few hundred bytes, so that records cross many of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def in_order(df):
    return [tuple(r) for r in df.orderBy(*POSITION).drop(*POSITION).collect()]


def test_line_functions():
    assert line_function("a,b,c") == (0, 1)
    assert line_function('a,"b,c') == (1, 0)
    assert line_function('a,"b ""c"",d",e') == (0, 0)  # inside, the first quote closes and the rest is text
    assert line_function('x"y,5" pipe') == (0, 0)  # a quote inside a field opens nothing
    assert line_function('"') == (1, 0) and line_function('""') == (0, 1) and line_function('"""') == (1, 0)
    assert line_function("") == (0, 1) and line_function('a,""') == (0, 1)
    assert [field_count(r) for r in ("", "a", "a,", ',"x,y",', 'p"q,r')] == [1, 1, 2, 3, 2]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_splits_equal_a_sequential_reader(small_splits, tmp_path, end):
    rng, rows = random.Random(len(end)), [["id", "name", "note"]]
    for i in range(60):
        name = rng.choice(["plain", 'said "so"', "two\nlines", "a,b", "\n\n", 'mixed "x",\r\n"y"', "", "é€", 'pad ', "long " * 40 + "\n" + "z" * 200])
        rows.append([str(i), name, rng.choice(["", "n", 'q"', "line\nbreak"])])
    path = tmp_path / "t.csv"
    with path.open("w", newline="", encoding="utf-8") as f:
        f.write("﻿")
        csv.writer(f, lineterminator=end).writerows(rows)
    table = read_csv_table(small_splits, str(path), positions=True)
    assert table.rows.columns == ["id", "name", "note", *POSITION]
    assert in_order(table.rows) == [tuple(v or None for v in r) for r in rows[1:]]
    assert table.rejected.count() == 0
    assert table.rows.select("source_block").distinct().count() > 5


def test_a_field_longer_than_whole_splits(small_splits, tmp_path):
    path = tmp_path / "t.csv"
    body = "\n".join(f"line {i}, of one field" for i in range(120))
    path.write_text(f'a,b\n1,"{body}"\n2,x\n', encoding="utf-8")
    assert in_order(read_csv_table(small_splits, str(path), positions=True).rows) == [("1", body), ("2", "x")]


def test_malformed_records_are_kept_apart(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,2,3\n\n4,5\n6,7,8,9\n"x\ny",5" pipe,z\n7,"open,1\n8,9,10\n', encoding="utf-8")
    table = read_csv_table(spark, str(path))
    assert sorted(map(tuple, table.rows.collect())) == [("1", "2", "3"), ("x\ny", '5" pipe', "z")]
    assert [(r["source_line"], r["record"], r["reason"]) for r in table.rejected.orderBy("source_line").collect()] == [
        (3, "4,5", "too few fields"), (4, "6,7,8,9", "too many fields"), (7, '7,"open,1\n8,9,10', "unclosed quote")]
    with pytest.raises(ValueError, match="too few fields|too many|unclosed"):
        read_csv(spark, str(path))
    assert read_csv(spark, str(path), malformed="drop").count() == 2


def test_files_have_their_own_headers_and_must_agree(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text('"a\nb",c\n1,2\n')
    (tmp_path / "d" / "2.csv").write_text('"a\nb",c\n3,4')
    (tmp_path / "d" / "3.csv").write_text('"a\nb",c\n')
    rows = read_csv_table(spark, str(tmp_path / "d"), positions=True).rows
    assert rows.columns[:2] == ["a\nb", "c"] and in_order(rows) == [("1", "2"), ("3", "4")]
    (tmp_path / "d" / "4.csv").write_text("a,c\n1,2\n")
    with pytest.raises(ValueError, match="another header"):
        read_csv_table(spark, str(tmp_path / "d"))


def test_what_is_written_is_read_again(spark, tmp_path):
    rows = [(1, "two\nlines", ' padded "x" '), (2, "cr\r\nlf", None), (3, None, "a,b"), (4, "lone \" quote", "\n"), (5, '"', "'")]
    df = spark.createDataFrame([*rows[:2], (3, "", "a,b"), *rows[3:]], "id int, name string, note string")  # an empty text reads as NULL
    write_csv(df, str(tmp_path / "out"))
    got = read_csv(spark, str(tmp_path / "out")).selectExpr("CAST(id AS INT) AS id", "name", "note")
    assert sorted(map(tuple, got.collect())) == rows


def test_no_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    table = read_csv_table(spark, str(tmp_path / "t.csv"))
    assert table.rows.columns == ["a", "b"] and table.rows.collect() == [] and table.rejected.collect() == []
    assert csv_records(spark, str(tmp_path / "t.csv")).count() == 1
