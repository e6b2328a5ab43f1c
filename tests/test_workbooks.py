"""Workbooks as a data source."""

import datetime
import zipfile

import pytest
from pyspark.sql import functions as F

from sondeo.sources import workbooks, xlsx


@pytest.fixture
def books(spark):
    workbooks.register(spark)
    return spark.read.format("workbook")


def test_round_trip_of_all_kinds(spark, books, tmp_path):
    at = datetime.datetime(2025, 8, 1, 10, 30)
    rows = [("á<&>'\"", 1, 1.5, True, at, None), ("a\r\nb\tc\x00\x0b_x0041_ ", -2, 2.0, False, None, "x"), (None,) * 6, ("", 10**14, float("inf"), None, at, "  y")]
    df = spark.createDataFrame(rows, "`¿a?` string, i long, d double, b boolean, at timestamp_ntz, `x.1` string")
    df.repartition(3).write.format("workbook").mode("append").save(str(tmp_path / "m.xlsx"))
    back = books.load(str(tmp_path / "m.xlsx"))
    assert back.columns == df.columns and set(dict(back.dtypes).values()) == {"string"}
    want = [("á<&>'\"", "1", "1.5", "True", "2025-08-01 10:30:00", None), ("a\r\nb\tc\x00\x0b_x0041_ ", "-2", "2", "False", None, "x"), (None, str(10**14), "inf", None, "2025-08-01 10:30:00", "  y")]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, xlsx.read_sheet(spark, str(tmp_path / "m.xlsx")).collect()), key=str) == sorted(want, key=str)
    assert [p.name for p in tmp_path.iterdir()] == ["m.xlsx"]
    with pytest.raises(Exception, match="there already"):
        df.write.format("workbook").mode("append").save(str(tmp_path / "m.xlsx"))
    df.limit(1).write.format("workbook").mode("overwrite").save(str(tmp_path / "m.xlsx"))
    assert books.load(str(tmp_path / "m.xlsx")).count() <= 1
    df.where("false").write.format("workbook").mode("overwrite").save(str(tmp_path / "m.xlsx"))
    assert books.load(str(tmp_path / "m.xlsx")).columns == df.columns and books.load(str(tmp_path / "m.xlsx")).count() == 0


def test_rows_of_a_sheet_are_dealt_to_tasks(spark, books, tmp_path, monkeypatch):
    rows = spark.range(0, 20_000, 1, 5).selectExpr("id", "concat('text ', id) as t", "if(id % 3 = 0, null, id % 7) as k")
    rows.write.format("workbook").mode("append").save(str(tmp_path / "m.xlsx"))
    back = books.option("rows", 3000).load(str(tmp_path / "m.xlsx"))
    assert back.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, back.collect())) == sorted((str(r.id), r.t, None if r.k is None else str(r.k)) for r in rows.collect())
    assert max(back.groupBy(F.spark_partition_id()).count().toPandas()["count"]) <= 4500
    with zipfile.ZipFile(tmp_path / "m.xlsx") as book:  # parts are put together in order, whatever is unpacked at once
        sheet = book.read("xl/worksheets/sheet1.xml")
    for size in (1, 7, 100, 4096):
        small = tmp_path / f"{size}.xlsx"
        small.write_bytes(xlsx.write_sheet(rows.limit(60)))
        monkeypatch.setattr(workbooks, "CHUNK", size)
        with open(small, "rb") as file:
            book = xlsx.Book(file)
            whole = [book.cells(r) for r in workbooks._parsed_rows(book, 0, None)]
            for first, end in ((0, 1), (1, None), (5, 9), (59, None), (60, 61), (61, None), (200, None)):
                assert [book.cells(r) for r in workbooks._row_elements(book, first, end)] == whole[first:end]
    assert sheet.count(b"<row>") == 20_001


def test_only_wanted_cells_are_read(spark, books, tmp_path, monkeypatch):
    df = spark.createDataFrame([(f"a{i}", f"b{i % 3}", None if i % 4 else "c") for i in range(40)], "a string, b string, c string")
    df.write.format("workbook").mode("append").save(str(tmp_path / "m.xlsx"))
    back = books.load(str(tmp_path / "m.xlsx"))
    for where in ("b = 'b1'", "c is null", "a like '%2%' or b = 'b0'"):  # one after the other over the same frame
        assert sorted(map(str, back.where(where).collect())) == sorted(map(str, df.where(where).collect())), where
    reader = workbooks.WorkbookReader(str(tmp_path / "m.xlsx"), ["a", "b"], 100)
    seen = []
    made = xlsx.Book.cells
    monkeypatch.setattr(workbooks.Book, "cells", lambda self, row, wanted=None: seen.append(wanted) or made(self, row, wanted))
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["b"] for r in got].count("b1") == 13 and len(got) == 40 and {frozenset(w) for w in seen if w is not None} == {frozenset({0, 1})}
    only = books.schema("b string").load(str(tmp_path / "m.xlsx"))
    assert only.columns == ["b"] and only.where("b = 'b1'").count() == 13
    with pytest.raises(Exception, match="as text"):
        books.schema("b int").load(str(tmp_path / "m.xlsx")).count()


def test_files_meet_by_name_and_repeated_names_are_told_apart(spark, books, tmp_path):
    for name, df in (("a", spark.createDataFrame([("1", "2", "3")], "x string, y string, z string").toDF("x", "x", "y")), ("b", spark.createDataFrame([("4", "5")], "y string, w string"))):
        (tmp_path / f"{name}.xlsx").write_bytes(xlsx.write_sheet(df.toDF(*[f"c{i}" for i in range(len(df.columns))])))
        frame = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        rows = [tuple(r) for r in frame.collect()]
        body = xlsx.sheet_start(df.columns, None) + "".join(f"<row>{''.join(map(xlsx.text_cell, r))}</row>" for r in rows).encode() + xlsx.sheet_end()
        with zipfile.ZipFile(tmp_path / f"{name}.xlsx", "w") as book:
            xlsx.package(book)
            book.writestr("xl/worksheets/sheet1.xml", body)
    for path in (f"{tmp_path}/*.xlsx", str(tmp_path)):
        back = books.load(path)
        assert back.columns == ["x", "x.1", "y", "w"]
        assert sorted(map(tuple, back.collect()), key=str) == sorted([("1", "2", "3", None), (None, None, "4", "5")], key=str)
    assert books.load(f"{tmp_path}/none*.xlsx").columns == []


def test_comments_and_other_prefixes(spark, books, tmp_path):
    body = b'<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><!-- <row> --><x:sheetData>' + b"".join(b'<x:row r="%d"><x:c r="B%d" t="inlineStr"><x:is><x:t>v%d</x:t></x:is></x:c></x:row>' % (i, i, i) for i in range(1, 9)) + b"<x:row/></x:sheetData></x:worksheet>"
    with zipfile.ZipFile(tmp_path / "m.xlsx", "w") as book:
        xlsx.package(book)
        book.writestr("xl/worksheets/sheet1.xml", body)
    back = books.load(str(tmp_path / "m.xlsx"))
    assert back.columns == ["Unnamed: 0", "v1"] and [r.v1 for r in back.collect()] == [f"v{i}" for i in range(2, 9)]


def test_failed_writes_leave_nothing(spark, books, tmp_path, monkeypatch):
    rows = spark.range(0, 100, 1, 4)
    broken = rows.select(F.when(F.col("id") == 80, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).alias("id"))
    for options in ({}, {"each": "task"}):
        with pytest.raises(Exception, match="stopped"):
            broken.write.format("workbook").options(**options).mode("append").save(str(tmp_path / "m.xlsx"))
        assert not [p for p in tmp_path.rglob("*") if p.is_file()]
    monkeypatch.setattr(workbooks, "SHEET_ROWS", 50)
    workbooks.register(spark)
    with pytest.raises(Exception, match="each=task"):
        rows.write.format("workbook").mode("append").save(str(tmp_path / "n.xlsx"))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_a_folder_of_workbooks(spark, books, tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "SHEET_ROWS", 30)
    workbooks.register(spark)
    rows = spark.range(0, 200, 1, 3).selectExpr("id", "id % 7 as k")
    for mode in ("append", "overwrite"):
        rows.write.format("workbook").option("each", "task").mode(mode).save(str(tmp_path / "out"))
        assert sorted(int(r.id) for r in books.load(str(tmp_path / "out")).collect()) == list(range(200))
        assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [f"part-{i:05}.xlsx" for i in range(9)]
    rows.limit(5).coalesce(1).write.format("workbook").option("each", "task").mode("overwrite").save(str(tmp_path / "out"))
    assert books.load(str(tmp_path / "out")).count() == 5
