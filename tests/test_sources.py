"""File sources and sinks on files written to a fresh temp folder."""
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from quarry.sources import files as FS
from quarry.sources.inline import as_frame
from quarry.sources.sinks import write_csv


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_listing_and_summary(spark, tmp_root):
    _write(f"{tmp_root}/raw/a.CSV", b"x\n1\n")
    _write(f"{tmp_root}/raw/sub/b.json", b'{"x": 1}\n')
    _write(f"{tmp_root}/raw/c.txt", b"nope")
    files = FS.list_files(spark, f"{tmp_root}/raw")
    assert [r.label for r in files.collect()] == ["a.CSV", "sub/b.json"]
    summary = FS.depot_summary(files).first()
    assert (summary.files, summary.total_bytes, summary.total_size_label) == (2, 13, "13 o")
    assert FS.list_files(spark, f"{tmp_root}/missing").count() == 0


def test_csv_encoding_fallback(spark, tmp_root):
    _write(f"{tmp_root}/u/f.csv", "﻿name,n\nété,1\n".encode("utf-8"))
    _write(f"{tmp_root}/l/f.csv", "name,n\nété,2\n".encode("latin-1"))
    out = FS.read_csv(spark, [f"{tmp_root}/u/f.csv", f"{tmp_root}/l/f.csv"])
    got = sorted((r.name, r.n, r._encoding) for r in out.collect())
    assert got == [("été", 1, "UTF-8"), ("été", 2, "ISO-8859-1")]


def test_json_array_and_lines(spark, tmp_root):
    _write(f"{tmp_root}/arr.json", json.dumps([{"a": 1}, {"a": 2}]).encode())
    _write(f"{tmp_root}/lines.json", b'{"a": 3}\n{"a": 4}\n')
    out = FS.read_json(spark, [f"{tmp_root}/arr.json", f"{tmp_root}/lines.json"])
    assert sorted(r.a for r in out.collect()) == [1, 2, 3, 4]


def test_dispatch(spark, tmp_root):
    spark.range(3).write.parquet(f"{tmp_root}/t.parquet")
    assert FS.read_tabular(spark, f"{tmp_root}/t.parquet").count() == 3
    with pytest.raises(ValueError):
        FS.read_tabular(spark, f"{tmp_root}/t.txt")
    with pytest.raises(NotImplementedError):
        FS.read_tabular(spark, f"{tmp_root}/t.xlsx")


def test_newest_export_and_preference(spark, tmp_root):
    df = spark.createDataFrame([(1, "a")], "id int, title string")
    write_csv(df, f"{tmp_root}/clean/books_cleaned_old.csv")
    time.sleep(1.1)
    write_csv(df, f"{tmp_root}/clean/cleaned_books_new.csv")
    write_csv(df, f"{tmp_root}/clean/cars_cleaned.csv")
    newest = FS.newest_export(spark, f"{tmp_root}/clean", "books").first()
    assert newest.export == "cleaned_books_new.csv"
    frame, origin = FS.load_cleaned(spark, df.limit(0), f"{tmp_root}/clean", "books")
    assert origin == "cleaned_books_new.csv" and frame.count() == 1
    frame, origin = FS.load_cleaned(spark, df, f"{tmp_root}/clean", "books")
    assert origin == "table"


def test_inline_records(spark):
    assert as_frame(spark, {"a": 1}).count() == 1
    assert as_frame(spark, None).count() == 0
    assert [r.ordinal for r in as_frame(spark, [{"a": 1}, {"b": 2}]).collect()] == [0, 1]
    with pytest.raises(TypeError):
        as_frame(spark, [{"a": 1}, 3])


def test_csv_sink_marks_every_part(spark, tmp_root):
    df = spark.createDataFrame([(n, "é") for n in range(4)], "id int, t string").repartition(2)
    path = write_csv(df, f"{tmp_root}/bom")
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 2
    for part in parts:
        with open(os.path.join(path, part), "rb") as fh:
            assert fh.read().startswith(b"\xef\xbb\xbfid,t")
    assert sorted(tuple(r) for r in FS.read_csv(spark, path).drop("_encoding").collect()) == [(n, "é") for n in range(4)]


def test_csv_round_trip_keeps_values(spark, tmp_root):
    rows = [(1, "  pad "), (2, 'say ""hi"", ok'), (3, "two\nlines"), (4, ""), (5, None), (6, "a,b\\c")]
    df = spark.createDataFrame(rows, "id long, t string")
    for encoding in ("UTF-8", "ISO-8859-1"):
        path = write_csv(df, f"{tmp_root}/{encoding}", encoding=encoding)
        # CSV has one form for empty text and NULL; both come back as NULL.
        assert sorted(tuple(r) for r in FS.read_csv(spark, path).drop("_encoding").collect()) == [(i, t or None) for i, t in rows]


def test_csv_files_by_their_own_header(spark, tmp_root):
    _write(f"{tmp_root}/a.csv", b'title,price\n"A, ""one""",1\n')
    _write(f"{tmp_root}/b.csv", b"price,title,extra\n2,B,x\n")
    _write(f"{tmp_root}/c.csv", b"")
    out = FS.read_csv(spark, [f"{tmp_root}/{x}.csv" for x in "abc"])
    assert sorted((r.title, r.price, r.extra) for r in out.collect()) == [('A, "one"', 1, None), ("B", 2, "x")]
    assert FS.read_csv(spark, f"{tmp_root}/c.csv").count() == 0


def test_json_kinds_by_file_in_one_folder(spark, tmp_root):
    _write(f"{tmp_root}/j/a.json", b"\n" + b" " * 5000 + json.dumps([{"a": 1}, {"a": 2}], indent=1).encode())
    _write(f"{tmp_root}/j/b.json", b"\n" * 400 + b'{"a": 3}\n   {"a": 4}\n{"a": 5}\n')
    _write(f"{tmp_root}/j/c.json", b"")
    assert sorted(r.a for r in FS.read_json(spark, f"{tmp_root}/j").collect()) == [1, 2, 3, 4, 5]


def test_table_allow_list(spark, tmp_root):
    spark.range(2).write.parquet(f"{tmp_root}/books")
    assert FS.read_table(spark, {"books": f"{tmp_root}/books"}, "books").count() == 2
    with pytest.raises(ValueError):
        FS.read_table(spark, {"books": f"{tmp_root}/books"}, "users")


def test_page_urls(spark):
    crawls = spark.createDataFrame([("c", 3)], "crawl string, max_pages int")
    got = [r.page_url for r in FS.page_urls(crawls, "https://s/page-{page}.html").orderBy("page").collect()]
    assert got == ["https://s/page-1.html", "https://s/page-2.html", "https://s/page-3.html"]
