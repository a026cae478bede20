"""CSV read in splits, CSV with quoted line feeds, and depots that mix JSON lines with array documents."""
import json
import os

from quarry.sources import files as FS


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


def _in_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")


def _whole_again(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_plain_file_is_read_by_many_tasks(spark, tmp_root):
    _write(f"{tmp_root}/plain.csv", "id,name\n" + "".join(f'{i},"n ""{i}"", é"\n' for i in range(5000)))
    _in_splits(spark, "8k")
    try:
        out = FS.read_csv(spark, f"{tmp_root}/plain.csv")
        assert out.rdd.getNumPartitions() > 8
        assert sorted((r.id, r.name) for r in out.collect()) == [(i, f'n "{i}", é') for i in range(5000)]
    finally:
        _whole_again(spark)


def test_quoted_line_feeds_beside_plain_files_of_another_header(spark, tmp_root):
    _write(f"{tmp_root}/a b/plain.csv", "id,name\n" + "".join(f"{i},p{i}\n" for i in range(3000)))
    _write(f"{tmp_root}/a b/whole.csv", 'name,id\n"two\nlines, ""q""\n",5000\nlast,5001\n')
    _write(f"{tmp_root}/a b/latin.csv", 'id,name\n6000,"é\nè"\n', "latin-1")
    _write(f"{tmp_root}/a b/empty.csv", "")
    _in_splits(spark, "4k")
    try:
        got = sorted((r.id, r.name, r._encoding) for r in FS.read_csv(spark, f"{tmp_root}/a b").collect())
    finally:
        _whole_again(spark)
    assert got == [*((i, f"p{i}", "UTF-8") for i in range(3000)), (5000, 'two\nlines, "q"\n', "UTF-8"), (5001, "last", "UTF-8"), (6000, "é\nè", "ISO-8859-1")]


def test_json_lines_beside_array_documents(spark, tmp_root):
    _write(f"{tmp_root}/d/lines.json", "".join(json.dumps({"a": i, "b": f"x{i}"}) + "\n" for i in range(2000)))
    _write(f"{tmp_root}/d/pretty.json", "\n \n" + json.dumps([{"a": -1, "c": {"d": 1}}, {"a": -2}], indent=2))
    _write(f"{tmp_root}/d/one line.json", "﻿" + json.dumps([{"a": -3}, {"a": -4}]) + "\n")
    _write(f"{tmp_root}/d/blank.json", " \n\n")
    _in_splits(spark, "4k")
    try:
        out = FS.read_json(spark, f"{tmp_root}/d")
        got = sorted((r.a, r.b, r.c and r.c.d) for r in out.collect())
        typed = FS.read_json(spark, f"{tmp_root}/d", "a long")
        assert sorted(r.a for r in typed.collect()) == [-4, -3, -2, -1, *range(2000)]
    finally:
        _whole_again(spark)
    assert sorted(out.columns) == ["a", "b", "c"]
    assert got == [(-4, None, None), (-3, None, None), (-2, None, None), (-1, None, 1), *((i, f"x{i}", None) for i in range(2000))]
    assert FS.read_json(spark, f"{tmp_root}/d/blank.json", "a long").collect() == []
