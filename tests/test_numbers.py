"""Worked vectors of the three number dialects, integers and strict coercion."""
import math

import pytest
from pyspark.sql import functions as F

from quarry.functions import numbers as N

NULL = None
# input, cleaning (H3), storage (H6), analytics (H5)
DIALECTS = [
    ("£51.77", 51.77, 51.77, 51.77),
    ("1,234.56", 1234.56, 1234.56, 1.23456),
    ("1.234,56", 1234.56, 1234.56, 1234.56),
    ("1,234", 1234.0, 1.234, 1.234),
    ("1.234", 1234.0, 1.234, 1.234),
    ("1.2345", 12345.0, 1.2345, 1.2345),
    ("1,23,45", 123.45, NULL, NULL),
    ("12 500 000 CFA", 12500000.0, 12500000.0, 12500000.0),
    ("12 500 000 CFA", 12500000.0, 12500000.0, 12500000.0),
    ("51.77, net", 5177.0, 5177.0, 5177.0),
    ("12.", 12.0, 12.0, 12.0),
    ("1,234.56.78", NULL, NULL, 1.2345678),
    ("£-5", -5.0, -5.0, -5.0),
    ("- 5", 5.0, -5.0, -5.0),
    ("12-34", 12.0, NULL, NULL),
    ("1e5", 1.0, 15.0, 15.0),
    ("abc", NULL, NULL, NULL),
    ("", NULL, NULL, NULL),
    (None, NULL, NULL, NULL),
    ("1d", 1.0, 1.0, 1.0),
]


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-12)


@pytest.mark.parametrize("col,fn", [(1, N.parse_decimal), (2, N.storage_number), (3, N.analytics_number)])
def test_dialects(spark, col, fn):
    got = _run(spark, [r[0] for r in DIALECTS], fn)
    for row, value in zip(DIALECTS, got):
        assert _same(value, row[col]), (row[0], value, row[col])


INTEGERS = [
    ("12 500 km", 12500), ("In stock (22 available)", 22), ("12.5", 125), ("2011.0", 20110),
    ("5-6", 56), ("-5 km", -5), ("  -5", -5), ("Page -3", 3), ("aucun", None), (None, None),
]


def test_parse_integer(spark):
    got = _run(spark, [v for v, _ in INTEGERS], N.parse_integer)
    assert got == [e for _, e in INTEGERS]


def test_integer_numeric_path(spark):
    df = spark.createDataFrame([(2011.0,), (-3.9,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(N.integer_for(df.schema["x"].dataType, "x")).collect()]
    assert got == [2011, -3, None, None]


def test_coerce_numeric_strict(spark):
    values = [" 12 ", "1e2", "1d", "1,5", "", "NaN", "-.5", "inf"]
    got = _run(spark, values, N.coerce_numeric)
    assert got == [12.0, 100.0, None, None, None, None, -0.5, None]


def test_non_finite_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,)], "x double")
    got = [r[0] for r in df.select(N.finite("x")).collect()]
    assert got == [None, None, 1.5]
    big = _run(spark, ["9" * 400], N.parse_decimal)
    assert big == [None]


def test_booleans_are_not_numbers(spark):
    df = spark.createDataFrame([(True,), (False,)], "x boolean")
    dtype = df.schema["x"].dataType
    got = df.select(N.storage_for(dtype, "x"), N.analytics_for(dtype, "x")).collect()
    assert all(v is None for r in got for v in r)
