"""Unit tables for every scalar rule."""

import pytest
from pyspark.sql import functions as F

from wingspan.functions import geometry as G
from wingspan.functions import scalars as X


def apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


TIME_CASES = [
    ("10:30", "10:30:00"), ("10.30", "10:30:00"), ("10,30", "10:30:00"),
    ("9:30", "09:30:00"), ("9", "09:00:00"), ("0", "00:00:00"),
    ("10:30:20", "10:30:20"), ("10:35 uhr", "10:35:00"),
    ("10:30 - 11:45", "10:30:11"),
    ("10h30", None), ("1030", None), ("25:00", None), ("10:61", None), ("abc", None), ("", None), (None, None),
    ("09:5", "09:05:00"), ("9:5", None), ("9:30:5", None), ("-9:30", None),
    ("24:00", "24:00:00"), ("24:01", None),
    ("10:30:60", "10:31:00"), ("23:59:60", "24:00:00"), ("10:30:61", None),
]


def test_try_cast_to_time(spark):
    got = apply(spark, X.try_cast_to_time, [c[0] for c in TIME_CASES])
    assert got == [c[1] for c in TIME_CASES]


INT_CASES = [
    ("20-25", 20), ("20 - 25", 20), ("12,5", 13), ("15 C", 15), (".5", 1), ("3.", 3), ("12.0", 12), ("0", 0),
    ("100%", 10), ("12345", 12), ("-5", None), ("1.2.3", None), ("abc", None), ("", None), (None, None),
]


def test_try_extract_integer(spark):
    got = apply(spark, lambda c: X.try_extract_integer(c, 2), [c[0] for c in INT_CASES])
    assert got == [c[1] for c in INT_CASES]


def test_try_extract_integer_width(spark):
    assert apply(spark, lambda c: X.try_extract_integer(c, 3), ["100%", "12345", "7.2"]) == [100, 123, 8]


BOOL_CASES = [("1", True), ("0", False), ("on", True), ("of", False), ("off", False), (None, None),
              (" Yes ", True), ("t", True), ("TRU", True), ("fals", False), ("n", False), ("o", None),
              ("2", None), ("maybe", None)]


def test_parse_bool(spark):
    assert apply(spark, X.parse_bool, [c[0] for c in BOOL_CASES]) == [c[1] for c in BOOL_CASES]


def test_parse_bool_from_int(spark):
    assert apply(spark, X.parse_bool, [1, 0, None], "int") == [True, False, None]


def test_bool_reject(spark):
    assert apply(spark, X.bool_reject, ["1", "maybe", None]) == [False, True, False]


def test_normalise_clock(spark):
    vals = ["00:00", "0", "00:00:00", "9:5", "10:35", "0:35", "10:35:20", "24:10", "10:61", "abc", None, ""]
    exp = ["00:00:00", "00:00:00", "00:00:00", "09:05:00", "10:35:00", "00:35:00", "10:35:20", None, None, None,
           None, None]
    assert apply(spark, X.normalise_clock, vals) == exp


def test_clock_to_minute(spark):
    vals = ["10:35:20", "9:5", "10:35 approx", "00:00:00", "25:00", "x", None, "23:59:59"]
    exp = ["10:35:00", "09:05:00", "10:35:00", "00:00:00", None, None, None, "23:59:00"]
    assert apply(spark, X.clock_to_minute, vals) == exp


def test_parse_date(spark):
    import datetime as dt
    vals = ["2023-1-5", "2023-01-05", "2023-12-31 10:00", "2023-02-30", "2023-13-01", "05/01/2023", None]
    exp = [dt.date(2023, 1, 5), dt.date(2023, 1, 5), dt.date(2023, 12, 31), None, None, None, None]
    assert apply(spark, X.parse_date, vals) == exp


def test_assign_int_half_even(spark):
    assert apply(spark, X.assign_int, [2.5, 3.5, -2.5, 2.4999, 1e12, None], "double") == [2, 4, -2, 2, None, None]


def test_assign_int_decimal_half_up(spark):
    df = spark.createDataFrame([(1, "2.5"), (2, "3.5"), (3, "-2.5")], "i int, v string")
    got = [r[0] for r in df.select(X.assign_int_decimal(F.col("v").cast("decimal(10,2)"))).orderBy(F.lit(1)).collect()]
    assert sorted(got) == sorted([3, 4, -3])


def test_fill_missing(spark):
    assert apply(spark, X.fill_missing, [5, None], "int") == [5, 9999]


def test_qualify_null_propagates(spark):
    df = spark.createDataFrame([("A", "1"), ("A", None), (None, "2")], "b string, t string")
    assert [r[0] for r in df.select(X.qualify("b", "t")).collect()] == ["A.1", None, None]


def test_section_flag(spark):
    vals = ["section_centroid", "transect_centroid", "other", None]
    assert apply(spark, X.section_flag, vals) == [True, False, None, None]


def test_site_info_quality(spark):
    df = spark.createDataFrame([
        (1, 100.0, "section_centroid", 1.0, 2.0), (2, 100.0, "transect_centroid", 1.0, 2.0),
        (3, None, "section_centroid", 1.0, 2.0), (4, 100.0, "section_centroid", None, 2.0),
        (5, 100.0, "other", 1.0, 2.0)], "i int, l double, g string, x double, y double")
    got = [r[0] for r in df.orderBy("i").select(X.site_info_quality("l", "g", "x", "y")).collect()]
    assert got == [1, 2, 3, 3, 3]


def test_within_tolerance(spark):
    df = spark.createDataFrame([(110.0, 100.0), (110.01, 100.0), (90.0, 100.0)], "t double, d double")
    assert [r[0] for r in df.select(X.within_tolerance("t", "d")).collect()] == [True, False, True]


def test_make_point_and_ewkt(spark):
    df = spark.createDataFrame([(1, 3.0, 4.5), (2, None, 1.0), (3, 12.0, 7.0)], "i int, x double, y double")
    out = df.orderBy("i").select(G.ewkt(G.make_point("x", "y")).alias("g"), G.make_point("x", "y").alias("p"))
    got = out.collect()
    assert [r["g"] for r in got] == ["SRID=3035;POINT(3 4.5)", None, "SRID=3035;POINT(12 7)"]
    assert got[0]["p"]["srid"] == 3035


def test_point_guards(spark):
    df = spark.createDataFrame([(1, 3035, 1.0, 2.0), (2, 4326, 1.0, 2.0), (3, 3035, None, 2.0)],
                               "i int, s int, x double, y double")
    p = F.struct(F.col("s").alias("srid"), F.col("x").alias("x"), F.col("y").alias("y"))
    got = [r[0] for r in df.orderBy("i").select(G.point_violation(p)).collect()]
    assert got == [False, True, True]
    assert [r[0] for r in df.orderBy("i").select(G.lonlat_warning(p)).collect()] == [True, True, False]


def test_point_equality_in_distinct(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.select(G.make_point("x", "y").alias("p")).distinct().count() == 2


@pytest.mark.parametrize("fn", [X.try_cast_to_time, X.normalise_clock, X.clock_to_minute, X.parse_bool])
def test_scalars_stay_in_codegen(spark, fn):
    df = spark.createDataFrame([("10:30",)], "v string").select(fn(F.col("v")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
