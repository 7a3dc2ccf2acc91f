"""Constraints as queries."""

from pyspark.sql import functions as F

from conftest import rows
from wingspan.operators import quality as Q


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 4)], "a int, b int")
    assert sorted(rows(Q.key_violations(df, ["a"])), key=str) == sorted([(1, 3), (None, 2)], key=str)


def test_fk_violations_null_passes(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, p int")
    parent = spark.createDataFrame([(10,)], "p int")
    assert rows(Q.fk_violations(child, parent, ["p"]), "id") == [(2,)]


def test_not_null_and_length(spark):
    df = spark.createDataFrame([(1, "x" * 256), (None, "ok")], "a int, s string")
    assert Q.not_null_violations(df, ["a"]).count() == 1
    assert Q.length_violations(df, ["s"]).count() == 1


def test_domain_rules_zero_rows_kept(spark):
    df = spark.createDataFrame([(50, 3), (101, 13), (None, 2)], "visit_cloud int, visit_wind int")
    got = dict(rows(Q.domain_violations(df, Q.visit_domain_rules())))
    assert got == {"cloud_0_100": 1, "wind_0_12": 1}
    sp = spark.createDataFrame([(1001, True), (5, True), (1000, False), (7, False)], "species_id int, aggregate boolean")
    assert dict(rows(Q.domain_violations(sp, Q.species_domain_rules()))) == {
        "aggregate_above_1000": 1, "aggregate_at_1000": 1}


def test_section_length_check(spark):
    df = spark.createDataFrame([("T1", 50.0, 100.0), ("T1", 60.0, 100.0), ("T2", 50.0, 100.0), ("T2", 60.01, 100.0)],
                               "t string, s double, l double")
    assert sorted(rows(Q.section_length_check(df, ["t"], "s", "l"))) == [("T1", True), ("T2", False)]


def test_model_checks(spark):
    site = spark.createDataFrame([(1, "A", 5), (1, "A", 6), (2, "Z", 7)], "site_id long, bms_id string, bms_site_id int")
    detail = spark.createDataFrame([("A",)], "bms_id string")
    res = {(r["tbl"], r["check"]): r["n"] for r in
           Q.model_checks({"m_site": site, "bms_detail": detail}, only=["m_site"]).collect()}
    assert res[("m_site", "primary_key")] == 2
    assert res[("m_site", "fk_bms_id")] == 1
    assert res[("m_site", "not_null")] == 0


def test_cast_rejects_and_strict(spark):
    import pytest as _pt
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    assert rows(Q.cast_rejects(df, "v", "int")) == [("x",)]
    with _pt.raises(Exception):
        df.select(Q.strict_cast("v", "int")).collect()


def test_load_warnings(spark):
    from wingspan.functions.geometry import make_point
    site = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("B", 1)], "bms_id string, bms_site_id int")
    rec = spark.createDataFrame([("A", "07"), ("A", "7"), ("A", "8"), ("A", None)], "bms_id string, bms_observer_id string")
    geo = spark.createDataFrame([(3.0, 50.0), (3000000.0, 2000000.0)], "x double, y double").select(
        make_point("x", "y").alias("centroid_geom"))
    got = dict(rows(Q.load_warnings(site, rec, geo)))
    assert got == {"duplicate_bms_site_id": 1, "duplicate_observer_int": 1, "degree_like_point": 1}
