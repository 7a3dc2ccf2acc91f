"""End-to-end golden: the two-scheme fixture through every builder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixture_schemes import frames
from wingspan.plans import load as L


@pytest.fixture(scope="module")
def fx(spark):
    f = frames(spark)
    f["counts_resolved"] = L.resolve_species(f["counts"], f["checklist"])
    src = L.SchemeSources(f["sites"], f["visits"], f["counts_resolved"])
    f["tables"] = L.load_tables(f["schemes"], src)
    return f


def test_resolve_species(fx):
    got = {(r["bms_visit_id"], r["bms_site_id"], r["sci_name"]): r["species_id"]
           for r in fx["counts_resolved"].collect()}
    assert got[(5, 11, "Pieris rapae")] == 10          # first by file order
    assert got[(5, 12, None)] == 20                     # NULL matches NULL
    assert got[(6, 11, "Unknown one")] is None          # unknown name
    assert got[(6, 31, "Maniola agg")] == 1001


def test_site_dim(fx):
    s = fx["tables"]["m_site"]
    got = rows(s.orderBy("site_id"), "site_id", "bms_id", "transect_id", "section_id", "bms_site_id")
    assert [g[0] for g in got] == list(range(1, 9))
    assert got[0][1:] == ("AA", "AA.1", "1", 11)
    assert [g[4] for g in got if g[2] == "AA.2"] == [21, 22]          # tie ordered by bms_site_id
    assert sum(1 for g in got if g[4] == 31) == 2                      # two attribute variants
    assert got[-1][1:] == ("BB", "BB.1", "1", 11)


def test_recorder_dim(fx):
    r = rows(fx["tables"]["b_recorder"].where("bms_id = 'AA'").orderBy("recorder_id"), "recorder_id",
             "bms_observer_id")
    assert [x[1] for x in r] == ["07", "5", "6", "7", "8", None]      # text order, NULL last
    assert [x[0] for x in r] == [1, 2, 3, 4, 5, 6]


def test_visit_fact(fx):
    v = fx["tables"]["m_visit"].where("bms_id = 'AA'")
    by_id = {}
    for r in v.collect():
        by_id.setdefault(r["bms_visit_id"], []).append(r)
    assert len(by_id[1]) == 1 and by_id[1][0]["recorder_id"] == 2      # non-NULL observer wins
    assert len(by_id[None]) == 1                                       # NULL visit ids: one row
    assert len(by_id[2]) == 2 and len(by_id[3]) == 2                   # '07' and '7' fan out
    assert by_id[4][0]["recorder_id"] is None
    five = by_id[5][0]
    assert five["visit_date"] == dt.date(2023, 1, 5)
    assert five["visit_start"] == "10:35:00" and five["visit_end"] == "11:00:00"
    assert (five["visit_cloud"], five["visit_wind"]) == (2, 4)
    assert by_id[6][0]["visit_cloud"] == 4
    assert [by_id[k][0]["completed"] for k in (5, 6, 7, 8, 9)] == [True, False, True, False, None]
    assert v.count() == 12
    ids = sorted(r[0] for r in rows(fx["tables"]["m_visit"], "visit_id"))
    assert ids == list(range(1, 14))


def test_count_fact(fx):
    c = fx["tables"]["b_count"]
    got = rows(c.orderBy("count_id"), "count_id", "bms_id", "species_id", "butterfly_count")
    assert len(got) == 6                       # 7 read, 2 without visit or site, site 31 doubles one
    assert [g[0] for g in got] == [1, 2, 3, 4, 5, 6]
    assert sorted(g[3] for g in got if g[1] == "AA") == [1, 2, 3, 4, 4]  # site 31 has two rows: doubled
    un = L.unmatched_counts(fx["counts_resolved"], fx["tables"]["m_visit"], fx["tables"]["m_site"])
    assert un.count() == 2


def test_geo_dim(fx):
    g = fx["tables"]["m_site_geo"]
    got = {r["site_id"]: r for r in g.collect()}
    site = {r["bms_site_id"]: r["site_id"] for r in fx["tables"]["m_site"].where("bms_id='AA'").collect()
            if r["bms_site_id"] != 31}
    assert got[site[11]]["section_geom_true"] is True
    assert got[site[12]]["section_geom_true"] is False
    assert got[site[41]]["section_geom_true"] is None and got[site[41]]["centroid_geom"] is None
    assert got[site[11]]["centroid_geom"]["srid"] == 3035
    assert g.where("bms_id = 'AA'").count() == 6           # 31's two site rows collapse to the smallest id


def test_one_scheme_equals_slice_of_all(fx, spark):
    f = fx
    one = L.site_dim(f["sites"].where("bms_id = 'BB'").drop("bms_id"), f["schemes"], "BB")
    assert rows(one, "bms_id", "transect_id", "bms_site_id") == [("BB", "BB.1", 11)]


def test_missing_scheme_gives_empty_dims(fx):
    assert L.site_dim(fx["sites"].drop("bms_id"), fx["schemes"], "ZZ").count() == 0


def test_clean_visits(spark):
    df = spark.createDataFrame([("00:00", "9:5", None), ("0", "bad", 12)], "start_time string, end_time string, recorder_code int")
    got = rows(L.clean_visits(df), "start_time", "end_time", "recorder_code", "bms_observer_id")
    assert got == [("00:00:00", "09:05:00", 9999, 9999), ("00:00:00", None, 12, 12)]


def test_species_reference(spark):
    cl = spark.createDataFrame([(10, "A", False), (10, "A", False), (1001, "B agg", True)],
                               "Systematic_Order int, Accepted_Name string, Aggregate boolean")
    assert sorted(rows(L.species_reference(cl))) == [(10, "A", False), (1001, "B agg", True)]


def test_append_schemes(spark):
    a = spark.createDataFrame([("A", 1)], "bms_id string, bms_site_id int")
    b = spark.createDataFrame([("B", 2, "t")], "bms_id string, bms_site_id long, transect_id string")
    out = L.append_schemes([a, b], "m_site")
    assert out.columns[:3] == ["site_id", "bms_id", "transect_id"]
    assert sorted(rows(out, "bms_id", "bms_site_id", "transect_id"), key=str) == [("A", 1, None), ("B", 2, "t")]


def test_site_dim_distinct_before_cast(spark):
    from wingspan.sources.readers import Scheme, scheme_detail
    d = scheme_detail(spark, Scheme("Q", "QQQ", "Q", "c", "e"))
    s = spark.createDataFrame([("Q", "1", "1", 5, 2.3), ("Q", "1", "1", 5, 2.4), ("Q", "1", "1", 5, 2.4)],
                              "bms_id string, transect_id string, section_id string, bms_site_id int, "
                              "site_info_quality double")
    out = L.site_dim(s, d)
    assert sorted(rows(out, "site_id", "site_info_quality")) == [(1, 2), (2, 2)]
