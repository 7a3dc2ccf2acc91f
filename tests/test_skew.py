"""Hot keys: one key holds a third of all rows. Results must not change when
broadcasts are off and AQE splits skewed partitions."""

import contextlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wingspan.operators import relational as R
from wingspan.plans import load as L
from wingspan.sources.readers import Scheme, scheme_detail

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.wingspan.dimBroadcastRows": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    detail = scheme_detail(spark, Scheme("S", "SSS", "S", "c", "e"))
    sites = spark.createDataFrame([("S", "1", str(s), s) for s in range(1, 21)],
                                  "bms_id string, transect_id string, section_id string, bms_site_id int")
    visits = spark.createDataFrame([("S", v, str(v % 7), "1") for v in range(1, 301)],
                                   "bms_id string, bms_visit_id int, bms_observer_id string, transect_id string")
    # visit 1 and site 1 hold a third of all counts
    hot = [("S", 1, 1, i % 5, 1.0) for i in range(1500)]
    rest = [("S", 1 + i % 300, 1 + i % 20, i % 9, float(i % 4)) for i in range(3000)]
    counts = spark.createDataFrame(hot + rest, "bms_id string, bms_visit_id int, bms_site_id int, species_id int, "
                                               "count double")
    return detail, sites, visits, counts


def _fact(detail, sites, visits, counts):
    m_site = L.site_dim(sites, detail)
    m_visit = L.visit_fact(visits, L.recorder_dim(visits, detail), detail)
    return L.count_fact(counts, m_visit, m_site)


def test_count_fact_same_under_skew_split(spark, skewed):
    base = sorted(rows(_fact(*skewed)))
    with conf(spark, SKEW_CONF):
        split = sorted(rows(_fact(*skewed)))
    assert base == split
    assert len(base) == 4500 and [r[0] for r in base] == list(range(1, 4501))


def test_merge_left_hot_null_key(spark):
    counts = spark.createDataFrame([(i, None if i % 3 == 0 else f"n{i % 4}") for i in range(3000)], "id int, nm string")
    k = spark.createDataFrame([(None, 0), ("n1", 1), ("n2", 2)], "Search_Name string, sid int")
    with conf(spark, SKEW_CONF):
        out = R.merge_left(counts, k, [("nm", "Search_Name")])
        got = dict(rows(out.groupBy("sid").count()))
    assert got[0] == 1000 and got[None] == sum(1 for i in range(3000) if i % 3 and i % 4 in (0, 3))


def test_distinct_on_hot_key(spark):
    df = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "k int, v int")
    with conf(spark, SKEW_CONF):
        out = R.distinct_on(df, ["k"], ["v"])
        got = dict(rows(out))
    assert got[0] == 0 and len(got) == 1000
