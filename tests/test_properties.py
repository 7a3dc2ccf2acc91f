"""Properties of the load, checked on generated data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from wingspan.operators.keys import assign_ids
from wingspan.plans import load as L
from wingspan.sources.readers import Scheme, scheme_detail

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.text("ab", max_size=2)),
                           st.integers(-3, 3)), min_size=0, max_size=60)


@SETTINGS
@given(data=keyed, start=st.integers(0, 1000), parts=st.integers(1, 5))
def test_ids_dense_ordered_any_partitioning(spark, data, start, parts):
    df = spark.createDataFrame(data, "a int, b string, c int").repartition(parts)
    out = sorted(rows(assign_ids(df, ["a", "b"], "id", start)))
    assert [r[0] for r in out] == list(range(start + 1, start + 1 + len(data)))

    def key(r):
        return tuple((v is None, v if v is not None else 0) for v in r)

    assert [r[1:] for r in out] == sorted(data, key=key)


visits_st = st.lists(st.integers(1, 8), min_size=1, max_size=8, unique=True)
counts_st = st.lists(st.tuples(st.integers(1, 10), st.integers(1, 6), st.integers(0, 9)), min_size=0, max_size=40)


@SETTINGS
@given(visit_ids=visits_st, site_ids=st.lists(st.integers(1, 6), min_size=1, max_size=6, unique=True), counts=counts_st)
def test_counts_published_equal_read_minus_unmatched(spark, visit_ids, site_ids, counts):
    detail = scheme_detail(spark, Scheme("S", "SSS", "S", "c", "e"))
    sites = spark.createDataFrame([("S", "1", str(s), s) for s in site_ids],
                                  "bms_id string, transect_id string, section_id string, bms_site_id int")
    visits = spark.createDataFrame([("S", v, "1", "1") for v in visit_ids],
                                   "bms_id string, bms_visit_id int, bms_observer_id string, transect_id string")
    c = spark.createDataFrame([("S", v, s, 1, float(n)) for v, s, n in counts],
                              "bms_id string, bms_visit_id int, bms_site_id int, species_id int, count double")
    m_site = L.site_dim(sites, detail)
    m_visit = L.visit_fact(visits, L.recorder_dim(visits, detail), detail)
    fact = L.count_fact(c, m_visit, m_site)
    expected = sum(1 for v, s, _ in counts if v in visit_ids and s in site_ids)
    assert fact.count() == expected
    assert fact.agg(F.coalesce(F.sum("butterfly_count"), F.lit(0))).first()[0] == sum(
        n for v, s, n in counts if v in visit_ids and s in site_ids)
    # unmatched_counts lists every count row without a visit or a site, once
    assert L.unmatched_counts(c, m_visit, m_site).count() == sum(
        1 for v, s, _ in counts if v not in visit_ids or s not in site_ids)
