"""Store: scheme replacement, high-water marks, refused loads, snapshot, audit."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixture_schemes import frames
from wingspan.plans import load as L
from wingspan.operators.quality import model_checks
from wingspan.plans import publish as P


def _load(spark, f, starts=None, only=None):
    counts = L.resolve_species(f["counts"], f["checklist"])
    sites, visits, schemes = f["sites"], f["visits"], f["schemes"]
    if only:
        schemes = schemes.where(F.col("bms_id").isin(*only))
        sites, visits, counts = (x.where(F.col("bms_id").isin(*only)) for x in (sites, visits, counts))
    src = L.SchemeSources(sites, visits, counts)
    return L.load_tables(schemes, src, starts=starts)


@pytest.fixture()
def store(spark, tmp_path):
    f = frames(spark)
    st = P.init_model(spark, str(tmp_path / "model"))
    species = L.species_reference(f["checklist"])
    st.replace_schemes([], {"b_species_id": species})
    return st, f


def _clean_counts(f):
    # drop the count whose species is unknown so references hold
    f["counts"] = f["counts"].where(F.col("sci_name").isNull() | (F.col("sci_name") != "Unknown one"))
    return f


def test_publish_and_read(spark, store):
    st, f = store
    f = _clean_counts(f)
    st.replace_schemes(["AA", "BB"], _load(spark, f))
    assert st.table("m_site").count() == 8
    assert st.table("b_count").where("bms_id = 'BB'").count() == 1
    assert st.high_water("m_visit") == 13


def test_reload_gets_new_ids_and_leaves_other_scheme(spark, store):
    st, f = store
    f = _clean_counts(f)
    st.replace_schemes(["AA", "BB"], _load(spark, f))
    before_bb = sorted(rows(st.table("m_site").where("bms_id='BB'")))
    before_aa = st.table("m_site").where("bms_id='AA'")
    aa_content = sorted(rows(before_aa.drop("site_id")), key=str)
    marks = {t: st.high_water(t) for t in ("m_site", "b_recorder", "m_visit", "b_count")}
    st.replace_schemes(["AA"], _load(spark, f, starts=marks, only=["AA"]))
    after_aa = st.table("m_site").where("bms_id='AA'")
    assert sorted(rows(after_aa.drop("site_id")), key=str) == aa_content          # same content
    assert after_aa.agg(F.min("site_id")).first()[0] > marks["m_site"]           # ids above the mark
    assert sorted(rows(st.table("m_site").where("bms_id='BB'"))) == before_bb     # other scheme untouched


def test_empty_reload_removes_scheme(spark, store):
    st, f = store
    f = _clean_counts(f)
    st.replace_schemes(["AA", "BB"], _load(spark, f))
    empty = {k: v.limit(0) for k, v in _load(spark, f, only=["BB"]).items() if k != "bms_detail"}
    st.replace_schemes(["BB"], empty)
    assert st.table("m_site").where("bms_id='BB'").count() == 0
    assert st.table("m_site").where("bms_id='AA'").count() == 7


def test_refused_load_publishes_nothing(spark, store):
    st, f = store
    tables = _load(spark, f)      # keeps the count whose species is unknown -> fine (NULL passes) ...
    bad = tables["b_count"].withColumn("species_id", F.when(F.col("species_id").isNull(), F.lit(777))
                                       .otherwise(F.col("species_id")))
    tables["b_count"] = bad       # ... but 777 is not a species: reference violation
    with pytest.raises(P.PublishError):
        st.replace_schemes(["AA", "BB"], tables)
    assert st.table("m_site").count() == 0


def test_null_count_refused(spark, store):
    st, f = store
    tables = _load(spark, _clean_counts(f))
    tables["b_count"] = tables["b_count"].withColumn("butterfly_count", F.lit(None).cast("int"))
    with pytest.raises(P.PublishError, match="not_null"):
        st.replace_schemes(["AA", "BB"], tables)


def test_partition_pruning_on_read(spark, store):
    st, f = store
    st.replace_schemes(["AA", "BB"], _load(spark, _clean_counts(f)))
    plan = st.table("m_site").where("bms_id = 'AA'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bms_id" in plan


def test_export_snapshot(spark, store, tmp_path):
    st, f = store
    st.replace_schemes(["AA", "BB"], _load(spark, _clean_counts(f)))
    out = st.export_snapshot(str(tmp_path / "snap"), "csv")
    assert len(out) == len(P.MODEL)
    geo = spark.read.option("header", True).csv(str(tmp_path / "snap" / "m_site_geo"))
    assert geo.where(F.col("centroid_geom").startswith("SRID=3035;POINT(")).count() >= 1
    with pytest.raises(Exception):
        st.export_snapshot(str(tmp_path / "snap"))


def test_load_audit_and_statistics(spark):
    f = frames(spark)
    tables = _load(spark, f)
    audit = {(r["tbl"], r["bms_id"]): r["n"] for r in P.load_audit(tables).collect()}
    assert audit[("m_site", "AA")] == 7 and audit[("m_visit", "BB")] == 1
    stats = {r["column"]: r for r in P.collect_statistics(tables["m_site"]).collect()}
    assert stats["site_id"]["rows"] == 8 and stats["site_id"]["nulls"] == 0 and stats["site_id"]["min"] == "1"


def test_stage(spark, tmp_path):
    df = spark.range(3)
    p = P.stage(df, str(tmp_path), "site_stage")
    P.stage(spark.range(5), str(tmp_path), "site_stage")
    assert spark.read.parquet(p).count() == 5


def test_cascade_to_children_not_reloaded(spark, store):
    st, f = store
    st.replace_schemes(["AA", "BB"], _load(spark, _clean_counts(f)))
    hab = st.table("m_site").select("site_id", "bms_id").withColumn("year_stamp", F.lit(None).cast("date"))
    st.replace_schemes(["AA", "BB"], {"m_site_habitat": hab})
    assert st.table("m_site_habitat").count() == 8
    marks = {t: st.high_water(t) for t in ("m_site",)}
    from wingspan.plans import load as L2
    sites = L2.site_dim(f["sites"].where("bms_id = 'AA'"), f["schemes"], None, marks["m_site"])
    st.replace_schemes(["AA"], {"m_site": sites})
    assert st.last_cascade["m_site_habitat"] == 7
    assert st.table("m_site_habitat").where("bms_id = 'AA'").count() == 0
    assert st.table("m_site_habitat").where("bms_id = 'BB'").count() == 1
    assert st.table("b_count").where("bms_id = 'AA'").count() == 0    # counts referenced the old sites


def test_write_batched_and_analyze(spark, tmp_path):
    df = spark.range(250).withColumnRenamed("id", "count_id")
    P.write_batched(df.coalesce(1), str(tmp_path / "b"), ["count_id"], n=100)
    files = [f for f in (tmp_path / "b").iterdir() if f.name.endswith(".parquet")]
    assert len(files) == 3 and spark.read.parquet(str(tmp_path / "b")).count() == 250
    df.write.mode("overwrite").saveAsTable("wingspan_analyze_probe")
    P.analyze_table(spark, "wingspan_analyze_probe")
    desc = spark.sql("DESCRIBE EXTENDED wingspan_analyze_probe").collect()
    assert any("Statistics" in r[0] for r in desc)
    spark.sql("DROP TABLE wingspan_analyze_probe")


def test_trusted_keys_skip_only_constructed_checks(spark, store):
    st, f = store
    tables = _load(spark, _clean_counts(f))
    # a reference to an unknown species is still refused in trusted mode
    bad = dict(tables)
    bad["b_count"] = tables["b_count"].withColumn("species_id", F.lit(777))
    with pytest.raises(P.PublishError, match="fk_species_id"):
        st.replace_schemes(["AA", "BB"], bad, trusted_keys=True)
    res = {(r["tbl"], r["check"]) for r in model_checks(tables, only=list(tables), trusted=list(tables)).collect()}
    assert ("b_count", "primary_key") not in res and ("b_count", "fk_visit_id") not in res
    assert ("b_count", "not_null") in res
    st.replace_schemes(["AA", "BB"], tables, trusted_keys=True)
    assert st.table("b_count").count() == 5


def test_concurrent_publish_detected(spark, store):
    st, f = store
    other = P.Store(spark, st.root)          # a second loader on the same store
    other.manifest()
    st.replace_schemes(["AA", "BB"], _load(spark, _clean_counts(f)), trusted_keys=True)
    with pytest.raises(P.PublishError, match="another loader"):
        other.replace_schemes(["BB"], {"m_site": st.table("m_site").where("bms_id = 'BB'")}, check=False)
    assert st.table("m_site").count() == 8


def test_vacuum_removes_only_superseded_loads(spark, store):
    import os
    st, f = store
    first = st.replace_schemes(["AA", "BB"], _load(spark, _clean_counts(f)), trusted_keys=True)
    before = sorted(rows(st.table("m_site")))
    marks = {t: st.high_water(t) for t in ("m_site", "b_recorder", "m_visit", "b_count")}
    st.replace_schemes(["AA", "BB"], _load(spark, _clean_counts(f), starts=marks), trusted_keys=True)
    gone = st.superseded_loads()
    assert gone and all(lid == first for _, lid in gone)
    base = st.root.replace("file:", "")
    existing = [t for t, lid in gone if os.path.exists(os.path.join(base, t, f"load_id={lid}"))]
    assert existing and st.vacuum() == len(existing)     # loads emptied by cascade wrote no folder
    assert not os.path.exists(os.path.join(st.root.replace("file:", ""), "m_site", f"load_id={first}"))
    assert st.table("m_site").count() == len(before)          # current data untouched
    assert st.superseded_loads() == gone                        # history kept; folders already gone
