"""Raw CSV files of a scheme to the published store in one call."""

from pyspark.sql import functions as F

from conftest import rows
from fixture_schemes import SCHEMES, frames
from wingspan.plans import load as L
from wingspan.plans import publish as P
from wingspan.plans.run import SchemeFiles, load_scheme, load_schemes

SCHEMAS = {
    "sites": "transect_id string, section_id string, bms_site_id int, transect_length double, section_length double, "
             "monitoring_type string, longitude double, latitude double, geo_info_level string",
    "visits": "bms_visit_id int, bms_observer_id string, transect_id string, visit_date string, start_time string, "
              "end_time string, visit_cloud double, visit_wind double, completed string",
    "counts": "bms_visit_id int, bms_site_id int, sci_name string, count double",
}


def _csv(f, tmp_path):
    out = {}
    for s in SCHEMES:
        paths = {}
        for kind in ("sites", "visits", "counts"):
            p = str(tmp_path / "raw" / s.bms_id / kind)
            f[kind].where(F.col("bms_id") == s.bms_id).drop("bms_id").coalesce(1).write.option("header", True).csv(p)
            paths[kind] = p
        out[s] = SchemeFiles(**paths)
    return out


def test_load_schemes_from_csv(spark, tmp_path):
    f = frames(spark)
    store = P.init_model(spark, str(tmp_path / "model"))
    store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    files = _csv(f, tmp_path)
    rep = load_schemes(spark, store, files, f["checklist"], SCHEMAS)
    audit = {(r["tbl"], r["bms_id"]): r["n"] for r in rep.audit.collect()}
    assert audit[("m_site", "AA")] == 7 and audit[("b_count", "AA")] == 5 and audit[("m_visit", "AA")] == 12
    assert rep.dropped_counts.count() == 2
    warn = dict(rows(rep.warnings))
    assert warn["duplicate_bms_site_id"] == 1 and warn["duplicate_observer_int"] == 1
    # reload one scheme from its files: new ids above the marks, the other scheme untouched
    mark = store.high_water("m_site")
    bb = sorted(rows(store.table("m_site").where("bms_id = 'BB'")))
    aa = [s for s in SCHEMES if s.bms_id == "AA"][0]
    load_scheme(spark, store, aa, files[aa], f["checklist"], SCHEMAS)
    assert store.table("m_site").where("bms_id = 'AA'").agg(F.min("site_id")).first()[0] > mark
    assert sorted(rows(store.table("m_site").where("bms_id = 'BB'"))) == bb


def test_scratch_removed_after_publish(spark, tmp_path):
    import os

    from wingspan import session as S
    f = frames(spark)
    store = P.init_model(spark, str(tmp_path / "model2"))
    store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    before = len(S._SCRATCH_MADE)
    seen = []
    orig = S.drop_paths

    def spy(sp, paths):
        seen.extend(paths)
        return orig(sp, paths)

    S.drop_paths = spy
    try:
        import wingspan.plans.run as run_mod
        run_mod.load_schemes(spark, store, _csv(f, tmp_path), f["checklist"], SCHEMAS)
    finally:
        S.drop_paths = orig
    assert seen and len(S._SCRATCH_MADE) == before
    assert not any(os.path.exists(p.replace("file:", "")) for p in seen)
    assert store.table("b_count").count() == 6      # published data does not depend on the scratch


def test_scratch_removed_when_load_refused(spark, tmp_path):
    import os

    import pytest

    from wingspan import session as S
    f = frames(spark)
    store = P.init_model(spark, str(tmp_path / "model3"))   # no species published: counts' species fail the reference
    before = len(S._SCRATCH_MADE)
    seen = []
    orig = S.drop_paths

    def spy(sp, paths):
        seen.extend(paths)
        return orig(sp, paths)

    S.drop_paths = spy
    try:
        import wingspan.plans.run as run_mod
        store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"]).where("species_id = 10")})
        with pytest.raises(P.PublishError):
            run_mod.load_schemes(spark, store, _csv(f, tmp_path), f["checklist"], SCHEMAS)
    finally:
        S.drop_paths = orig
    assert seen and len(S._SCRATCH_MADE) == before
    assert not any(os.path.exists(p.replace("file:", "")) for p in seen)
    assert store.table("m_site").count() == 0
