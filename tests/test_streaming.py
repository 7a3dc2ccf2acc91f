"""Scheme deliveries through the streaming feed."""

import json

from pyspark.sql import functions as F

from fixture_schemes import SCHEMES, frames
from wingspan.plans import load as L
from wingspan.plans import publish as P
from wingspan.streaming.feed import start_feed


def test_feed_loads_each_delivery_once(spark, tmp_path):
    f = frames(spark)
    store = P.init_model(spark, str(tmp_path / "model"))
    store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    req_dir = tmp_path / "requests"
    req_dir.mkdir()
    for s in SCHEMES:
        paths = {}
        for name in ("sites", "visits", "counts"):
            p = str(tmp_path / "staging" / s.bms_id / name)
            f[name].where(F.col("bms_id") == s.bms_id).drop("bms_id").write.parquet(p)
            paths[name] = p
        req = {"bms_id": s.bms_id, "country_iso3": s.country_iso3, "country_name": s.country_name,
               "contact_name": s.contact_name, "contact_email": s.contact_email, **paths}
        (req_dir / f"{s.bms_id}.json").write_text(json.dumps(req))
    q = start_feed(spark, str(req_dir), store, str(tmp_path / "ckpt"), checklist=f["checklist"], available_now=True)
    q.awaitTermination(300)
    audit = {(r["tbl"], r["bms_id"]): r["n"] for r in P.load_audit(
        {t: store.table(t) for t in ("m_site", "m_visit", "b_count")}).collect()}
    assert audit[("m_site", "AA")] == 7 and audit[("m_site", "BB")] == 1
    assert audit[("m_visit", "BB")] == 1 and audit[("b_count", "BB")] == 1
    # a restart with no new request changes nothing
    mark = store.high_water("m_site")
    q2 = start_feed(spark, str(req_dir), store, str(tmp_path / "ckpt"), checklist=f["checklist"], available_now=True)
    q2.awaitTermination(300)
    assert store.high_water("m_site") == mark


def _request(spark, f, at, scheme, sites):
    """A delivery of a scheme with only the given site ids."""
    paths = {}
    for name in ("sites", "visits", "counts"):
        df = f[name].where(F.col("bms_id") == scheme.bms_id)
        df = df.where(F.col("bms_site_id").isin(*sites)) if name == "sites" else df.where("1 = 0") if name == "counts" else df
        df.drop("bms_id").write.parquet(paths.setdefault(name, f"{at}/{name}"))
    return {"bms_id": scheme.bms_id, "country_iso3": scheme.country_iso3, "country_name": scheme.country_name,
            "contact_name": scheme.contact_name, "contact_email": scheme.contact_email, **paths}


def test_every_request_for_a_scheme_is_loaded_in_order_and_once(spark, tmp_path, monkeypatch):
    from wingspan.streaming import feed

    f = frames(spark)
    store = P.init_model(spark, str(tmp_path / "model"))
    store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    ids = sorted(r[0] for r in f["sites"].where("bms_id = 'AA'").select("bms_site_id").distinct().collect())
    aa, bb = (next(s for s in SCHEMES if s.bms_id == b) for b in ("AA", "BB"))
    wanted = [ids[:3], ids[:1], ids[:2]]
    requests = [_request(spark, f, tmp_path / f"d{i}", aa, some) for i, some in enumerate(wanted)]
    requests.insert(1, _request(spark, f, tmp_path / "b", bb, [r[0] for r in f["sites"].where("bms_id = 'BB'").select("bms_site_id").collect()]))
    assert [[r["bms_id"] for r in some] for some in feed.rounds(requests)] == [["AA", "BB"], ["AA"], ["AA"]]
    audits, real = [], store.replace_schemes
    monkeypatch.setattr(store, "replace_schemes", lambda *a, **k: (real(*a, **k), audits.append(dict(((t, b), n) for t, b, n in store.last_audit)))[0])
    assert feed.load_batch(spark, store, requests[:2], f["checklist"], "s", 0) == 1          # the batch broke off behind its first round
    assert feed.load_batch(spark, store, requests, f["checklist"], "s", 0) == 2              # it runs again: two rounds are left
    assert [a.get(("m_site", "AA")) for a in audits] == [f["sites"].where((F.col("bms_id") == "AA") & F.col("bms_site_id").isin(*some)).count() for some in wanted]
    version = store.log.state().version
    assert feed.load_batch(spark, store, requests, f["checklist"], "s", 0) == 0 and store.log.state().version == version
    assert {r[0] for r in store.table("m_site").where("bms_id = 'AA'").select("bms_site_id").collect()} == set(wanted[-1])
    assert store.table("m_site").where("bms_id = 'BB'").count() > 0
