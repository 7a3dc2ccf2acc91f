"""The commit log: two loaders at once, moved ids, cascades, leases, metrics of the writing job."""

import json
import os
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixture_schemes import frames
from wingspan.operators import graph as G
from wingspan.operators.quality import model_checks
from wingspan.plans import load as L
from wingspan.plans import publish as P
from wingspan.plans.commits import CHECKPOINT_EVERY, CommitLog, State

SEQUENCES = ("m_site", "b_recorder", "m_visit", "b_count")
TABLES = ("bms_detail", "m_site", "b_recorder", "m_visit", "b_count", "m_site_geo")


def build(f, schemes, starts):
    counts = L.resolve_species(f["counts"].where("sci_name is null or sci_name != 'Unknown one'"), f["checklist"])
    mine = F.col("bms_id").isin(*schemes)
    src = L.SchemeSources(f["sites"].where(mine), f["visits"].where(mine), counts.where(mine))
    return L.load_tables(f["schemes"].where(mine), src, starts=starts)


def load(store, f, *schemes):
    starts = {t: store.high_water(t) for t in SEQUENCES}
    return store.replace_schemes(list(schemes), build(f, schemes, starts), trusted_keys=True)


@pytest.fixture()
def model(spark, tmp_path):
    f = frames(spark)
    store = P.init_model(spark, str(tmp_path / "model"))
    store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    return store, f


def valid(store):
    """No key, reference, NOT NULL or length rule of the published model is broken."""
    every = {t: store.table(t) for t in P.MODEL}
    return model_checks(every).where("n > 0").collect() == []


def content(store, t):
    drop = [c for c in ("site_id", "recorder_id", "visit_id", "count_id") if c in store.table(t).columns]
    return Counter(map(str, rows(store.table(t).drop(*drop))))


def test_one_of_two_files_of_a_version_wins(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    won = []
    gate = threading.Barrier(8)

    def one(i):
        mine = CommitLog(spark, str(tmp_path))
        gate.wait()
        if mine.append({"version": 0, "by": i, "marks": {"m_site": i}}):
            won.append(i)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and log.state().marks == {"m_site": won[0]}
    assert [n for n in os.listdir(tmp_path / "_commits") if not n.startswith(".")] == [f"{0:020d}.json"]


def test_checkpoints_equal_the_fold_of_all_versions(spark, tmp_path):
    log, want = CommitLog(spark, str(tmp_path)), State()
    for v in range(2 * CHECKPOINT_EVERY + 3):
        commit = {"version": v, "entries": [{"tbl": "m_site", "bms_id": f"S{v % 4}", "load_id": f"l{v}", "rows": v}], "marks": {"m_site": 10 * v}}
        if v % 5 == 4:
            commit["deletes"] = [{"id": f"d{v}", "tbl": "m_site", "columns": ["site_id"], "loads": [f"l{v}"]}]
        assert log.append(commit)
        want = want.apply(commit)
    fresh = CommitLog(spark, str(tmp_path))
    names = [n for n in os.listdir(tmp_path / "_commits") if n.endswith(".checkpoint")]
    assert len(names) == 2
    read = []
    fresh_read, fresh._read = fresh._read, lambda n: read.append(n) or fresh_read(n)
    assert json.loads(fresh.state().to_json()) == json.loads(want.to_json())
    assert len(read) == 3  # the last checkpoint and what follows, not the history
    assert json.loads(fresh.state_at(7).to_json())["marks"] == {"m_site": 70}


def test_loads_of_other_schemes_at_one_version_both_stay(spark, model):
    store, f = model
    alone = P.init_model(spark, store.root + "-alone")
    alone.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    load(alone, f, "AA", "BB")
    first, second = P.Store(spark, store.root), P.Store(spark, store.root)
    marks = [{t: s.high_water(t) for t in SEQUENCES} for s in (first, second)]  # both at one version
    assert marks[0] == marks[1]
    ready = [build(f, [b], m) for b, m in zip(("AA", "BB"), marks, strict=True)]
    gate, failed = threading.Barrier(2), []

    def run(s, b, tables):
        try:
            gate.wait()
            s.replace_schemes([b], tables, trusted_keys=True)
        except Exception as exc:
            failed.append(exc)

    threads = [threading.Thread(target=run, args=x) for x in ((first, "AA", ready[0]), (second, "BB", ready[1]))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    for t in TABLES:
        assert content(store, t) == content(alone, t), t
    assert valid(store)
    for t in SEQUENCES:
        ids = [r[0] for r in rows(store.table(t), P.MODEL[t].serial)]
        assert len(ids) == len(set(ids)) and max(ids) == store.high_water(t)
    # references lead to the rows that they led to before ids were moved
    def joined(s):
        c, v, x = s.table("b_count"), s.table("m_visit"), s.table("m_site")
        return Counter(rows(c.join(v, "visit_id").join(x, "site_id").select("bms_visit_id", "bms_site_id", "species_id", "butterfly_count")))
    assert joined(store) == joined(alone)
    before = {t: sorted(rows(store.table(t)), key=str) for t in TABLES}
    assert store.compact() and not any(e.get("shift") for e in store.manifest())
    assert {t: sorted(rows(store.table(t)), key=str) for t in TABLES} == before


def test_a_load_that_another_one_overtakes(spark, model, monkeypatch):
    store, f = model
    load(store, f, "AA", "BB")
    slow, quick = P.Store(spark, store.root), P.Store(spark, store.root)
    real = slow._check

    def late(scheme):
        def check(*args, **kw):
            real(*args, **kw)
            if not late.done:
                late.done = True
                load(quick, f, scheme)
        late.done = False
        return check

    monkeypatch.setattr(slow, "_check", late("BB"))
    load(slow, f, "AA")
    assert valid(store) and store.table("m_site").count() == 8
    now = {t: content(store, t) for t in TABLES}
    monkeypatch.setattr(slow, "_check", late("AA"))
    with pytest.raises(P.PublishError, match="another loader published"):
        load(slow, f, "AA")
    assert {t: content(store, t) for t in TABLES} == now and valid(store)
    monkeypatch.setattr(slow, "_check", late("BB"))
    marks = slow.high_water("m_site")
    sites = build(f, ["AA"], {t: slow.high_water(t) for t in SEQUENCES})["m_site"]
    with pytest.raises(P.PublishError, match="m_site.published_key"):  # ids that the caller chose are not moved
        slow.replace_schemes(["AA"], {"m_site": sites})
    assert store.high_water("m_site") > marks


def test_references_are_checked_again_if_their_parent_changed(spark, model, monkeypatch):
    store, f = model
    slow = P.Store(spark, store.root)
    real, once = slow._check, []

    def check(*args, **kw):
        real(*args, **kw)
        if not once:
            once.append(1)
            P.Store(spark, store.root).delete_keys("b_species_id", spark.createDataFrame([(10,)], "species_id int"))

    monkeypatch.setattr(slow, "_check", check)
    with pytest.raises(P.PublishError, match="fk_species_id"):
        load(slow, f, "AA", "BB")
    assert store.table("b_count").count() == 0
    assert not any(os.listdir(os.path.join(store.root, "b_count")))  # a refused load leaves no folder


def test_metrics_of_the_writing_job(spark, model):
    store, f = model
    load(store, f, "AA", "BB")
    for t in TABLES:
        n = Counter(r["bms_id"] for r in store.table(t).select("bms_id").collect())
        got = {e["bms_id"]: e for e in store.manifest(refresh=True) if e["tbl"] == t}
        assert {b: e["rows"] for b, e in got.items()} == n
        if s := P.MODEL[t].serial:
            low, high = store.table(t).agg(F.min(s), F.max(s)).first()
            assert all((e["low"], e["high"]) == (low, high) for e in got.values())
    audit = {(r["tbl"], r["bms_id"]): r["n"] for r in store.audit().collect()}
    assert audit["m_site", "AA"] == 7 and audit["b_species_id", None] == store.table("b_species_id").count()
    bad = f["sites"].where("bms_id = 'AA'").withColumn("bms_id", F.lit("ZZ"))
    tables = {"m_site": L.site_dim(bad, f["schemes"].withColumn("bms_id", F.lit("ZZ")), None, store.high_water("m_site"))}
    with pytest.raises(P.PublishError, match="rows of other schemes: m_site.ZZ=7"):
        store.replace_schemes(["AA"], tables)


def test_no_scan_of_a_fact_after_its_write(spark, model):
    store, f = model
    starts = {t: store.high_water(t) for t in SEQUENCES}
    tables = build(f, ["AA", "BB"], starts)
    read = []
    real = store._read_loads
    store._read_loads = lambda name, ids: read.append(name) or real(name, ids)
    store.replace_schemes(["AA", "BB"], tables, trusted_keys=True)
    store._read_loads = real
    planned = set(read) - {"b_species_id"}  # what the load's frames are made of, before any check asks for them
    res = store.violations({t: store.table(t) for t in TABLES}, trusted=list(TABLES), measured=True, published=False)
    assert {r["tbl"] for r in res.collect()} == {"bms_detail"} and planned <= set(TABLES)


def test_delete_cascades_from_a_global_table(spark, model):
    store, f = model
    load(store, f, "AA", "BB")
    before = store.table("b_count").collect()
    gone = {r["species_id"] for r in before if r["species_id"] is not None}
    key = sorted(gone)[0]
    removed = store.delete_keys("b_species_id", spark.createDataFrame([(key,), (None,), (-5,)], "species_id int"))
    left = [r for r in before if r["species_id"] != key]
    assert Counter(store.table("b_count").collect()) == Counter(left)
    assert removed == {"b_species_id": 1, "b_count": len(before) - len(left)}
    assert valid(store)
    assert {r["bms_id"]: r["n"] for r in store.audit().where("tbl = 'b_count'").collect()} == {
        b: sum(r["bms_id"] == b for r in left) for b in ("AA", "BB")}
    # a species that comes back is not deleted again, and compaction changes no row
    store.replace_schemes([], {"b_species_id": L.species_reference(f["checklist"])})
    assert store.table("b_species_id").where(F.col("species_id") == key).count() == 1
    load(store, f, "BB")
    state = store.log.state()
    now = Counter(store.table("b_count").collect())
    assert state.deletes and store.compact()["b_count"] and store.log.state().deletes == []
    assert Counter(store.table("b_count").collect()) == now


def test_delete_cascades_through_levels(spark, model):
    store, f = model
    load(store, f, "AA", "BB")
    site = store.table("m_site").where("bms_id = 'AA'").select("site_id").orderBy("site_id").limit(2)
    ids = {r[0] for r in site.collect()}
    visits = store.table("m_visit").count()
    store.delete_keys("m_site", site)
    assert not ids & {r[0] for t in ("m_site", "b_count", "m_site_geo") for r in rows(store.table(t), "site_id")}
    assert store.table("m_visit").count() == visits and valid(store)
    store.delete_keys("bms_detail", spark.createDataFrame([("AA",)], "bms_id string"))
    for t in TABLES:
        assert {r[0] for r in rows(store.table(t), "bms_id")} <= {"BB"}, t
    assert valid(store)


def test_rename_cascades_in_one_version(spark, model):
    store, f = model
    load(store, f, "AA", "BB")
    version = store.log.state().version
    before = {t: rows(store.table(t)) for t in TABLES}
    changed = store.rekey("b_species_id", spark.createDataFrame([(10, 7010), (20, 10)], "species_id int, new_species_id int"))
    to = {10: 7010, 20: 10}
    at = store.table("b_count").columns.index("species_id")
    assert Counter(rows(store.table("b_count"))) == Counter(tuple(to.get(v, v) if i == at else v for i, v in enumerate(r)) for r in before["b_count"])
    assert store.log.state().version == version + 1 and valid(store)
    assert changed["b_count"] == sum(r[at] in to for r in before["b_count"])
    changed = store.rekey("bms_detail", spark.createDataFrame([("AA", "ZZ")], "bms_id string, new_bms_id string"))
    assert set(changed) == set(TABLES) and store.log.state().version == version + 2 and valid(store)
    for t in TABLES:
        c = store.table(t).columns.index("bms_id")
        renamed = Counter(r[c] for r in rows(store.table(t)))
        assert renamed == Counter({"AA": "ZZ"}.get(r[c], r[c]) for r in before[t])
    for names, why in (([("ZZ", "BB")], "equal"), ([("ZZ", "X"), ("ZZ", "Y")], "twice")):
        with pytest.raises(P.PublishError, match=why):
            store.rekey("bms_detail", spark.createDataFrame(names, "bms_id string, new_bms_id string"))


def test_rename_graph_of_several_levels_and_columns(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "y", 6), (None, "x", 7)], "k int, l string, v int")
    b = spark.createDataFrame([(1, "x", 100), (2, "y", 200), (1, None, 300)], "k int, l string, n int")
    c = spark.createDataFrame([("x", 1, 100), ("y", 2, 200)], "bl string, bk int, bn int")
    d = spark.createDataFrame([(9,)], "z int")
    edges = [("b", ["k", "l"], "a", ["k", "l"]), ("c", ["bk", "bl", "bn"], "b", ["k", "l", "n"]), ("d", ["z"], "e", ["z"])]
    m = spark.createDataFrame([(1, "x", 2, "z")], "old0 int, old1 string, new0 int, new1 string")
    out = G.cascade_rename({"a": a, "b": b, "c": c, "d": d}, edges, "a", ["k", "l"], m)
    assert Counter(rows(out["a"])) == Counter([(2, "z", 5), (2, "y", 6), (None, "x", 7)])
    assert Counter(rows(out["b"])) == Counter([(2, "z", 100), (2, "y", 200), (1, None, 300)])
    assert Counter(rows(out["c"])) == Counter([("z", 2, 100), ("y", 2, 200)])
    assert rows(out["d"]) == [(9,)]
    with pytest.raises(ValueError, match="part"):
        G.rename_targets([("b", ["k"], "a", ["k"])], "a", ["k", "l"])


def test_ids_that_are_published_already_refuse_the_load(spark, model):
    store, f = model
    load(store, f, "AA")
    high = store.high_water("m_site")
    sites = build(f, ["BB"], {"m_site": high - 1})["m_site"]  # one id below the mark: the last of AA's
    load(store, f, "BB")
    with pytest.raises(P.PublishError, match="m_site.published_key=1"):
        store.replace_schemes(["BB"], {"m_site": sites})
    read = []
    real = store._read_loads
    store._read_loads = lambda name, ids: read.append((name, tuple(ids))) or real(name, ids)
    store.replace_schemes(["BB"], {"m_site": build(f, ["BB"], {"m_site": store.high_water("m_site")})["m_site"]})
    assert len([r for r in read if r[0] == "m_site"]) == 1  # its own rows: no published load has ids near
    assert valid(store) or store.table("b_count").where("bms_id = 'BB'").count() == 0


def test_files_per_load_and_scheme_are_bounded(spark, model):
    store, f = model
    spark.conf.set("spark.wingspan.rowsPerFile", "3")
    try:
        lid = load(store, f, "AA", "BB")
    finally:
        spark.conf.unset("spark.wingspan.rowsPerFile")
    folder = os.path.join(store.root, "m_site_geo", f"load_id={lid}", "bms_id=AA")
    assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) == -(-store.table("m_site_geo").where("bms_id = 'AA'").count() // 3)
    for t in TABLES:
        for b in ("AA", "BB"):
            folder = os.path.join(store.root, t, f"load_id={lid}", f"bms_id={b}")
            for n in os.listdir(folder) if os.path.isdir(folder) else ():
                assert not n.endswith(".parquet") or spark.read.parquet(os.path.join(folder, n)).count() <= 3


def test_vacuum_waits_for_readers(spark, model):
    store, f = model
    load(store, f, "AA", "BB")
    with store.lease() as state:
        held = store.table("m_site", state)
        want = sorted(rows(held))
        load(store, f, "AA")
        load(store, f, "BB")
        assert store.superseded_loads() and P.Store(spark, store.root).vacuum() == 0
        assert sorted(rows(held)) == want
    assert store.vacuum() > 0 and store.vacuum() == 0 and store.superseded_loads() == []
    assert valid(store) and store.table("m_site").count() == 8


def test_scratch_scopes_side_by_side_keep_their_folders(spark):
    from wingspan.session import scratch_path, scratch_scope

    inside, ended = threading.Event(), threading.Event()
    made = {}

    def first():
        with scratch_scope(spark):
            made["a"] = scratch_path(spark, "a")
            spark.range(3).write.parquet(made["a"])
            inside.set()
            ended.wait(60)
            made["count"] = spark.read.parquet(made["a"]).count()

    t = threading.Thread(target=first)
    t.start()
    inside.wait(60)
    with scratch_scope(spark):
        L.together(lambda: made.update(b=scratch_path(spark, "b")), lambda: made.update(c=scratch_path(spark, "c")))
        spark.range(3).write.parquet(made["b"])
    ended.set()
    t.join()
    exists = lambda p: os.path.exists(p.replace("file:", ""))
    assert made["count"] == 3 and not any(exists(made[k]) for k in "abc")
