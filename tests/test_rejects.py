"""Rejects beside the rows: one scan, one write, strict refusal, text keys, broadcasts by bytes, the geometry guard."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixture_schemes import SCHEMES, frames
from test_run import SCHEMAS, _csv
from wingspan.functions.geometry import make_point
from wingspan.operators.quality import model_checks
from wingspan.plans import load as L
from wingspan.plans import publish as P
from wingspan.plans.load import broadcast_if_small
from wingspan.plans.model import CHECKLIST, CHECKLIST_COLUMNS
from wingspan.plans.run import load_reference, load_schemes
from wingspan.sources.readers import read_checklist, read_raw
from wingspan.sources.rejects import REJECTS, RULES, listed, readable_as, split, with_rejects


def test_rows_and_rejects_from_one_write(spark, tmp_path):
    df = spark.createDataFrame([("A", "1", "3.5"), ("A", "x", "many"), (None, None, "99999999999"), ("A", "x", "")],
                               "bms_id string, bms_visit_id string, count string")
    kept, bad = split(with_rejects(df, RULES["counts"]), str(tmp_path / "c"))
    assert sorted(rows(kept), key=str) == sorted(rows(df), key=str)  # rows stay as they came
    assert set(rows(listed(bad, "counts"))) == {("counts", "A", "bms_visit_id", "x", 2), ("counts", "A", "count", "many", 1),
                                                ("counts", "A", "count", "", 1), ("counts", None, "count", "99999999999", 1)}
    plan = listed(bad, "counts")._jdf.queryExecution().executedPlan().toString()
    assert "bms_visit_id:string" not in plan.split("ReadSchema")[1]  # the list reads one column and the scheme


def test_no_rules_empty_tables_and_taken_name(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "other int")
    assert rows(with_rejects(df, RULES["sites"])) == [(1, None)]
    kept, bad = split(with_rejects(df.limit(0), {"other": readable_as("int")}), str(tmp_path / "e"))
    assert kept.count() == 0 and listed(bad, "t").count() == 0
    with pytest.raises(ValueError, match="taken"):
        with_rejects(df.withColumn(REJECTS, F.lit(1)), RULES["sites"])


def test_malformed_record_is_listed(spark, tmp_path):
    p = tmp_path / "v.csv"
    p.write_text("bms_visit_id,visit_date\n1,2023-1-5\nx,2023-1-6\n")
    _, bad = split(with_rejects(read_raw(spark, str(p), "bms_visit_id int, visit_date string"), RULES["visits"]), str(tmp_path / "v"))
    assert rows(listed(bad, "visits")) == [("visits", None, "_corrupt_record", "x,2023-1-6", 1)]


def _checklist_file(tmp_path, *order):
    cells = {"Search_Name": "Pieris rapae", "Accepted_Name": "Pieris rapae", "Aggregate": "0"}
    lines = [",".join(n for n, _ in CHECKLIST_COLUMNS)]
    lines += [",".join({**cells, "Accepted_Name": f"P{i}", "Systematic_Order": o}.get(n, "") for n, _ in CHECKLIST_COLUMNS) for i, o in enumerate(order)]
    (tmp_path / "check.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "check.csv")


def test_checklist_ids_are_reported_or_refused(spark, tmp_path):
    path = _checklist_file(tmp_path, "10", "ten", "11")
    plain, marked = read_checklist(spark, path), read_checklist(spark, path, rejects=True)
    assert REJECTS not in plain.columns and rows(marked.drop(REJECTS)) == rows(plain)
    store = P.init_model(spark, str(tmp_path / "m"))
    with pytest.raises(P.PublishError, match="1 rejected values, listed in") as e:
        load_reference(store, marked, strict=True)
    assert store.table("b_species_id").count() == 0
    kept = spark.read.parquet(str(e.value).split("listed in ")[1])  # the list outlives the refusal
    assert rows(kept, "tbl", "col", "value", "n") == [(CHECKLIST, "Systematic_Order", "ten", 1)]
    load_reference(store, read_checklist(spark, _checklist_file(tmp_path, "10", "11"), rejects=True), strict=True)
    assert sorted(rows(store.table("b_species_id"), "species_id")) == [(10,), (11,)]


def _text(f, kind, **change):
    df = f[kind]
    df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return df.withColumns(change)


def test_load_of_text_files_lists_all_tables(spark, tmp_path):
    f = frames(spark)
    f["sites"] = _text(f, "sites", section_length=F.when(F.col("bms_site_id") == "12", "long").otherwise(F.col("section_length")))
    f["visits"] = _text(f, "visits", visit_wind=F.when(F.col("bms_visit_id") == "9", "calm").otherwise(F.col("visit_wind")))
    f["counts"] = _text(f, "counts", bms_site_id=F.when(F.col("bms_site_id") == "999", "?").otherwise(F.col("bms_site_id")))
    schemas = {k: ", ".join(f"{c} string" for c in f[k].columns if c != "bms_id") for k in RULES}
    store = P.init_model(spark, str(tmp_path / "m"))
    load_reference(store, f["checklist"])
    files = _csv(f, tmp_path)
    with pytest.raises(P.PublishError, match="3 rejected values"):
        load_schemes(spark, store, files, f["checklist"], schemas, strict=True)
    assert store.table("m_site").count() == 0
    rep = load_schemes(spark, store, files, f["checklist"], schemas)
    assert set(rows(rep.rejects)) == {("sites", "AA", "section_length", "long", 1), ("visits", "AA", "visit_wind", "calm", 1),
                                      ("counts", "AA", "bms_site_id", "?", 1)}
    # otherwise as from typed files
    typed = frames(spark)
    other = P.init_model(spark, str(tmp_path / "typed"))
    load_reference(other, typed["checklist"])
    ref = load_schemes(spark, other, _csv(typed, tmp_path / "t"), typed["checklist"], SCHEMAS)
    assert ref.rejects.count() == 0 and rep.dropped_counts.count() == ref.dropped_counts.count() == 2
    for t in ("b_count", "b_recorder", "m_site_geo"):
        assert sorted(rows(store.table(t)), key=str) == sorted(rows(other.table(t)), key=str)
    assert store.table("m_site").where("section_length is null").count() == 1
    assert {s.bms_id for s in SCHEMES} == {r["bms_id"] for r in store.table("m_visit").select("bms_id").distinct().collect()}


def test_broadcast_is_bounded_by_bytes(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("name"))
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, max_bytes=10_000))
    assert not hinted(broadcast_if_small(df, max_rows=9))
    assert hinted(broadcast_if_small(df.select("id"), max_bytes=10 * 32)) and not hinted(broadcast_if_small(df.select("id"), max_bytes=10 * 32 - 1))
    assert hinted(broadcast_if_small(df.limit(0), max_bytes=0))


def test_geometry_guard_refuses_a_load(spark, tmp_path):
    store = P.init_model(spark, str(tmp_path / "m"))
    f = frames(spark)
    load_reference(store, f["checklist"])
    src = L.SchemeSources(f["sites"], L.clean_visits(f["visits"]), L.resolve_species(f["counts"], f["checklist"]))
    tables = L.load_tables(f["schemes"], src)
    good = tables["m_site_geo"]
    assert rows(model_checks({"m_site_geo": good}).where("check = 'point'"), "n") == [(0,)]  # NULL points pass
    tables["m_site_geo"] = good.withColumn("centroid_geom", F.when(F.col("section_geom_true"), make_point(F.lit(8.5), F.lit(47.0), 4326)).otherwise(F.col("centroid_geom")))
    with pytest.raises(P.PublishError, match=r"m_site_geo.point=\d"):
        store.replace_schemes([s.bms_id for s in SCHEMES], tables, trusted_keys=True)
    assert store.table("m_site_geo").count() == 0
