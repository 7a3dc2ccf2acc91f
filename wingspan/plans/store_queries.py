"""Registered queries of the published store and of sources and small operators
that no other query runs, with their DuckDB statements. Stand-ins as in
``queries``: a scheme is a region (or a return flag), a site a supplier, a visit
an order, a count a line item, the species list ``part``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.functions import geometry as G
from wingspan.operators import quality, relational as R
from wingspan.plans import load as L
from wingspan.plans import publish as P
from wingspan.plans import queries as Q
from wingspan.session import scratch_path
from wingspan.sources.rejects import RULES, listed, split, with_rejects
from wingspan.sources.readers import Scheme, for_scheme, read_checklist, read_raw, scheme_detail, staged

SEQUENCES = ("m_site", "b_recorder", "m_visit", "b_count")


def _species(spark: SparkSession, sf: str) -> DataFrame:
    part = Q.table(spark, sf, "part")
    return L.species_reference(part.select(F.col("p_partkey").alias("Systematic_Order"), F.concat_ws(" ", "p_name", "p_partkey").alias("Accepted_Name"),
                                           (F.col("p_size") > 25).alias("Aggregate")))


def _loaded(spark: SparkSession, sf: str, only: str | None = None) -> P.Store:
    """A store with the species and every region (or one) loaded through all six tables."""
    store = P.init_model(spark, scratch_path(spark, "store"))
    store.replace_schemes([], {"b_species_id": _species(spark, sf)})
    detail = Q.schemes_from_regions(spark, sf)
    ids = [only] if only else [r["bms_id"] for r in detail.select("bms_id").collect()]  # scheme names: the load's parameters
    frames = [f(spark, sf) for f in (Q.sites_by_region, Q.visits_by_region, Q.counts_by_region)]
    src = L.SchemeSources(*[for_scheme(f, only) if only else f for f in frames])
    starts = {t: store.high_water(t) for t in SEQUENCES}
    store.replace_schemes(ids, L.load_tables(detail, src, only, starts), trusted_keys=True)
    return store


def q_load_all_counts(spark, sf):
    return _loaded(spark, sf).table("b_count").select("count_id", "bms_id", "visit_id", "site_id", "species_id", "butterfly_count")


def q_load_scheme_counts(spark, sf):
    """Every count of one region with what the other five tables say of it."""
    store = _loaded(spark, sf, Q.SCHEME)
    t = {n: store.table(n) for n in ("b_count", "m_visit", "m_site", "b_recorder", "m_site_geo", "bms_detail")}
    out = t["b_count"].join(t["m_visit"].drop("bms_id"), "visit_id").join(t["m_site"].drop("bms_id", "transect_id"), "site_id")
    out = out.join(t["b_recorder"].drop("bms_id"), "recorder_id").join(t["m_site_geo"].drop("bms_id"), "site_id").join(t["bms_detail"], "bms_id")
    return out.select("count_id", "visit_id", "site_id", "recorder_id", "species_id", "butterfly_count", "bms_visit_id", "bms_site_id", "bms_observer_id",
                      "section_id", "transect_id", F.col("visit_date").cast("string").alias("visit_date"), "section_geom_true",
                      F.col("centroid_geom.x").alias("x"), F.col("centroid_geom.y").alias("y"), "country_name")


def _counts_by_flag(spark: SparkSession, sf: str) -> P.Store:
    """A store with the species, their thesaurus and counts, a scheme per return flag."""
    store = P.init_model(spark, scratch_path(spark, "store"))
    part, li = Q.table(spark, sf, "part"), Q.table(spark, sf, "lineitem")
    thesaurus = part.select(F.concat_ws("/", "p_brand", "p_partkey").alias("species_sci_name"), F.col("p_partkey").alias("species_id"))
    store.replace_schemes([], {"b_species_id": _species(spark, sf), "species_thesaurus": thesaurus})
    flags = [r[0] for r in li.select("l_returnflag").distinct().collect()]  # scheme names
    store.replace_schemes(flags, {"b_count": li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("count_id"), F.col("l_orderkey").alias("visit_id"), F.col("l_suppkey").alias("site_id"),
        F.col("l_partkey").alias("species_id"), F.col("l_quantity").alias("butterfly_count"), F.col("l_returnflag").alias("bms_id"))}, check=False)
    return store


def _named(store: P.Store) -> DataFrame:
    b, s, t = store.table("b_count"), store.table("b_species_id"), store.table("species_thesaurus")
    out = b.select(F.lit("b_count").alias("tbl"), "bms_id", F.col("count_id").cast("string").alias("id"), "species_id")
    out = out.unionByName(s.select(F.lit("b_species_id").alias("tbl"), F.lit(None).cast("string").alias("bms_id"), F.col("species_acpt_sci_name").alias("id"), "species_id"))
    return out.unionByName(t.select(F.lit("species_thesaurus").alias("tbl"), F.lit(None).cast("string").alias("bms_id"), F.col("species_sci_name").alias("id"), "species_id"))


def q_species_delete(spark, sf):
    store = _counts_by_flag(spark, sf)
    store.delete_keys("b_species_id", Q.table(spark, sf, "part").where(F.col("p_size") > 25).select(F.col("p_partkey").cast("int").alias("species_id")))
    return _named(store)


def q_rekey_store(spark, sf):
    store = _counts_by_flag(spark, sf)
    part = Q.table(spark, sf, "part").where(F.col("p_size") <= 25)
    store.rekey("b_species_id", part.select(F.col("p_partkey").cast("int").alias("species_id"), (-F.col("p_partkey") - 1).cast("int").alias("new_species_id")))
    return _named(store)


def q_concurrent_loads(spark, sf):
    """Two loaders that start at one version: even nations, then odd ones."""
    sites = Q._supplier_sites(spark, sf)
    detail = L.conform(Q.table(spark, sf, "nation").select(F.col("n_name").alias("bms_id"), "n_nationkey"), "bms_detail")
    keys = {r["n_name"]: r["n_nationkey"] for r in Q.table(spark, sf, "nation").collect()}  # scheme names (25 rows)
    root = P.init_model(spark, scratch_path(spark, "store")).root
    loaders = [P.Store(spark, root), P.Store(spark, root)]
    marks = [s.high_water("m_site") for s in loaders]  # both start here
    for odd, (store, mark) in enumerate(zip(loaders, marks, strict=True)):
        ids = [b for b, k in keys.items() if k % 2 == odd]
        mine = F.col("bms_id").isin(*ids)
        store.replace_schemes(ids, {"bms_detail": detail.where(mine), "m_site": L.site_dim(sites.where(mine), detail, None, mark)}, trusted_keys=True)
    return loaders[0].table("m_site").select("site_id", "bms_id", "bms_site_id")


def q_published_audit(spark, sf):
    return _loaded(spark, sf).audit().where("n > 0")


def q_export_roundtrip(spark, sf):
    """Sites and their points through a CSV snapshot and back."""
    store = _loaded(spark, sf, Q.SCHEME)
    path = scratch_path(spark, "snapshot")
    store.export_snapshot(path, "csv")
    read = lambda n: spark.read.option("header", True).schema(
        ", ".join(f"{f.name} {'string' if f.dataType.typeName() == 'struct' else f.dataType.simpleString()}" for f in store.table(n).schema)).csv(f"{path}/{n}")
    return read("m_site").join(read("m_site_geo").drop("bms_id"), "site_id").select(
        "site_id", "bms_id", "transect_id", "section_id", F.col("section_length").cast("double").alias("section_length"), "bms_site_id", "section_geom_true",
        F.col("centroid_geom").startswith("SRID=3035;POINT(").alias("is_point"))


def q_raw_roundtrip(spark, sf):
    """Orders as a raw CSV (S1), staged twice (K1: the second staging replaces the first), read back."""
    o = Q.table(spark, sf, "orders")
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "staging")
    o.select("o_orderkey", F.concat(F.lit('say "'), "o_orderpriority", F.lit('", twice')).alias("label"), "o_totalprice").write.option("header", True).option("escape", '"').csv(raw)
    read = read_raw(spark, raw, "o_orderkey long, label string, o_totalprice double")
    P.stage(read.where("o_orderkey < 0"), root, "visits")
    P.stage(read, root, "visits")
    return staged(spark, root, "visits").select("o_orderkey", "label", "o_totalprice")


def q_checklist_scan(spark, sf):
    """Parts as a checklist file of 31 columns, read by position."""
    part, path = Q.table(spark, sf, "part"), scratch_path(spark, "checklist")
    given = {2: F.col("p_name"), 3: F.concat_ws(",", "p_name", "p_brand"), 4: F.col("p_partkey").cast("string"), 14: F.when(F.col("p_size") > 25, "1").otherwise("0")}
    part.select(*[given.get(i, F.lit("")).alias(f"c{i}") for i in range(31)]).write.option("header", True).option("escape", '"').csv(path)
    return read_checklist(spark, path, None).select("Search_Name", "Accepted_Name", "Systematic_Order", "Aggregate", "Family")


def _unreadable(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Staging tables as text in which some values cannot be read, by kind."""
    s, o, li, part = (Q.table(spark, sf, n) for n in ("supplier", "orders", "lineitem", "part"))
    text = lambda c: F.col(c).cast("string")
    sites = s.select(
        text("s_nationkey").alias("bms_id"), F.when(F.col("s_nationkey") < 5, F.concat(F.lit("S"), "s_nationkey")).otherwise(text("s_suppkey")).alias("bms_site_id"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise(text("s_acctbal")).alias("section_length"),
        F.when(F.col("s_nationkey") == 24, F.lit("east")).alias("longitude"))
    visits = o.select(
        F.col("o_orderstatus").alias("bms_id"), F.when(F.col("o_orderstatus") == "P", F.lit("9999999999")).otherwise(text("o_orderkey")).alias("bms_visit_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("2023-13-45")).otherwise("2023-6-1").alias("visit_date"),
        F.when(F.col("o_totalprice") > 100000, F.lit("calm")).otherwise("3").alias("visit_wind"))
    counts = li.select(
        F.col("l_returnflag").alias("bms_id"), text("l_orderkey").alias("bms_visit_id"), F.when(F.col("l_linenumber") == 7, F.lit("x7")).otherwise(text("l_suppkey")).alias("bms_site_id"),
        F.when(F.col("l_quantity") > 45, F.lit("many")).otherwise(text("l_quantity")).alias("count"))
    path = scratch_path(spark, "checklist")
    given = {2: F.col("p_name"), 3: F.col("p_brand"), 4: F.when(F.col("p_size") > 45, F.concat(F.lit("no. "), "p_size")).otherwise(text("p_partkey")),
             14: F.when(F.col("p_size") < 3, F.lit("perhaps")).otherwise("1")}
    part.select(*[given.get(i, F.lit("")).alias(f"c{i}") for i in range(31)]).write.option("header", True).option("escape", '"').csv(path)
    frames = {"sites": sites, "visits": visits, "counts": counts}
    return {**{k: with_rejects(df, RULES[k]) for k, df in frames.items()}, "checklist": read_checklist(spark, path, None, rejects=True)}


def q_rejects_by_table(spark, sf):
    """What four staging tables hold that a load cannot read, each written once
    with its rejects, and the rows read back beside them."""
    out = None
    for kind, df in _unreadable(spark, sf).items():
        rows, bad = split(df, scratch_path(spark, kind))
        both = listed(bad, kind).unionByName(rows.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("tbl"), F.lit(None).cast("string").alias("bms_id"), F.lit("rows").alias("col"), F.lit(None).cast("string").alias("value"), "n"))
        out = both if out is None else out.unionByName(both)
    return out


def q_text_keys_load(spark, sf):
    """Counts whose keys came as text and partly cannot be read: what is published, by
    region and species, beside what is dropped."""
    detail = Q.schemes_from_regions(spark, sf)
    sites, visits = Q.sites_by_region(spark, sf), Q.visits_by_region(spark, sf)
    m_site = L.site_dim(sites, detail)
    m_visit = L.visit_fact(visits, L.recorder_dim(visits, detail), detail)
    counts = Q.counts_by_region(spark, sf)
    counts = counts.withColumn("bms_site_id", F.when(F.col("count") > 45, F.concat(F.lit("x"), "bms_site_id")).otherwise(F.col("bms_site_id").cast("string")))
    counts = counts.withColumn("bms_visit_id", F.col("bms_visit_id").cast("string"))
    kept = L.count_fact(counts, m_visit, m_site).groupBy("bms_id", "species_id").agg(F.count(F.lit(1)).alias("n"), F.sum("butterfly_count").alias("total"))
    lost = L.unmatched_counts(counts, m_visit, m_site).groupBy("bms_id").agg(F.count(F.lit(1)).alias("n"), F.sum("count").cast("long").alias("total"))
    return kept.unionByName(lost.withColumn("species_id", F.lit(None).cast("int")))


def q_scheme_rows(spark, sf):
    """Scheme parameter rows of all nations (S3)."""
    names = sorted(r["n_name"] for r in Q.table(spark, sf, "nation").collect())  # the load's parameters
    return scheme_detail(spark, [Scheme(n, n[:3], f"{n}'s", "x, y", "") for n in names])


def q_update_where(spark, sf):
    o = Q.table(spark, sf, "orders")
    return R.update_where(o, "o_orderpriority", F.concat(F.lit("done "), "o_orderpriority"), F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderpriority")


def q_point_guard(spark, sf):
    e = Q.table(spark, sf, "events")
    p = F.when(F.col("event_type") != "error", G.make_point("value", F.when(F.col("event_type") != "view", F.col("user_id").cast("double"))))
    wrong = F.when(F.col("event_type") == "click", p.withField("srid", F.lit(4326))).otherwise(p)
    half = F.when(F.col("event_type") == "signup", wrong.withField("y", F.lit(None).cast("double"))).otherwise(wrong)
    return e.select("event_id", F.coalesce(G.point_violation(half), F.lit(False)).alias("bad"))


def q_length_violations(spark, sf):
    o = Q.table(spark, sf, "orders").select("o_orderkey", F.repeat("o_orderpriority", 20).alias("note"), F.col("o_orderstatus").alias("code"))
    return quality.length_violations(o, ["note", "code"]).select("o_orderkey")


def q_column_statistics(spark, sf):
    o = Q.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("late"))
    return P.collect_statistics(o)


STORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_all_counts": q_load_all_counts,
    "load_scheme_counts": q_load_scheme_counts,
    "species_delete": q_species_delete,
    "rekey_store": q_rekey_store,
    "concurrent_loads": q_concurrent_loads,
    "published_audit": q_published_audit,
    "export_roundtrip": q_export_roundtrip,
    "raw_roundtrip": q_raw_roundtrip,
    "checklist_scan": q_checklist_scan,
    "rejects_by_table": q_rejects_by_table,
    "text_keys_load": q_text_keys_load,
    "scheme_rows": q_scheme_rows,
    "update_where": q_update_where,
    "point_guard": q_point_guard,
    "length_violations": q_length_violations,
    "column_statistics": q_column_statistics,
}

#: Sites, recorders, visits and counts of the regions in {where}, numbered as a load numbers them.
_LOAD = """
        WITH sr AS (SELECT s.*, r_name, n_name FROM supplier s JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        ob AS (SELECT o.*, r_name, n_name FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey),
        site AS (SELECT row_number() OVER (ORDER BY r_name || '.' || n_name, s_name, s_suppkey) AS site_id, * FROM sr {where}),
        recorder AS (SELECT row_number() OVER (ORDER BY r_name, o_custkey) AS recorder_id, r_name, o_custkey
                     FROM (SELECT DISTINCT r_name, o_custkey FROM ob {where})),
        visit AS (SELECT row_number() OVER (ORDER BY r_name, o_orderkey) AS visit_id, * FROM ob {where}),
        cnt AS (SELECT row_number() OVER (ORDER BY site_id, visit_id, l_partkey, round_even(l_quantity, 0)) AS count_id, v.r_name, visit_id, site_id,
                       CAST(l_partkey AS INTEGER) AS species_id, CAST(round_even(l_quantity, 0) AS INTEGER) AS butterfly_count
                FROM lineitem JOIN visit v ON v.o_orderkey = l_orderkey JOIN site s ON s.s_suppkey = l_suppkey AND s.r_name = v.r_name)
"""
_ALL, _ONE = _LOAD.format(where=""), _LOAD.format(where="WHERE r_name = 'EUROPE'")

_BY_FLAG = """
        SELECT 'b_count' AS tbl, l_returnflag AS bms_id, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, CAST({li} AS INTEGER) AS species_id
        FROM lineitem JOIN part ON l_partkey = p_partkey {where}
        UNION ALL SELECT 'b_species_id', NULL, p_name || ' ' || p_partkey, CAST({part} AS INTEGER) FROM part {where}
        UNION ALL SELECT 'species_thesaurus', NULL, p_brand || '/' || p_partkey, CAST({part} AS INTEGER) FROM part {where}"""
_NEW = "CASE WHEN p_size <= 25 THEN -p_partkey - 1 ELSE p_partkey END"

STORE_ORACLE: dict[str, str] = {
    "load_all_counts": _ALL + "SELECT count_id, r_name AS bms_id, visit_id, site_id, species_id, butterfly_count FROM cnt",
    "load_scheme_counts": _ONE + """
        SELECT count_id, c.visit_id, c.site_id, recorder_id, species_id, butterfly_count, CAST(v.o_orderkey AS INTEGER) AS bms_visit_id,
               CAST(s_suppkey AS INTEGER) AS bms_site_id, CAST(v.o_custkey AS VARCHAR) AS bms_observer_id, s_name AS section_id,
               'EUROPE.' || v.n_name AS transect_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS visit_date,
               s_acctbal > 5000 AS section_geom_true, CAST(s_nationkey AS DOUBLE) AS x, s_acctbal AS y, 'Europe' AS country_name
        FROM cnt c JOIN visit v USING (visit_id) JOIN site s USING (site_id) JOIN recorder r ON r.r_name = v.r_name AND r.o_custkey = v.o_custkey""",
    "species_delete": _BY_FLAG.format(li="l_partkey", part="p_partkey", where="WHERE p_size <= 25"),
    "rekey_store": _BY_FLAG.format(li=_NEW, part=_NEW, where=""),
    "concurrent_loads": """
        WITH st AS (SELECT n_nationkey % 2 AS odd, n_name AS bms_id, s_suppkey, row_number() OVER (PARTITION BY n_nationkey % 2
                           ORDER BY n_name || '.' || CAST(s_nationkey AS VARCHAR), s_name, s_suppkey) AS nth
                    FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        SELECT nth + CASE WHEN odd = 1 THEN (SELECT count(*) FROM st WHERE odd = 0) ELSE 0 END AS site_id, bms_id,
               CAST(s_suppkey AS INTEGER) AS bms_site_id
        FROM st""",
    "published_audit": _ALL + """
        SELECT 'b_species_id' AS tbl, NULL AS bms_id, count(*) AS n FROM part
        UNION ALL SELECT 'bms_detail', r_name, 1 FROM region
        UNION ALL SELECT 'm_site', r_name, count(*) FROM site GROUP BY r_name
        UNION ALL SELECT 'm_site_geo', r_name, count(*) FROM site GROUP BY r_name
        UNION ALL SELECT 'b_recorder', r_name, count(*) FROM recorder GROUP BY r_name
        UNION ALL SELECT 'm_visit', r_name, count(*) FROM visit GROUP BY r_name
        UNION ALL SELECT 'b_count', r_name, count(*) FROM cnt GROUP BY r_name""",
    "export_roundtrip": _ONE + """
        SELECT site_id, r_name AS bms_id, r_name || '.' || n_name AS transect_id, s_name AS section_id,
               CAST(CAST(s_acctbal AS DECIMAL(20,6)) AS DOUBLE) AS section_length, CAST(s_suppkey AS INTEGER) AS bms_site_id,
               s_acctbal > 5000 AS section_geom_true, true AS is_point
        FROM site""",
    "raw_roundtrip": "SELECT o_orderkey, 'say \"' || o_orderpriority || '\", twice' AS label, o_totalprice FROM orders",
    "checklist_scan": """
        SELECT p_name AS "Search_Name", p_name || ',' || p_brand AS "Accepted_Name", CAST(p_partkey AS INTEGER) AS "Systematic_Order",
               p_size > 25 AS "Aggregate", CAST(NULL AS VARCHAR) AS "Family"
        FROM part""",
    "rejects_by_table": """
        WITH bad AS (
          SELECT 'sites' AS tbl, CAST(s_nationkey AS VARCHAR) AS bms_id, 'bms_site_id' AS col, 'S' || s_nationkey AS value FROM supplier WHERE s_nationkey < 5
          UNION ALL SELECT 'sites', CAST(s_nationkey AS VARCHAR), 'section_length', 'n/a' FROM supplier WHERE s_acctbal < 0
          UNION ALL SELECT 'sites', CAST(s_nationkey AS VARCHAR), 'longitude', 'east' FROM supplier WHERE s_nationkey = 24
          UNION ALL SELECT 'visits', o_orderstatus, 'bms_visit_id', '9999999999' FROM orders WHERE o_orderstatus = 'P'
          UNION ALL SELECT 'visits', o_orderstatus, 'visit_date', '2023-13-45' FROM orders WHERE o_orderpriority = '5-LOW'
          UNION ALL SELECT 'visits', o_orderstatus, 'visit_wind', 'calm' FROM orders WHERE o_totalprice > 100000
          UNION ALL SELECT 'counts', l_returnflag, 'bms_site_id', 'x7' FROM lineitem WHERE l_linenumber = 7
          UNION ALL SELECT 'counts', l_returnflag, 'count', 'many' FROM lineitem WHERE l_quantity > 45
          UNION ALL SELECT 'checklist', NULL, 'Systematic_Order', 'no. ' || p_size FROM part WHERE p_size > 45
          UNION ALL SELECT 'checklist', NULL, 'Aggregate', 'perhaps' FROM part WHERE p_size < 3)
        SELECT tbl, bms_id, col, value, count(*) AS n FROM bad GROUP BY ALL
        UNION ALL SELECT 'sites', NULL, 'rows', NULL, count(*) FROM supplier
        UNION ALL SELECT 'visits', NULL, 'rows', NULL, count(*) FROM orders
        UNION ALL SELECT 'counts', NULL, 'rows', NULL, count(*) FROM lineitem
        UNION ALL SELECT 'checklist', NULL, 'rows', NULL, count(*) FROM part""",
    "text_keys_load": _ALL + """
        SELECT r_name AS bms_id, species_id, count(*) AS n, CAST(sum(butterfly_count) AS BIGINT) AS total FROM cnt WHERE butterfly_count <= 45 GROUP BY ALL
        UNION ALL
        SELECT r_name, NULL, count(*), CAST(sum(l_quantity) AS BIGINT)
        FROM (SELECT ob.r_name, l_quantity, l_quantity <= 45 AND EXISTS (SELECT 1 FROM sr WHERE sr.s_suppkey = l_suppkey AND sr.r_name = ob.r_name) AS met
              FROM lineitem JOIN ob ON ob.o_orderkey = l_orderkey)
        WHERE NOT met GROUP BY ALL""",
    "scheme_rows": """
        SELECT n_name AS bms_id, left(n_name, 3) AS country_iso3, n_name || '''s' AS country_name, 'x, y' AS contact_name, '' AS contact_email
        FROM nation""",
    "update_where": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done ' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "point_guard": "SELECT event_id, event_type IN ('click', 'signup') AS bad FROM events",
    "length_violations": "SELECT o_orderkey FROM orders WHERE length(o_orderpriority) * 20 > 255 OR length(o_orderstatus) > 255",
    "column_statistics": """
        SELECT 'o_orderkey' AS "column", count(*) AS rows, count(*) - count(o_orderkey) AS nulls, CAST(min(o_orderkey) AS VARCHAR) AS min,
               CAST(max(o_orderkey) AS VARCHAR) AS max FROM orders
        UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders
        UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders
        UNION ALL SELECT 'late', count(*), count(*) FILTER (WHERE o_orderstatus = 'F' OR o_orderpriority IS NULL),
               min(o_orderpriority) FILTER (WHERE o_orderstatus <> 'F'), max(o_orderpriority) FILTER (WHERE o_orderstatus <> 'F') FROM orders""",
}
