"""Registered queries: every operator of the load run on the driver tables.

The driver tables stand in for the survey tables: a scheme is a ``region``
(or a ``nation``), a site is a ``supplier``, a recorder is a ``customer``, a
visit is an ``orders`` row, a count is a ``lineitem`` row and the species
checklist is ``part``; text columns for the cleaning rules are derived from
``events``. Missing parents and NULL values are made inside the query from
data columns (filtered parents, ``CASE``), never by sampling rows.

Each query reads whole tables and goes through the package's operators; the
matching DuckDB SQL in ``ORACLE`` states the same result independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.functions import geometry as G
from wingspan.functions import scalars as X
from wingspan.operators import graph, keys, quality, relational as R
from wingspan.plans import load as L
from wingspan.plans import publish as P
from wingspan.session import scratch_path

SCHEME = "EUROPE"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# --- stand-in staging frames --------------------------------------------------
def schemes_from_regions(spark: SparkSession, sf: str) -> DataFrame:
    """bms_detail rows: one scheme per region."""
    r = table(spark, sf, "region")
    return L.conform(r.select(
        F.col("r_name").alias("bms_id"),
        F.upper(F.left("r_name", F.lit(3))).alias("country_iso3"),
        F.initcap("r_name").alias("country_name"),
        F.concat(F.lit("contact "), F.col("r_regionkey").cast("string")).alias("contact_name"),
        F.concat(F.lower("r_name"), F.lit("@example.org")).alias("contact_email"),
    ), "bms_detail")


def sites_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Site staging of every region: one section per supplier, one transect per nation."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("r_name").alias("bms_id"), F.col("n_name").alias("transect_id"), F.col("s_name").alias("section_id"),
        F.col("s_suppkey").alias("bms_site_id"), F.col("s_acctbal").alias("section_length"),
        F.when(F.col("s_acctbal") < 0, F.lit("2")).otherwise(F.lit("31")).alias("monitoring_type"),
        F.col("s_nationkey").alias("longitude"), F.col("s_acctbal").alias("latitude"),
        F.when(F.col("s_acctbal") > 5000, F.lit("section_centroid")).otherwise(F.lit("transect_centroid"))
        .alias("geo_info_level"),
    )


def visits_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Visit staging of every region: one visit per order, observer = customer."""
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(
        r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("r_name").alias("bms_id"), F.col("o_orderkey").alias("bms_visit_id"),
        F.col("o_custkey").alias("bms_observer_id"), F.col("n_name").alias("transect_id"),
        F.date_format("o_orderdate", "yyyy-M-d").alias("visit_date"),
        (F.col("o_totalprice") / 5000.0).alias("visit_cloud"),
        F.when(F.col("o_orderstatus") == "F", F.lit("1")).when(F.col("o_orderstatus") == "O", F.lit("0"))
        .alias("completed"),
    )


def counts_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Count staging of every region: one count per line item, under its order's region."""
    li = table(spark, sf, "lineitem")
    v = visits_by_region(spark, sf).select(F.col("bms_id"), F.col("bms_visit_id").alias("__o"))
    j = li.join(v, li.l_orderkey == v["__o"])
    return j.select(
        "bms_id", F.col("l_orderkey").alias("bms_visit_id"), F.col("l_suppkey").alias("bms_site_id"),
        F.col("l_partkey").alias("species_id"), F.col("l_quantity").alias("count"),
    )


# --- queries --------------------------------------------------------------------
def q_species_reference(spark, sf):
    part = table(spark, sf, "part")
    checklist = part.select(F.col("p_partkey").alias("Systematic_Order"), F.col("p_name").alias("Accepted_Name"),
                            (F.col("p_size") > 25).alias("Aggregate"))
    return L.species_reference(checklist)


def q_keep_first(spark, sf):
    part = R.with_ordinal(table(spark, sf, "part"))
    return R.keep_first(part, "p_name", "_ordinal").select("p_name", "p_partkey", "p_brand")


def _checklist_from_part(spark, sf):
    part = R.with_ordinal(table(spark, sf, "part"))
    return part.select(F.nullif(F.col("p_name"), F.lit("cold widget")).alias("Search_Name"),
                       F.col("p_name").alias("Accepted_Name"), F.col("p_partkey").alias("Systematic_Order"),
                       "_ordinal")


def q_merge_checklist(spark, sf):
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    counts = li.join(part.select("p_partkey", "p_name"), li.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif(F.col("p_name"), F.lit("cold widget")).alias("sci_name"))
    out = L.resolve_species(counts, _checklist_from_part(spark, sf), "sci_name")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "species_id")


def q_fill_missing(spark, sf):
    o = table(spark, sf, "orders")
    staged = o.select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
                      .alias("recorder_code"))
    return L.clean_visits(staged).select("o_orderkey", "recorder_code", "bms_observer_id")


def q_distinct_on(spark, sf):
    o = table(spark, sf, "orders")
    return R.distinct_on(o, ["o_custkey"], ["o_orderdate"], tiebreak=["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


def q_site_dim(spark, sf):
    m = L.site_dim(sites_by_region(spark, sf), schemes_from_regions(spark, sf))
    return m.select("site_id", "bms_id", "transect_id", "section_id", "bms_site_id",
                    F.col("section_length").cast("double").alias("section_length"), "monitoring_type")


def q_recorder_dim(spark, sf):
    o = table(spark, sf, "orders")
    visits = o.select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("bms_observer_id"))
    return L.recorder_dim(visits, schemes_from_regions(spark, sf), SCHEME)


def _visit_staging(o: DataFrame) -> DataFrame:
    return o.select(
        F.col("o_custkey").alias("bms_visit_id"), F.col("o_orderkey").alias("bms_observer_id"),
        F.col("o_orderpriority").alias("transect_id"),
        F.date_format("o_orderdate", "yyyy-M-d").alias("visit_date"),
        (F.col("o_totalprice") / 5000.0).alias("visit_cloud"),
        F.when(F.col("o_orderstatus") == "F", F.lit("1")).when(F.col("o_orderstatus") == "O", F.lit(" Off "))
        .alias("completed"),
    )


def q_visit_fact(spark, sf):
    o = table(spark, sf, "orders")
    detail = schemes_from_regions(spark, sf)
    staging = _visit_staging(o)
    recorders = L.recorder_dim(_visit_staging(o.where(F.col("o_orderpriority") != "5-LOW")), detail, SCHEME)
    m = L.visit_fact(staging, recorders, detail, SCHEME)
    return m.select("visit_id", "bms_visit_id", "recorder_id", "bms_id", "transect_id",
                    F.col("visit_date").cast("string").alias("visit_date"), "completed", "visit_cloud")


def _one_scheme_load(spark, sf):
    # every supplier and order is loaded; those whose id is negated are parents that no count names
    detail = schemes_from_regions(spark, sf)
    s, o = table(spark, sf, "supplier"), table(spark, sf, "orders")
    site = F.when(F.col("s_nationkey") < 10, F.col("s_suppkey")).otherwise(-F.col("s_suppkey"))
    sites = s.select(F.col("s_nationkey").alias("transect_id"), F.col("s_name").alias("section_id"), site.alias("bms_site_id"))
    visit = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))
    visits = o.select(visit.alias("bms_visit_id"), F.col("o_custkey").alias("bms_observer_id"), F.lit("T").alias("transect_id"))
    li = table(spark, sf, "lineitem")
    counts = li.select(F.col("l_orderkey").alias("bms_visit_id"), F.col("l_suppkey").alias("bms_site_id"),
                       F.col("l_partkey").alias("species_id"), F.col("l_quantity").alias("count"))
    m_site, b_recorder = L.together(lambda: L.site_dim(sites, detail, SCHEME),
                                    lambda: L.recorder_dim(visits, detail, SCHEME))
    m_visit = L.visit_fact(visits, b_recorder, detail, SCHEME)
    return L.count_fact(counts, m_visit, m_site, SCHEME)


def q_count_fact(spark, sf):
    return _one_scheme_load(spark, sf).select("count_id", "visit_id", "site_id", "species_id", "butterfly_count")


def q_batch_number(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                             "l_extendedprice")
    ids = keys.assign_ids(li, ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], "rid")
    b = keys.batch_number(ids, "rid", 1000)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("l_suppkey").alias("first_site"))


def q_page(spark, sf):
    return R.page(table(spark, sf, "orders"), ["o_custkey", "o_orderkey"], 200, 100).select("o_orderkey", "o_custkey")


def q_delete_using(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    out = R.delete_using(li, o.where(F.col("o_orderpriority") == "5-LOW"), [("l_orderkey", "o_orderkey")])
    return out.select("l_orderkey", "l_linenumber", "l_quantity")


def q_delete_in(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    s = s.withColumn("s_nationkey", F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")))
    out = R.delete_in(s, n.where(F.col("n_regionkey") == 2), [("s_nationkey", "n_nationkey")])
    return out.select("s_suppkey", "s_name", "s_nationkey")


CASCADE_EDGES = [
    ("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
]


def q_cascade_delete(spark, sf):
    names = ["nation", "customer", "supplier", "orders", "lineitem"]
    tables = {t: table(spark, sf, t) for t in names}
    region = table(spark, sf, "region")
    gone = tables["nation"].join(region.where(F.col("r_name") == "ASIA"),
                                 F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select("n_nationkey")
    pk = {"nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey"}
    alive = graph.cascade_delete(tables, CASCADE_EDGES, pk, {"nation": gone})
    return P.load_audit({t: alive[t] for t in names}).select("tbl", "n")


def _supplier_sites(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("bms_id"), F.col("s_nationkey").alias("transect_id"),
        F.col("s_name").alias("section_id"), F.col("s_suppkey").alias("bms_site_id"), "s_acctbal")


def q_scheme_replace(spark, sf):
    sites = _supplier_sites(spark, sf)
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("bms_id"))
    detail = L.conform(nations, "bms_detail")
    store = P.Store(spark, scratch_path(spark, "store"))
    all_ids = [r["bms_id"] for r in nations.collect()]  # scheme names (25 rows): the load's parameter list
    store.replace_schemes(all_ids, {"bms_detail": detail, "m_site": L.site_dim(sites, detail)}, trusted_keys=True)
    reload = sites.where((F.col("bms_id") == "NATION_7") & (F.col("s_acctbal") >= 0))
    hw = store.high_water("m_site")
    store.replace_schemes(["NATION_7", "NATION_8"], {"m_site": L.site_dim(reload, detail, None, hw)},
                          trusted_keys=True)
    return store.table("m_site").select("site_id", "bms_id", "bms_site_id")


def q_species_replace(spark, sf):
    part = table(spark, sf, "part")
    store = P.Store(spark, scratch_path(spark, "store"))
    for aggregate in (F.col("p_size") > 25, F.col("p_size") <= 25):  # the second load replaces the first
        store.replace_schemes([], {"b_species_id": L.species_reference(part.select(
            F.col("p_partkey").alias("Systematic_Order"), F.concat_ws(" ", "p_name", "p_partkey").alias("Accepted_Name"),
            aggregate.alias("Aggregate")))})
    return store.table("b_species_id")


def q_store_refusal(spark, sf):
    """Counts offered to a store that has large parts as species, no visits and no sites."""
    part, li = table(spark, sf, "part"), table(spark, sf, "lineitem")
    store = P.Store(spark, scratch_path(spark, "store"))
    store.replace_schemes([], {"b_species_id": L.species_reference(part.where(F.col("p_size") > 25).select(
        F.col("p_partkey").alias("Systematic_Order"), F.concat_ws(" ", "p_name", "p_partkey").alias("Accepted_Name"),
        F.lit(False).alias("Aggregate")))})
    counts = L.conform(li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("count_id"), F.col("l_orderkey").alias("visit_id"),
                                 F.col("l_suppkey").alias("site_id"), F.col("l_partkey").alias("species_id"),
                                 F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("butterfly_count")), "b_count")
    return store.violations({"b_count": counts}).select("tbl", "check", "n")


def q_unknown_species(spark, sf):
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    counts = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_returnflag").alias("bms_id"), F.concat_ws(" ", "p_name", "p_size").alias("sci_name"))
    checklist = R.with_ordinal(part).where(F.col("p_size") > 25).select(
        F.concat_ws(" ", "p_name", "p_size").alias("Search_Name"), F.col("p_name").alias("Accepted_Name"),
        F.col("p_partkey").alias("Systematic_Order"), "_ordinal")
    return L.unknown_species(L.resolve_species(counts, checklist))


def q_load_rejects(spark, sf):
    o = table(spark, sf, "orders")
    visits = o.select(F.col("o_orderstatus").alias("bms_id"),
                      F.when(F.col("o_orderpriority") == "5-LOW", F.lit("2023-13-45")).otherwise("2023-6-1").alias("visit_date"),
                      F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("25:"), F.col("o_orderstatus"))).alias("start_time"),
                      F.lit("10:30").alias("end_time"),
                      F.when(F.col("o_totalprice") > 100000, F.lit("maybe")).otherwise("yes").alias("completed"))
    return L.load_rejects(visits)


def q_update_from(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    target = s.select("s_suppkey", "s_nationkey", F.col("s_name").alias("label"))
    out = R.update_from(target, n.where(F.col("n_regionkey") < 3), [("s_nationkey", "n_nationkey")],
                        {"label": "n_name"})
    return out.select("s_suppkey", "label")


def _levels(e: DataFrame) -> DataFrame:
    return e.withColumn("geo_info_level", F.when(F.col("event_type") == "view", F.lit("section_centroid"))
                        .when(F.col("event_type") == "click", F.lit("transect_centroid"))
                        .otherwise(F.col("event_type")))


def q_flag_by_level(spark, sf):
    e = _levels(table(spark, sf, "events"))
    return e.select("event_id", X.section_flag("geo_info_level").alias("section_geom_true"))


def _hh(c):
    return F.lpad(c.cast("string"), 2, "0")


def q_parse_time_lenient(spark, sf):
    e = table(spark, sf, "events")
    h, m, s = F.hour("ts"), F.minute("ts"), F.second("ts")
    et = F.col("event_type")
    v = (F.when(et == "view", F.concat(h.cast("string"), F.lit(":"), m.cast("string")))
         .when(et == "click", F.concat(h.cast("string"), F.lit("h"), _hh(m)))
         .when(et == "signup", F.concat(h.cast("string"), F.lit("."), _hh(m), F.lit(" uhr")))
         .when(et == "purchase", F.concat(h.cast("string"), F.lit(":"), _hh(m), F.lit(" - "),
                                          (h + 1).cast("string"), F.lit(":"), _hh(s)))
         .otherwise(F.col("props")))
    return e.select("event_id", X.try_cast_to_time(v).alias("tm"))


def q_extract_integer(spark, sf):
    e = table(spark, sf, "events")
    et = F.col("event_type")
    val = F.format_string("%.2f", F.col("value"))
    v = (F.when(et == "view", F.col("props"))
         .when(et == "click", val)
         .when(et == "signup", F.concat(F.translate(val, ".", ","), F.lit(" C")))
         .when(et == "error", F.concat(F.lit("-"), val))
         .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("event_id").cast("string"))))
    return e.select("event_id", X.try_extract_integer(v, 2).alias("i"))


def q_normalise_clock(spark, sf):
    e = table(spark, sf, "events")
    et = F.col("event_type")
    h, m, s = F.hour("ts").cast("string"), F.minute("ts").cast("string"), F.second("ts").cast("string")
    v = (F.when(et == "view", F.lit("0"))
         .when(et == "click", F.concat((F.hour("ts") + 1).cast("string"), F.lit(":"), m))
         .when(et == "signup", F.concat(h, F.lit(":"), m, F.lit(":"), s))
         .when(et == "purchase", F.lit("00:00")))
    return e.select("event_id", X.normalise_clock(v).alias("tm"))


def q_clock_to_minute(spark, sf):
    e = table(spark, sf, "events")
    et = F.col("event_type")
    v = (F.when(et == "error", F.lit("n/a"))
         .when(et == "view", F.concat(F.hour("ts").cast("string"), F.lit(":"), F.minute("ts").cast("string"),
                                      F.lit(" approx")))
         .otherwise(F.date_format("ts", "HH:mm:ss")))
    return e.select("event_id", X.clock_to_minute(v).alias("visit_start"))


def q_parse_date(spark, sf):
    o = table(spark, sf, "orders")
    y, mo, d = (F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"),
                F.dayofmonth("o_orderdate").cast("string"))
    p = F.col("o_orderpriority")
    v = (F.when(p == "5-LOW", F.concat(y, F.lit("-13-"), d))
         .when(p == "1-URGENT", F.concat(y, F.lit("-"), mo, F.lit("-"), d, F.lit(" 08:15")))
         .otherwise(F.concat(y, F.lit("-"), mo, F.lit("-"), d)))
    return o.select("o_orderkey", X.parse_date(v).cast("string").alias("visit_date"))


def q_parse_bool(spark, sf):
    e = table(spark, sf, "events")
    et = F.col("event_type")
    v = (F.when(et == "view", F.lit("yes")).when(et == "click", F.lit(" Off "))
         .when(et == "signup", F.lit("1")).when(et == "purchase", F.lit("maybe")))
    return e.select("event_id", X.parse_bool(v).alias("completed"))


def q_assign_int(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", X.assign_int(F.col("value")).alias("i"), X.assign_int(F.col("value") * 2).alias("j"))


def q_make_point(spark, sf):
    e = table(spark, sf, "events")
    y = F.when(F.col("event_type") != "error", F.col("value"))
    return e.select("event_id", G.ewkt(G.make_point(F.col("event_id"), y)).alias("geom"))


def q_fk_violations(spark, sf):
    li, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    v = quality.fk_violations(li, part.where(F.col("p_size") < 40), [("l_partkey", "p_partkey")])
    return v.select("l_orderkey", "l_linenumber", "l_partkey")


def q_key_violations(spark, sf):
    return quality.key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_domain_violations(spark, sf):
    e = table(spark, sf, "events").select(F.col("value").alias("visit_cloud"), F.hour("ts").alias("visit_wind"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("species_id"),
                                           (F.col("p_size") > 25).alias("aggregate"))
    sites = table(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") < 0, F.lit("3")).otherwise(F.lit("31")).alias("monitoring_type"),
        F.when(F.col("s_acctbal") < 5000, F.col("s_nationkey") % 5).alias("site_info_quality"))
    return (quality.domain_violations(e, quality.visit_domain_rules())
            .unionByName(quality.domain_violations(part, quality.species_domain_rules()))
            .unionByName(quality.domain_violations(sites, quality.site_domain_rules())))


def q_load_audit(spark, sf):
    src = L.SchemeSources(sites=sites_by_region(spark, sf), visits=visits_by_region(spark, sf),
                          counts=counts_by_region(spark, sf))
    tables = L.load_tables(schemes_from_regions(spark, sf), src)
    return P.load_audit(tables)


def q_section_length_check(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("transect_length", F.lit(60.0))
    return quality.section_length_check(li, ["l_orderkey"], "l_quantity", "transect_length")


def q_site_info_quality(spark, sf):
    e = _levels(table(spark, sf, "events"))
    sl = F.when(F.col("value") > 100, F.col("value"))
    return e.select("event_id", X.site_info_quality(sl, "geo_info_level", "user_id", "value").alias("q"))


def q_append_schemes(spark, sf):
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    a = s.select(F.lit("A").alias("bms_id"), F.col("s_suppkey").alias("bms_site_id"),
                 F.col("s_name").alias("transect_id"))
    b = c.select(F.lit("B").alias("bms_id"), F.col("c_custkey").alias("bms_site_id"),
                 F.col("c_name").alias("transect_id"))
    out = L.append_schemes([a, b], "m_site")
    return out.select("bms_id", "bms_site_id", "transect_id", F.col("site_area").cast("double").alias("site_area"))


def q_rekey_cascade(spark, sf):
    o = table(spark, sf, "orders")
    parent = o.select(F.col("o_orderpriority").alias("old")).distinct().where(F.col("old") >= "4")
    mapping = parent.withColumn("new", F.regexp_replace("old", r"^[0-9]+-", ""))
    return graph.rekey(o, "o_orderpriority", mapping).select("o_orderkey", "o_orderpriority")


def q_geo_dim(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    k = F.col("s_nationkey")
    raw = s.select(k.alias("bms_site_id"), (k * 1000).alias("longitude"),
                   F.when(k <= 20, k * 500).alias("latitude"),
                   F.when(k < 10, F.lit("section_centroid")).when(k < 20, F.lit("transect_centroid"))
                   .otherwise(F.lit("other")).alias("geo_info_level"))
    m1 = n.where(F.col("n_regionkey") < 4).select((F.col("n_nationkey") * 10).cast("long").alias("site_id"),
                                                  F.col("n_nationkey").alias("bms_site_id"))
    m2 = n.where(F.col("n_regionkey") == 0).select((F.col("n_nationkey") * 10 + 5).cast("long").alias("site_id"),
                                                   F.col("n_nationkey").alias("bms_site_id"))
    m_site = m1.unionByName(m2).withColumn("bms_id", F.lit(SCHEME))
    g = L.geo_dim(raw, m_site, SCHEME)
    return g.select("site_id", G.ewkt("centroid_geom").alias("centroid_geom"), "section_geom_true")


def _text_observer_visits(spark, sf):
    """Visits whose observer code is text; urgent orders write it with a leading
    zero, so one customer can appear as two codes that meet as one integer."""
    o = table(spark, sf, "orders")
    code = F.col("o_custkey").cast("string")
    return o.select(F.col("o_orderkey").alias("bms_visit_id"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("0"), code)).otherwise(code)
                    .alias("bms_observer_id"),
                    F.lit("T").alias("transect_id"), F.lit("2024-1-1").alias("visit_date"))


def q_observer_fanout(spark, sf):
    detail = schemes_from_regions(spark, sf)
    visits = _text_observer_visits(spark, sf)
    recorders = L.recorder_dim(visits, detail, SCHEME)
    m = L.visit_fact(visits, recorders, detail, SCHEME)
    return m.select("visit_id", "bms_visit_id", "recorder_id")


def q_dropped_counts(spark, sf):
    detail = schemes_from_regions(spark, sf)
    s = table(spark, sf, "supplier").where(F.col("s_nationkey") < 10)
    sites = s.select(F.col("s_nationkey").alias("transect_id"), F.col("s_name").alias("section_id"),
                     F.col("s_suppkey").alias("bms_site_id"))
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    visits = o.select(F.col("o_orderkey").alias("bms_visit_id"), F.col("o_custkey").alias("bms_observer_id"),
                      F.lit("T").alias("transect_id"))
    li = table(spark, sf, "lineitem")
    counts = li.select(F.lit(SCHEME).alias("bms_id"), F.col("l_orderkey").alias("bms_visit_id"),
                       F.col("l_suppkey").alias("bms_site_id"), F.col("l_partkey").alias("species_id"),
                       F.col("l_quantity").alias("count"))
    m_site, recorders = L.together(lambda: L.site_dim(sites, detail, SCHEME),
                                   lambda: L.recorder_dim(visits, detail, SCHEME))
    m_visit = L.visit_fact(visits, recorders, detail, SCHEME)
    return L.unmatched_counts(counts, m_visit, m_site)


def q_load_warnings(spark, sf):
    detail = schemes_from_regions(spark, sf)
    sites = sites_by_region(spark, sf)
    visits = _text_observer_visits(spark, sf)
    m_site, recorders = L.together(lambda: L.site_dim(sites, detail),
                                   lambda: L.recorder_dim(visits, detail, SCHEME))
    return quality.load_warnings(m_site, recorders, L.geo_dim(sites, m_site))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """One scheme loaded end to end, then counts per species (section 7.3)."""
    c = _one_scheme_load(spark, sf)
    return c.groupBy("species_id").agg(F.count(F.lit(1)).alias("n_counts"),
                                       F.sum("butterfly_count").alias("individuals"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "species_reference": q_species_reference,
    "keep_first": q_keep_first,
    "merge_checklist": q_merge_checklist,
    "fill_missing": q_fill_missing,
    "distinct_on": q_distinct_on,
    "site_dim": q_site_dim,
    "recorder_dim": q_recorder_dim,
    "visit_fact": q_visit_fact,
    "count_fact": q_count_fact,
    "batch_number": q_batch_number,
    "page": q_page,
    "delete_using": q_delete_using,
    "delete_in": q_delete_in,
    "cascade_delete": q_cascade_delete,
    "scheme_replace": q_scheme_replace,
    "species_replace": q_species_replace,
    "store_refusal": q_store_refusal,
    "unknown_species": q_unknown_species,
    "load_rejects": q_load_rejects,
    "update_from": q_update_from,
    "flag_by_level": q_flag_by_level,
    "parse_time_lenient": q_parse_time_lenient,
    "extract_integer": q_extract_integer,
    "normalise_clock": q_normalise_clock,
    "clock_to_minute": q_clock_to_minute,
    "parse_date": q_parse_date,
    "parse_bool": q_parse_bool,
    "assign_int": q_assign_int,
    "make_point": q_make_point,
    "fk_violations": q_fk_violations,
    "key_violations": q_key_violations,
    "domain_violations": q_domain_violations,
    "load_audit": q_load_audit,
    "section_length_check": q_section_length_check,
    "site_info_quality": q_site_info_quality,
    "append_schemes": q_append_schemes,
    "rekey_cascade": q_rekey_cascade,
    "geo_dim": q_geo_dim,
    "observer_fanout": q_observer_fanout,
    "dropped_counts": q_dropped_counts,
    "load_warnings": q_load_warnings,
}
