"""Composite load operators (C1-C10): checklist to species table, name
resolution, visit cleaning, the dimension and fact builders, and the load of
one scheme or of many schemes in one job.

Every builder works on staging frames that carry ``bms_id`` (many schemes at
once) or takes ``scheme_id`` (one scheme, the id becomes a literal). Keys are
scoped by scheme in every join, so one plan serves one scheme or all.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.functions.geometry import make_point
from wingspan.functions.scalars import (
    assign_int,
    clock_to_minute,
    fill_missing,
    normalise_clock,
    parse_bool,
    parse_date,
    qualify,
    section_flag,
)
from wingspan.operators.keys import _orderable, assign_ids
from wingspan.operators.relational import (
    add_column_if_absent,
    attach_scheme,
    distinct_on,
    drop_if_present,
    keep_first,
    merge_left,
    update_from,
)
from wingspan.plans.model import MODEL


def conform(df: DataFrame, table: str) -> DataFrame:
    """K2/K3: the model table's columns, in order and type; absent columns are
    NULL (the sequence column included when not yet assigned). Extra columns,
    ``bms_id`` for tables that have none, are kept after them."""
    spec = MODEL[table]
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields]
    extra = [c for c in df.columns if c not in spec.schema.names and c == "bms_id"]
    return df.select(*cols, *extra)


def by_position(df: DataFrame, table: str) -> DataFrame:
    """K3: ``INSERT INTO t SELECT ...`` without a column list: by position."""
    spec = MODEL[table]
    names = spec.schema.names[: len(df.columns)]
    return conform(df.toDF(*names), table)


DIM_BROADCAST_ROWS = 2_000_000
DIM_BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = DIM_BROADCAST_ROWS, max_bytes: int = DIM_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a (narrow) dimension only after measuring it: at most ``max_rows`` rows
    (``spark.wingspan.dimBroadcastRows``) and ``max_bytes`` bytes of values
    (``spark.wingspan.dimBroadcastBytes``; text by its length, others 8 bytes, 8 more a
    column and 16 a row for the row's layout). Beyond that the planner's shuffle join
    (with AQE skew splitting) takes over. Without text columns this is a count, which
    for a frame read back from the checkpoint folder costs only file metadata."""
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.wingspan.dimBroadcastRows", str(max_rows)))
    most = int(conf.get("spark.wingspan.dimBroadcastBytes", str(max_bytes)))
    fixed = 16 + 16 * len(df.columns)
    text = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, t in df.dtypes if t in ("string", "binary")]
    n, size = df.agg(F.count(F.lit(1)), F.sum(sum(text, F.lit(0))) if text else F.lit(0)).first()
    return F.broadcast(df) if n <= rows and n * fixed + (size or 0) <= most else df


# --- C1 -----------------------------------------------------------------------
def species_reference(checklist: DataFrame) -> DataFrame:
    """The species table from the checklist: distinct (order, accepted
    name, aggregate), by position into ``b_species_id``. Uniqueness of id and
    name is checked with ``key_violations`` before publishing."""
    sel = checklist.select(
        F.col("Systematic_Order").alias("species_id"),
        F.col("Accepted_Name").alias("species_acpt_sci_name"),
        F.col("Aggregate").alias("aggregate"),
    ).distinct()
    return by_position(sel, "b_species_id")


# --- C2 -----------------------------------------------------------------------
def resolve_species(counts: DataFrame, checklist: DataFrame, name_col: str = "sci_name",
                    ordinal: str = "_ordinal") -> DataFrame:
    """First checklist row per search name (file order), then a left merge
    of the counts on the name in which a missing name matches a missing name.
    Adds ``Accepted_Name`` and ``species_id`` (the systematic order)."""
    k = keep_first(checklist, "Search_Name", ordinal).select(
        "Search_Name", "Accepted_Name", F.col("Systematic_Order").alias("species_id"))
    base = counts.drop("species_id", "Accepted_Name")
    return merge_left(base, broadcast_if_small(k), [(name_col, "Search_Name")])


def unknown_species(counts: DataFrame, name_col: str = "sci_name") -> DataFrame:
    """Names of resolved counts (C2) that led to no species, ``(bms_id, sci_name, n)``:
    their counts are published without a species."""
    left = counts.where(F.col(name_col).isNotNull() & F.col("species_id").isNull())
    return left.groupBy("bms_id", F.col(name_col).alias("sci_name")).agg(F.count(F.lit(1)).alias("n"))


def load_rejects(visits: DataFrame) -> DataFrame:
    """F8: visit values that a load cannot read and publishes as NULL,
    ``(bms_id, col, value, n)``; the source system stops at the first one.
    ``visits`` are cleaned (C3). One scan, hash-aggregated by value."""
    read = {"visit_date": parse_date, "start_time": clock_to_minute, "end_time": clock_to_minute, "completed": parse_bool}
    tried = [F.when(F.col(c).isNotNull() & f(c).isNull(), F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")))
             for c, f in read.items() if c in visits.columns]
    bad = visits.select("bms_id", F.explode(F.array_compact(F.array(*tried))).alias("r")).select("bms_id", "r.col", "r.value")
    return bad.groupBy("bms_id", "col", "value").agg(F.count(F.lit(1)).alias("n"))


# --- C3 -----------------------------------------------------------------------
def clean_visits(visits: DataFrame) -> DataFrame:
    """Clock strings normalised, missing recorder code set to the sentinel,
    and the observer id taken from the filled recorder code."""
    out = visits
    for c in ("start_time", "end_time"):
        if c in out.columns:
            out = out.withColumn(c, normalise_clock(c))
    if "recorder_code" in out.columns:
        out = out.withColumn("recorder_code", fill_missing("recorder_code"))
        out = out.withColumn("bms_observer_id", F.col("recorder_code"))
    return out


# --- C4 -----------------------------------------------------------------------
def site_dim(sites: DataFrame, schemes: DataFrame, scheme_id: str | None = None,
             start: int | Column = 0) -> DataFrame:
    """C4: ``m_site``: sites under their scheme, transect id qualified by the
    scheme, distinct, numbered by (transect_id, section_id, bms_site_id, ...)."""
    s = attach_scheme(sites, schemes, scheme_id)

    def opt(name: str) -> Column:
        return F.col(name) if name in s.columns else F.lit(None)

    # DISTINCT on the staging values, as the source does, and only then the
    # assignment casts of the insert: values that differ in staging but cast
    # to the same model value stay separate rows.
    raw = s.select(
        F.col("bms_id"),
        qualify("bms_id", "transect_id").alias("transect_id"),
        opt("transect_length").alias("transect_length"),
        opt("section_id").alias("section_id"),
        opt("section_length").alias("section_length"),
        opt("section_transect_length_equal").alias("section_transect_length_equal"),
        opt("monitoring_type").alias("monitoring_type"),
        opt("site_info_quality").alias("site_info_quality"),
        F.col("bms_site_id"),
    ).distinct()
    d = raw.select(
        "bms_id", "transect_id",
        F.col("transect_length").try_cast(MODEL["m_site"].schema["transect_length"].dataType).alias("transect_length"),
        F.col("section_id").cast("string").alias("section_id"),
        F.col("section_length").try_cast(MODEL["m_site"].schema["section_length"].dataType).alias("section_length"),
        F.col("section_transect_length_equal").try_cast("boolean").alias("section_transect_length_equal"),
        F.col("monitoring_type").cast("string").alias("monitoring_type"),
        assign_int(F.col("site_info_quality")).alias("site_info_quality"),
        assign_int(F.col("bms_site_id")).alias("bms_site_id"),
        F.col("section_id").alias("__ord_section"),
    )
    ids = assign_ids(d, ["transect_id", "__ord_section", "bms_site_id"], "site_id", start)
    return conform(ids, "m_site")


# --- C5 -----------------------------------------------------------------------
def recorder_dim(visits: DataFrame, schemes: DataFrame, scheme_id: str | None = None,
                 start: int | Column = 0) -> DataFrame:
    """``b_recorder``: distinct observers per scheme, numbered in the
    observer's source order (a NULL observer is a recorder too, numbered last)."""
    v = attach_scheme(visits, schemes, scheme_id)
    d = v.select("bms_id", "bms_observer_id").distinct()
    ids = assign_ids(d, ["bms_id", "bms_observer_id"], "recorder_id", start)
    return conform(ids, "b_recorder")


# --- C6 -----------------------------------------------------------------------
def visit_fact(visits: DataFrame, recorders: DataFrame, schemes: DataFrame, scheme_id: str | None = None,
               start: int | Column = 0) -> DataFrame:
    """``m_visit``.

    First row per (scheme, bms_visit_id) by observer (NULLs last; remaining
    columns break ties), the recorder looked up on the observer read as an
    integer (so ``07`` and ``7`` meet), dates and clock times parsed, numbers
    rounded into int, the completion flag parsed, then numbered by
    (bms_visit_id, raw date, raw transect).
    """
    v = attach_scheme(visits, schemes, scheme_id)
    rest = [f.name for f in v.schema.fields
            if f.name not in ("bms_id", "bms_visit_id", "bms_observer_id") and _orderable(f.dataType)]
    first = distinct_on(v, ["bms_id", "bms_visit_id"], ["bms_observer_id"], tiebreak=rest)
    r = recorders
    if scheme_id is not None:
        r = r.where(F.col("bms_id") == F.lit(scheme_id))
    r = broadcast_if_small(r.select(F.col("bms_id").alias("__rb"), F.col("bms_observer_id").alias("__ro"),
                                    "recorder_id"))
    j = first.join(r, (first["bms_id"] == r["__rb"])
                   & (first["bms_observer_id"].try_cast("int") == r["__ro"].try_cast("int")), "left")

    def opt(name: str) -> Column:
        return F.col(name) if name in j.columns else F.lit(None)

    shaped = j.select(
        assign_int(F.col("bms_visit_id")).alias("bms_visit_id"),
        F.col("bms_id"),
        F.col("recorder_id"),
        qualify("bms_id", "transect_id").alias("transect_id"),
        parse_date(opt("visit_date")).alias("visit_date"),
        clock_to_minute(opt("start_time")).alias("visit_start"),
        clock_to_minute(opt("end_time")).alias("visit_end"),
        assign_int(opt("visit_cloud")).alias("visit_cloud"),
        assign_int(opt("visit_wind")).alias("visit_wind"),
        parse_bool(opt("completed")).alias("completed"),
        F.col("bms_visit_id").alias("__ord_visit"),
        opt("visit_date").cast("string").alias("__ord_date"),
        opt("transect_id").cast("string").alias("__ord_transect"),
    )
    ids = assign_ids(shaped, ["bms_id", "__ord_visit", "__ord_date", "__ord_transect"], "visit_id", start)
    return conform(ids, "m_visit")


# --- C7 -----------------------------------------------------------------------
def read_text_keys(df: DataFrame, names: list[str], read=lambda c: F.col(c).try_cast("int")) -> DataFrame:
    """Staging keys that came as text, read as integers (NULL if they are none, see
    ``sources.rejects``); keys of other types stay."""
    return df.withColumns({c: read(c) for c in names if dict(df.dtypes)[c] == "string"})


def count_fact(counts: DataFrame, visits: DataFrame, sites: DataFrame, scheme_id: str | None = None,
               start: int | Column = 0) -> DataFrame:
    """``b_count``: counts joined to their visit and site within the
    scheme (inner joins: a count with no visit or site is dropped and shows
    in the audit), count rounded into int, numbered by (site, visit, species).

    The count-visit join is the one large shuffle; it is keyed on
    (bms_id, bms_visit_id) and AQE splits a skewed visit partition.
    """
    if scheme_id is not None:
        visits = visits.where(F.col("bms_id") == F.lit(scheme_id))
        sites = sites.where(F.col("bms_id") == F.lit(scheme_id))
        if "bms_id" not in counts.columns:
            counts = counts.withColumn("bms_id", F.lit(scheme_id))
    counts = read_text_keys(counts, ["bms_visit_id", "bms_site_id"])
    v = visits.select(F.col("bms_id").alias("__vb"), F.col("bms_visit_id").alias("__vk"), "visit_id")
    s = broadcast_if_small(sites.select(F.col("bms_id").alias("__sb"), F.col("bms_site_id").alias("__sk"),
                                        "site_id"))
    j = counts.join(v, (counts["bms_id"] == v["__vb"]) & (counts["bms_visit_id"] == v["__vk"]))
    j = j.join(s, (j["bms_id"] == s["__sb"]) & (j["bms_site_id"] == s["__sk"]))
    shaped = j.select(
        "bms_id", "visit_id", "site_id",
        F.col("species_id").try_cast("int").alias("species_id"),
        assign_int(F.col("count")).alias("butterfly_count"),
    )
    ids = assign_ids(shaped, ["site_id", "visit_id", "species_id"], "count_id", start)
    return conform(ids, "b_count")


def unmatched_counts(counts: DataFrame, visits: DataFrame, sites: DataFrame) -> DataFrame:
    """Counts dropped by ``count_fact``'s inner joins (no visit, or a visit
    but no site), each staging row once."""
    counts = read_text_keys(counts, ["bms_visit_id", "bms_site_id"])
    v = visits.select(F.col("bms_id").alias("__vb"), F.col("bms_visit_id").alias("__vk"))
    s = sites.select(F.col("bms_id").alias("__sb"), F.col("bms_site_id").alias("__sk"))
    on_visit = (counts["bms_id"] == v["__vb"]) & (counts["bms_visit_id"] == v["__vk"])
    on_site = (counts["bms_id"] == s["__sb"]) & (counts["bms_site_id"] == s["__sk"])
    no_visit = counts.join(v, on_visit, "left_anti")
    # disjoint from no_visit: every dropped count appears once, duplicates kept
    no_site = counts.join(v, on_visit, "left_semi").join(s, on_site, "left_anti")
    return no_visit.unionByName(no_site)


# --- C8 -----------------------------------------------------------------------
def geo_dim(raw_sites: DataFrame, sites: DataFrame, scheme_id: str | None = None) -> DataFrame:
    """``m_site_geo``: the published site id set on the raw sites (smallest
    id when a scheme site id has several), the coordinates made a point in
    the model's SRID (not reprojected), the section flag from the geo level,
    then distinct (site_id, point, flag) per scheme."""
    g = raw_sites
    if scheme_id is not None:
        g = g.withColumn("bms_id", F.lit(scheme_id))
        sites = sites.where(F.col("bms_id") == F.lit(scheme_id))
    g = read_text_keys(add_column_if_absent(g, "site_id", "long"), ["bms_site_id"], assign_int)
    g = update_from(g, sites, [("bms_id", "bms_id"), ("bms_site_id", "bms_site_id")], {"site_id": "site_id"})
    g = drop_if_present(g, "centroid_geom").withColumn("centroid_geom", make_point("longitude", "latitude"))
    g = drop_if_present(g, "section_geom_true").withColumn("section_geom_true", section_flag("geo_info_level"))
    out = g.select("bms_id", "site_id", "centroid_geom", "section_geom_true").distinct()
    return conform(out, "m_site_geo")


# --- C9 / C10 -----------------------------------------------------------------
def together(*steps):
    """Run independent builder steps side by side.

    The dimension builders run Spark jobs while they are built (range
    sampling, the checkpoint write of ``assign_ids``); independent ones are
    submitted from separate driver threads so the scheduler overlaps their
    jobs. Results come back in the order given.
    """
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        # inheritable targets carry the caller's job group and local properties
        session = SparkSession.getActiveSession()
        wrap = inheritable_thread_target(session) if session is not None else inheritable_thread_target
        futures = [pool.submit(copy_context().run, wrap(step)) for step in steps]  # and its scratch scope
        return [f.result() for f in futures]



@dataclass
class SchemeSources:
    """Staging frames of one or many schemes (each with ``bms_id`` for many)."""

    sites: DataFrame
    visits: DataFrame
    counts: DataFrame


def load_tables(schemes: DataFrame, src: SchemeSources, scheme_id: str | None = None,
                starts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """C9 (one scheme, ``scheme_id`` given) or C10 (every scheme in
    ``schemes``, staging frames carrying ``bms_id``): every published table of
    the load, in dependency order. ``starts`` are the sequences' marks."""
    starts = starts or {}
    detail = schemes if scheme_id is None else schemes.where(F.col("bms_id") == F.lit(scheme_id))
    m_site, b_recorder = together(
        lambda: site_dim(src.sites, schemes, scheme_id, starts.get("m_site", 0)),
        lambda: recorder_dim(src.visits, schemes, scheme_id, starts.get("b_recorder", 0)),
    )
    m_visit = visit_fact(src.visits, b_recorder, schemes, scheme_id, starts.get("m_visit", 0))
    b_count = count_fact(src.counts, m_visit, m_site, scheme_id, starts.get("b_count", 0))
    m_site_geo = geo_dim(src.sites, m_site, scheme_id)
    return {
        "bms_detail": conform(detail, "bms_detail"),
        "m_site": m_site,
        "b_recorder": b_recorder,
        "m_visit": m_visit,
        "b_count": b_count,
        "m_site_geo": m_site_geo,
    }


# --- U1 -----------------------------------------------------------------------
def append_schemes(frames: list[DataFrame], table: str) -> DataFrame:
    """Bag union of several schemes' rows into one model table, in one job:
    each frame conformed to the table (absent columns NULL), then unioned by name."""
    out = None
    for df in frames:
        c = conform(df, table)
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    return out
