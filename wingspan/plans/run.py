"""One call per scheme (C9) or per delivery of many schemes (C10): raw CSV
files to the published store, with audit and warnings.

    read_raw (S1) -> clean_visits (C3) -> one staging write with the rejects (K1, F8) ->
    resolve_species (C2) ->
    site_dim / recorder_dim / visit_fact / count_fact / geo_dim (C4-C8) ->
    Store.replace_schemes (K5: checks, then publish) -> audit (A4)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.operators.quality import load_warnings
from wingspan.plans import load as L
from wingspan.plans.model import CHECKLIST
from wingspan.plans.publish import Store
from wingspan.session import scratch_path, scratch_scope
from wingspan.sources.readers import Scheme, read_raw, scheme_detail
from wingspan.sources.rejects import CORRUPT, REJECTS, RULES, listed, split, with_rejects


@dataclass(frozen=True)
class SchemeFiles:
    """Raw files of one scheme delivery (CSV with a header)."""

    sites: str
    visits: str
    counts: str


SEQUENCES = ("m_site", "b_recorder", "m_visit", "b_count")


@dataclass
class LoadReport:
    load_id: str
    audit: DataFrame  # rows published per table and scheme
    dropped_counts: DataFrame  # counts with no visit or no site
    warnings: DataFrame  # fan-out traps and suspicious values
    cascade: dict  # rows removed from children that were not reloaded
    unknown_species: DataFrame  # names without a species: (bms_id, sci_name, n)
    rejects: DataFrame  # malformed records and unreadable values: (tbl, bms_id, col, value, n)


def load_reference(store: Store, checklist: DataFrame, strict: bool = False) -> str:
    """Publish the checklist and the species table built from it, together and
    before any scheme; a later checklist replaces both. Of a checklist read with its
    rejects, these are kept in the store (``Store.keep_rejects``), or ``strict`` refuses it."""
    with scratch_scope(store.spark):
        if REJECTS in checklist.columns:
            checklist, bad = split(checklist, scratch_path(store.spark, "checklist"))
            store.keep_rejects(listed(bad, CHECKLIST), strict)
        return store.replace_schemes([], {CHECKLIST: checklist, "b_species_id": L.species_reference(checklist)})


def load_schemes(spark: SparkSession, store: Store, deliveries: dict[Scheme, SchemeFiles],
                 checklist: DataFrame, schemas: dict[str, str] | None = None, strict: bool = False) -> LoadReport:
    """Load every delivered scheme in one job and replace them in the store.

    ``checklist`` needs ``Search_Name``, ``Accepted_Name``, ``Systematic_Order``
    and the file ordinal ``_ordinal`` (``read_checklist`` provides them).
    ``schemas`` may declare the raw tables' DDL (``sites``/``visits``/``counts``);
    without it types are inferred, which reads each file twice. Each raw table is
    then scanned once, into a staging copy that all builders read. ``strict``
    refuses a delivery with rejects, as the source system does; otherwise they
    are listed in the report. Either way the list is kept in the store.
    """
    schemas = schemas or {}
    ids = [s.bms_id for s in deliveries]

    def raw(kind: str) -> DataFrame:
        frames = [read_raw(spark, getattr(f, kind), schemas.get(kind)).withColumn("bms_id", F.lit(s.bms_id))
                  for s, f in deliveries.items()]
        out = frames[0]
        for x in frames[1:]:
            out = out.unionByName(x, allowMissingColumns=True)
        return out

    def lines(kind: str) -> DataFrame:
        return L.clean_visits(raw(kind)) if kind == "visits" else raw(kind)

    def staged(kind: str) -> tuple[DataFrame, DataFrame]:
        return split(with_rejects(lines(kind), RULES[kind]), scratch_path(spark, kind))

    detail = scheme_detail(spark, list(deliveries))
    entries = store.manifest()
    starts = {t: store._hw(entries, t) for t in SEQUENCES}
    with scratch_scope(spark):  # staging and numbering copies are removed once published (or refused)
        copies = dict(zip(RULES, L.together(*[lambda k=k: staged(k) for k in RULES]), strict=True))
        found = [listed(bad, kind) for kind, (_, bad) in copies.items()]
        rejects = store.keep_rejects(reduce(DataFrame.unionByName, found), strict)
        rows = {kind: df for kind, (df, _) in copies.items()}
        src = L.SchemeSources(rows["sites"], rows["visits"], L.resolve_species(rows["counts"], checklist))
        tables = L.load_tables(detail, src, starts=starts)
        load_id = store.replace_schemes(ids, tables, trusted_keys=True)
    counts = L.resolve_species(lines("counts").drop(CORRUPT), checklist)  # for reports, from the files
    published = {t: store.table(t) for t in ("m_site", "b_recorder", "m_visit", "b_count", "m_site_geo")}
    mine = {t: df.where(F.col("bms_id").isin(*ids)) for t, df in published.items()}
    return LoadReport(
        load_id=load_id,
        audit=store.audit().where(F.col("bms_id").isin(*ids) & F.col("tbl").isin(*published) & (F.col("n") > 0)),
        dropped_counts=L.unmatched_counts(counts, mine["m_visit"], mine["m_site"]),
        warnings=load_warnings(mine["m_site"], mine["b_recorder"], mine["m_site_geo"]),
        cascade=dict(store.last_cascade or {}),
        unknown_species=L.unknown_species(counts),
        rejects=rejects,
    )


def load_scheme(spark: SparkSession, store: Store, scheme: Scheme, files: SchemeFiles, checklist: DataFrame,
                schemas: dict[str, str] | None = None, strict: bool = False) -> LoadReport:
    """One scheme, replacing whatever the store held for it."""
    return load_schemes(spark, store, {scheme: files}, checklist, schemas, strict)
