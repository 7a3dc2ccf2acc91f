"""The published relational model (K9): table schemas, keys, references,
documentation, and the foreign-key graph used by checks and cascades.

Spark tables carry no constraints, so keys are data here and are checked by
``wingspan.operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

VARCHAR = 255  # declared length of every varchar column
NUMERIC = T.DecimalType(20, 6)  # unbounded numeric of the source, pinned for Spark


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    serial: str | None = None  # column filled from a sequence
    varchar: tuple[str, ...] = ()  # columns limited to VARCHAR characters
    scheme_scoped: bool = True  # partitioned by bms_id when published
    comment: str = ""
    docs: dict[str, str] = field(default_factory=dict)


def _f(name: str, dtype: T.DataType, doc: str = "", nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": doc} if doc else {})


S, I, L, B, D = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType()
POINT = T.StructType([_f("srid", I), _f("x", T.DoubleType()), _f("y", T.DoubleType())])
TIME = S  # time of day as zero-padded HH:mm:ss text


def _spec(name, fields, **kw) -> TableSpec:
    schema = T.StructType(fields)
    docs = {f.name: f.metadata.get("comment", "") for f in fields if f.metadata.get("comment")}
    return TableSpec(name=name, schema=schema, docs=docs, **kw)


def _fk(cols, parent, pcols) -> ForeignKey:
    return ForeignKey(tuple(cols), parent, tuple(pcols))


# Checklist columns in file order (the bulk load reads them by position).
CHECKLIST_COLUMNS: list[tuple[str, str]] = [
    ("Search_Genus", "string"), ("Search_Species_Epithet", "string"), ("Search_Name", "string"),
    ("Accepted_Name", "string"), ("Systematic_Order", "int"), ("Family", "string"), ("Subfamily", "string"),
    ("Genus", "string"), ("Name", "string"), ("Species_Epithet", "string"), ("Author_Year", "string"),
    ("Author", "string"), ("Year", "int"), ("Full_Name", "string"), ("Aggregate", "boolean"),
    ("Synonym_Search_Name", "boolean"), ("Synonym_Source", "string"), ("Species_Search_Name", "boolean"),
    ("GBIFusageKey", "int"), ("GBIFscientificName", "string"), ("GBIFrank", "string"), ("GBIForder", "string"),
    ("GBIFmatchType", "string"), ("GBIFphylum", "string"), ("GBIFkingdom", "string"), ("GBIFgenus", "string"),
    ("GBIFclass", "string"), ("GBIFconfidence", "int"), ("GBIFsynonym", "boolean"), ("GBIFstatus", "string"),
    ("GBIFfamily", "string"),
]

CHECKLIST = "species_checklist2019_gbif"
_CHECKLIST_TYPES = {"string": S, "int": I, "boolean": B}

# Table names, column names, types and keys of the published model.
MODEL: dict[str, TableSpec] = {
    "bms_detail": _spec(
        "bms_detail",
        [_f("bms_id", S, "Code of the national scheme"), _f("country_iso3", S, "ISO 3-letter country code"),
         _f("country_name", S, "Country name"), _f("contact_name", S, "Main contact"),
         _f("contact_email", S, "Main contact e-mail")],
        primary_key=("bms_id",), not_null=("bms_id",),
        varchar=("bms_id", "country_iso3", "country_name", "contact_name", "contact_email"),
        comment="Identification and contact details of each scheme"),
    "habitat_thesaurus": _spec(
        "habitat_thesaurus",
        [_f("habitat_id", L, "Habitat id"), _f("bms_habitat", S, "Habitat name in the scheme"),
         _f("eunis_code", S, "EUNIS code"), _f("eunis_level_1", S), _f("eunis_level_2", S), _f("eunis_level_3", S)],
        primary_key=("habitat_id",), not_null=("habitat_id",), serial="habitat_id",
        varchar=("eunis_code", "eunis_level_1", "eunis_level_2", "eunis_level_3"), scheme_scoped=False,
        comment="Habitat thesaurus"),
    "b_species_id": _spec(
        "b_species_id",
        [_f("species_id", I, "Species id: systematic order; above 1000 for aggregates"),
         _f("species_acpt_sci_name", S, "Accepted scientific name"), _f("aggregate", B, "TRUE for an aggregate")],
        primary_key=("species_id",), unique=(("species_id",), ("species_acpt_sci_name",)), not_null=("species_id",),
        varchar=("species_acpt_sci_name",), scheme_scoped=False, comment="Accepted species"),
    "species_thesaurus": _spec(
        "species_thesaurus",
        [_f("species_sci_name", S), _f("species_acpt_sci_name", S), _f("species_acpt_sci_authority", S),
         _f("species_english_name", S), _f("species_dutch_name", S), _f("species_german_name", S),
         _f("species_spanish_name", S), _f("species_finish_name", S), _f("species_french_name", S),
         _f("species_swedish_name", S), _f("species_id", I)],
        primary_key=("species_sci_name",), not_null=("species_sci_name",),
        foreign_keys=(_fk(["species_id"], "b_species_id", ["species_id"]),),
        varchar=("species_sci_name", "species_acpt_sci_name", "species_acpt_sci_authority", "species_english_name",
                 "species_dutch_name", "species_german_name", "species_spanish_name", "species_finish_name",
                 "species_french_name", "species_swedish_name"),
        scheme_scoped=False, comment="Species names used by schemes"),
    "b_recorder": _spec(
        "b_recorder",
        [_f("recorder_id", L, "Anonymous recorder id"), _f("bms_id", S), _f("bms_observer_id", S,
                                                                             "Recorder code in the scheme")],
        primary_key=("recorder_id",), not_null=("recorder_id",), serial="recorder_id",
        foreign_keys=(_fk(["bms_id"], "bms_detail", ["bms_id"]),), varchar=("bms_id", "bms_observer_id"),
        comment="Recorders"),
    "m_visit": _spec(
        "m_visit",
        [_f("visit_id", L, "Visit id"), _f("bms_visit_id", I, "Visit id in the scheme"), _f("recorder_id", L),
         _f("bms_id", S), _f("transect_id", S, "Qualified transect id"), _f("visit_date", D),
         _f("visit_start", TIME), _f("visit_end", TIME), _f("visit_temp", I), _f("visit_cloud", I, "0-100"),
         _f("visit_wind", I, "Beaufort 0-12"), _f("completed", B)],
        primary_key=("visit_id",), not_null=("visit_id",), serial="visit_id",
        foreign_keys=(_fk(["recorder_id"], "b_recorder", ["recorder_id"]), _fk(["bms_id"], "bms_detail", ["bms_id"])),
        varchar=("bms_id", "transect_id"), comment="Visits"),
    "m_site": _spec(
        "m_site",
        [_f("site_id", L, "Site id"), _f("bms_id", S), _f("transect_id", S), _f("section_id", S),
         _f("monitoring_type", S, "1, 2, 31, 32, 4 or 5"), _f("site_info_quality", I, "1, 2 or 3"),
         _f("transect_length", NUMERIC), _f("section_length", NUMERIC), _f("section_transect_length_equal", B),
         _f("site_area", NUMERIC), _f("bms_site_id", I, "Site id in the scheme")],
        primary_key=("site_id",), not_null=("site_id",), serial="site_id",
        foreign_keys=(_fk(["bms_id"], "bms_detail", ["bms_id"]),),
        varchar=("bms_id", "transect_id", "section_id", "monitoring_type"), comment="Sites (transect sections)"),
    "m_site_habitat": _spec(
        "m_site_habitat",
        [_f("site_id", L), _f("year_stamp", D), _f("habitat_side1", L), _f("habitat_side2", L)],
        foreign_keys=(_fk(["site_id"], "m_site", ["site_id"]), _fk(["habitat_side1"], "habitat_thesaurus", ["habitat_id"]),
                      _fk(["habitat_side2"], "habitat_thesaurus", ["habitat_id"])),
        comment="Site habitat by year"),
    "m_site_geo": _spec(
        "m_site_geo",
        [_f("site_id", L), _f("section_geom_true", B), _f("centroid_geom", POINT), _f("start_geom", POINT),
         _f("end_geom", POINT)],
        foreign_keys=(_fk(["site_id"], "m_site", ["site_id"]),), comment="Site geometry, SRID 3035"),
    "b_count": _spec(
        "b_count",
        [_f("count_id", L, "Count id"), _f("visit_id", L), _f("site_id", L), _f("species_id", I),
         _f("butterfly_count", I, "Individuals counted", nullable=False)],
        primary_key=("count_id",), not_null=("count_id", "butterfly_count"), serial="count_id",
        foreign_keys=(_fk(["visit_id"], "m_visit", ["visit_id"]), _fk(["site_id"], "m_site", ["site_id"]),
                      _fk(["species_id"], "b_species_id", ["species_id"])),
        comment="Counts per visit, section and species"),
    CHECKLIST: _spec(
        CHECKLIST, [_f(n, _CHECKLIST_TYPES[t]) for n, t in CHECKLIST_COLUMNS],
        varchar=tuple(n for n, t in CHECKLIST_COLUMNS if t == "string"), scheme_scoped=False,
        comment="Species checklist as delivered; search names lead to accepted names"),
}

# Tables of one scheme, parents before children (load order; deletes go in reverse).
SCHEME_TABLES = ["bms_detail", "m_site", "b_recorder", "m_visit", "b_count", "m_site_geo", "m_site_habitat"]


def foreign_key_edges() -> list[tuple[str, ForeignKey]]:
    """Every (child table, foreign key) of the model."""
    return [(t, fk) for t, spec in MODEL.items() for fk in spec.foreign_keys]


def children_of(parent: str) -> list[tuple[str, ForeignKey]]:
    return [(t, fk) for t, fk in foreign_key_edges() if fk.parent == parent]


def topological_order() -> list[str]:
    """Parents before children."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(t: str) -> None:
        if t in seen:
            return
        seen.add(t)
        for fk in MODEL[t].foreign_keys:
            if fk.parent != t:
                visit(fk.parent)
        order.append(t)

    for t in MODEL:
        visit(t)
    return order
