"""Constraints as queries.

Spark tables accept anything, so every key, reference, NOT NULL, length and
domain rule of the model is a query whose result lists the violations. All
are single passes or equi joins; none collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wingspan.functions.geometry import POINT_TYPE, lonlat_warning, point_violation
from wingspan.functions.scalars import within_tolerance
from wingspan.operators.relational import _pairs, Pairs
from wingspan.plans.model import MODEL, VARCHAR


def key_violations(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Q1/A3: key values held by more than one row, with their row count.

    Hash aggregate with a map-side partial count, so a hot key costs one row
    per map task in the shuffle. A NULL key is reported like any value (a
    primary key must not be NULL either).
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def fk_violations(child: DataFrame, parent: DataFrame, on: Pairs) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    pairs = _pairs(on)
    nonnull = child
    for a, _ in pairs:
        nonnull = nonnull.where(F.col(a).isNotNull())
    keys = parent.select(*[F.col(b).alias(f"__p{i}") for i, (_, b) in enumerate(pairs)])
    cond = None
    for i, (a, _) in enumerate(pairs):
        c = nonnull[a] == keys[f"__p{i}"]
        cond = c if cond is None else cond & c
    return nonnull.join(keys, cond, "left_anti")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q3: rows with a NULL in any NOT NULL column."""
    pred = None
    for c in columns:
        p = F.col(c).isNull()
        pred = p if pred is None else pred | p
    return df.where(pred) if pred is not None else df.limit(0)


def length_violations(df: DataFrame, columns: Sequence[str], limit: int = VARCHAR) -> DataFrame:
    """Q4: rows with text longer than the declared varchar length."""
    pred = None
    for c in columns:
        p = F.length(F.col(c)) > limit
        pred = p if pred is None else pred | p
    return df.where(pred) if pred is not None else df.limit(0)


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q5: violations per rule in ONE pass: ``count_if`` per rule, unpivoted to
    ``(rule, n)``. A rule whose predicate is NULL for a row does not count it.
    Every rule gets a row, zero included."""
    agg = df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(f"r{i}") for i, pred in enumerate(rules.values())])
    stack = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n"))
                                for i, name in enumerate(rules)]))
    return agg.select(stack.alias("s")).select("s.rule", "s.n")


# Documented domains of the model.
CLOUD_RANGE = (0, 100)
WIND_RANGE = (0, 12)
MONITORING_TYPES = ["1", "2", "31", "32", "4", "5"]
AGGREGATE_FROM = 1000  # aggregates have species_id above this value


def visit_domain_rules(cloud: str = "visit_cloud", wind: str = "visit_wind") -> dict[str, Column]:
    return {
        "cloud_0_100": (F.col(cloud) < CLOUD_RANGE[0]) | (F.col(cloud) > CLOUD_RANGE[1]),
        "wind_0_12": (F.col(wind) < WIND_RANGE[0]) | (F.col(wind) > WIND_RANGE[1]),
    }


def site_domain_rules(monitoring_type: str = "monitoring_type", quality: str = "site_info_quality") -> dict[str, Column]:
    mt = F.col(monitoring_type).cast("string")
    return {
        "monitoring_type": mt.isNotNull() & ~mt.isin(*MONITORING_TYPES),
        "site_info_quality_1_3": F.col(quality).isNotNull() & ~F.col(quality).isin(1, 2, 3),
    }


def species_domain_rules(species_id: str = "species_id", aggregate: str = "aggregate") -> dict[str, Column]:
    sid, agg = F.col(species_id), F.col(aggregate)
    return {
        "aggregate_above_1000": agg.isNotNull() & sid.isNotNull() & (agg != (sid > AGGREGATE_FROM)),
        "aggregate_at_1000": sid == AGGREGATE_FROM,
    }


def domain_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q5: one-pass rule counts over one table."""
    return rule_counts(df, rules)


def section_length_check(sections: DataFrame, transect_keys: Sequence[str], section_length: str,
                         transect_length: str, tol: float = 10.0,
                         name: str = "section_transect_length_equal") -> DataFrame:
    """A5: per transect, do its section lengths add up to the transect length (+/- tol)?

    One row per transect from a partial/final hash aggregate (skew-proof); join
    it back to the sections on the transect key where a per-section column is
    needed. The transect length is taken as declared on its sections (max).
    """
    return sections.groupBy(*transect_keys).agg(
        within_tolerance(F.sum(section_length), F.max(transect_length), tol).alias(name)
    )


def row_rules(name: str, columns: Sequence[str]) -> dict[str, Column]:
    """Q3, Q4 and the geometry guard (F16) of a model table as predicates on one row."""
    spec, rules = MODEL[name], {}
    if nn := [c for c in spec.not_null if c in columns]:
        rules["not_null"] = reduce(or_, [F.col(c).isNull() for c in nn])
    if vc := [c for c in spec.varchar if c in columns]:
        rules["varchar_255"] = reduce(or_, [F.coalesce(F.length(F.col(c)) > VARCHAR, F.lit(False)) for c in vc])
    if pts := [f.name for f in spec.schema.fields if f.dataType.simpleString() == POINT_TYPE and f.name in columns]:
        rules["point"] = reduce(or_, [F.coalesce(point_violation(c), F.col(c).isNotNull()) for c in pts])
    return rules


def model_checks(tables: dict[str, DataFrame], only: Sequence[str] | None = None,
                 trusted: Sequence[str] = (), measured: bool = False) -> DataFrame | None:
    """Q1-Q4 for the model tables named in ``only`` (default all given):
    ``(tbl, check, n)`` violation counts, one row per check.

    Foreign keys are checked only where the parent is among ``tables``.
    Tables in ``trusted`` were built together by this package's builders:
    their sequence keys are unique by construction (``assign_ids``) and
    their references to each other come from joins with those same frames,
    so those checks (each a full shuffle of a fact table at scale) are
    skipped; everything else is still checked. ``measured`` leaves out the
    rules on single rows (the store counts them while it writes). None if
    nothing is left to check.
    """
    trusted = set(trusted)
    out = None
    for name, df in tables.items():
        if only is not None and name not in only:
            continue
        spec = MODEL[name]
        parts = []
        serial_pk = spec.serial is not None and tuple(spec.primary_key) == (spec.serial,)
        if spec.primary_key and not (name in trusted and serial_pk):
            parts.append(("primary_key", key_violations(df, list(spec.primary_key)).agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))))
        for u in spec.unique:
            if tuple(u) != tuple(spec.primary_key):
                parts.append((f"unique_{'_'.join(u)}", key_violations(df, list(u)).agg(
                    F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))))
        for fk in spec.foreign_keys:
            if fk.parent in tables and not (name in trusted and fk.parent in trusted):
                v = fk_violations(df, tables[fk.parent], list(zip(fk.columns, fk.parent_columns)))
                parts.append((f"fk_{'_'.join(fk.columns)}", v.agg(F.count(F.lit(1)).alias("n"))))
        rules = {} if measured else row_rules(name, df.columns)
        if rules:
            rc = rule_counts(df, rules).select(F.col("rule").alias("check"), F.col("n").cast("long"))
            rc = rc.withColumn("tbl", F.lit(name))
            out = rc if out is None else out.unionByName(rc)
        for check, p in parts:
            p = p.select(F.lit(name).alias("tbl"), F.lit(check).alias("check"), F.col("n").cast("long"))
            out = p if out is None else out.unionByName(p)
    return None if out is None else out.select("tbl", "check", "n")


def cast_rejects(df: DataFrame, column: str, dtype: str) -> DataFrame:
    """F8 companion: rows whose non-NULL value does not convert to ``dtype``
    (the source system would abort the whole insert on the first one)."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast(dtype).isNull())


def strict_cast(column: str, dtype: str) -> Column:
    """F8: a cast that fails the job on bad input (ANSI ``CAST``)."""
    return F.col(column).cast(dtype)


def load_warnings(m_site: DataFrame, b_recorder: DataFrame, m_site_geo: DataFrame | None = None) -> DataFrame:
    """Fan-out traps and suspicious values of a load, ``(warning, n)``:

    * ``duplicate_bms_site_id``: a scheme site id held by several site rows
      (its counts are multiplied by the count join);
    * ``duplicate_observer_int``: text observer codes that meet as one
      integer (``07`` and ``7``), which duplicate their visits;
    * ``degree_like_point``: coordinates within +/-180/+/-90, i.e. probably
      degrees stored as metres of the projection.
    """
    site_dups = key_violations(m_site.where(F.col("bms_site_id").isNotNull()), ["bms_id", "bms_site_id"])
    obs = b_recorder.select("bms_id", F.col("bms_observer_id").try_cast("int").alias("obs_int")).where(
        F.col("obs_int").isNotNull())
    obs_dups = key_violations(obs, ["bms_id", "obs_int"])
    parts = [
        site_dups.agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate_bms_site_id").alias("warning"), "n"),
        obs_dups.agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate_observer_int").alias("warning"), "n"),
    ]
    if m_site_geo is not None:
        parts.append(m_site_geo.agg(F.count_if(lonlat_warning("centroid_geom")).alias("n")).select(
            F.lit("degree_like_point").alias("warning"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
