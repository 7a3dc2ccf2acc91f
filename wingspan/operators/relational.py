"""Row-level relational operators: dedupe, merges, deletes as anti joins,
update-from-join, column add/drop, paging (W1, W2, J1-J8, P3-P5, O1, O2).

Everything is a DataFrame plan. No operator collects data to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str
Pairs = Sequence[tuple[str, str]] | Sequence[str]


def _names(cols: Iterable[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def asc_last(cols: Iterable[ColumnOrName]) -> list[Column]:
    """O1: ascending, NULLs last (the SQL default this model was written for).

    Names and Column objects become ``asc_nulls_last``; a Column that already
    carries a direction is kept as given.
    """
    directed = re.compile(r"(ASC|DESC) NULLS (FIRST|LAST)'>$")
    given = [F.col(c) if isinstance(c, str) else c for c in cols]
    return [c if directed.search(str(c)) else c.asc_nulls_last() for c in given]


def sort_nulls_last(df: DataFrame, cols: Sequence[ColumnOrName]) -> DataFrame:
    """O1: a total sort of the output (range exchange + sort)."""
    return df.orderBy(*asc_last(cols))


def _pairs(on: Pairs) -> list[tuple[str, str]]:
    return [(p, p) if isinstance(p, str) else (p[0], p[1]) for p in on]


def first_per_key(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName]) -> DataFrame:
    """Keep the first row of each key group under ``order`` (NULLs last).

    ``row_number() = 1`` over a keyed window: Spark plans it with a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key sends at most one row
    per map task through the exchange. NULL keys form one group. ``order``
    should be total within a key; the caller adds a tie-break when it is not.
    """
    w = Window.partitionBy(*_names(keys)).orderBy(*asc_last(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName] = (),
                tiebreak: Sequence[ColumnOrName] = ()) -> DataFrame:
    """``SELECT DISTINCT ON (keys) * ... ORDER BY keys, order``."""
    return first_per_key(df, keys, list(order) + list(tiebreak))


def with_ordinal(df: DataFrame, name: str = "_ordinal") -> DataFrame:
    """Capture file order right after a scan (for W2).

    Ordered by (file path, position); the position comes from
    ``monotonically_increasing_id`` whose partition prefix follows the split
    offsets of a file. Must be applied directly on the scan.
    """
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("f"),
                                         F.monotonically_increasing_id().alias("p")))


def keep_first(df: DataFrame, key: Sequence[str] | str, ordinal: ColumnOrName) -> DataFrame:
    """The first row per key by file order (R ``!duplicated(key)``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return first_per_key(df, keys, [ordinal])


def merge_left(x: DataFrame, k: DataFrame, on: Pairs) -> DataFrame:
    """Left merge in which a missing key matches a missing key.

    ``on`` pairs (x column, k column); the k-side key columns are dropped.
    """
    pairs = _pairs(on)
    kk = k
    for i, (_, b) in enumerate(pairs):
        kk = kk.withColumnRenamed(b, f"__m{i}")
    cond = None
    for i, (a, _) in enumerate(pairs):
        c = x[a].eqNullSafe(kk[f"__m{i}"])
        cond = c if cond is None else cond & c
    return x.join(kk, cond, "left").drop(*[f"__m{i}" for i in range(len(pairs))])


def attach_scheme(df: DataFrame, schemes: DataFrame, scheme_id: str | None = None) -> DataFrame:
    """Put each staging row under its scheme; empty when the scheme row is missing.

    The source pairs every staging row with a one-row relation holding the
    scheme id. Here the id is a column (a literal for a one-scheme load) and
    a semi join against the scheme table keeps only rows whose scheme is
    registered: the same result without a cartesian product.
    """
    if scheme_id is not None:
        df = df.withColumn("bms_id", F.lit(scheme_id))
        schemes = schemes.where(F.col("bms_id") == F.lit(scheme_id))
    return df.join(schemes.select("bms_id"), "bms_id", "left_semi")


def anti_join(target: DataFrame, other: DataFrame, on: Pairs) -> DataFrame:
    """Rows of ``target`` with no partner in ``other``; NULL keys never match."""
    pairs = _pairs(on)
    keys = other.select(*[F.col(b).alias(f"__k{i}") for i, (_, b) in enumerate(pairs)])
    cond = None
    for i, (a, _) in enumerate(pairs):
        c = target[a] == keys[f"__k{i}"]
        cond = c if cond is None else cond & c
    return target.join(keys, cond, "left_anti")


def semi_join(target: DataFrame, other: DataFrame, on: Pairs) -> DataFrame:
    """Rows of ``target`` with a partner in ``other`` (``WHERE key IN (...)``)."""
    pairs = _pairs(on)
    keys = other.select(*[F.col(b).alias(f"__k{i}") for i, (_, b) in enumerate(pairs)])
    cond = None
    for i, (a, _) in enumerate(pairs):
        c = target[a] == keys[f"__k{i}"]
        cond = c if cond is None else cond & c
    return target.join(keys, cond, "left_semi")


def delete_using(target: DataFrame, source: DataFrame, on: Pairs) -> DataFrame:
    """What survives ``DELETE FROM target USING source WHERE keys match``."""
    return anti_join(target, source, on)


def delete_in(target: DataFrame, subquery: DataFrame, on: Pairs) -> DataFrame:
    """What survives ``DELETE FROM target WHERE key IN (subquery)``.

    A NULL key is neither in nor out, so it is not deleted: the anti join keeps it.
    """
    return anti_join(target, subquery, on)


def update_from(target: DataFrame, source: DataFrame, on: Pairs, assignments: dict[str, str]) -> DataFrame:
    """``UPDATE target SET t = s FROM source WHERE keys match``.

    Unmatched rows keep their value. When several source rows match, the one
    with the smallest values of the assigned columns (in the given order)
    wins, so the result is deterministic. The source is reduced to one row
    per key by an aggregate (map-side partial) before the join.
    """
    pairs = _pairs(on)
    src_cols = list(assignments.values())
    if len(src_cols) == 1:  # a plain min keeps a fixed-width buffer: hash aggregate
        pick = F.struct(F.min(F.col(src_cols[0])).alias("v0"))
    else:  # lexicographic min over the assigned columns (sort-based aggregate)
        pick = F.min(F.struct(*[F.col(s).alias(f"v{j}") for j, s in enumerate(src_cols)]))
    reduced = source.groupBy(*[F.col(b).alias(f"__k{i}") for i, (_, b) in enumerate(pairs)]).agg(
        pick.alias("__new")).withColumn("__hit", F.lit(True))
    cond = None
    for i, (a, _) in enumerate(pairs):
        c = target[a] == reduced[f"__k{i}"]
        cond = c if cond is None else cond & c
    joined = target.join(reduced, cond, "left")
    out_cols = []
    for name in target.columns:
        if name in assignments:
            j = src_cols.index(assignments[name])
            out_cols.append(F.when(F.col("__hit"), F.col("__new")[f"v{j}"]).otherwise(target[name]).alias(name))
        else:
            out_cols.append(target[name])
    for name, s in assignments.items():
        if name not in target.columns:
            j = src_cols.index(s)
            out_cols.append(F.when(F.col("__hit"), F.col("__new")[f"v{j}"]).alias(name))
    return joined.select(*out_cols)


def add_column_if_absent(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS``: a NULL column of the given type."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def drop_if_present(df: DataFrame, name: str) -> DataFrame:
    """``DROP COLUMN IF EXISTS``."""
    return df.drop(name)


def update_where(df: DataFrame, name: str, value: Column, where: Column) -> DataFrame:
    """P5: ``UPDATE ... SET name = value WHERE pred``; other rows keep their value."""
    return df.withColumn(name, F.when(where, value).otherwise(F.col(name)))


def page(df: DataFrame, order: Sequence[ColumnOrName], offset: int, n: int,
         max_take: int = 100_000) -> DataFrame:
    """O2: ``ORDER BY ... LIMIT n OFFSET i``; the order must be total.

    A shallow page is a take-ordered (each task keeps ``offset + n`` rows).
    A deep page would make that one unbounded task, so beyond ``max_take``
    rows are numbered with the distributed ``assign_ids`` and the page is a
    range filter on the number.
    """
    if offset + n <= max_take:
        return df.orderBy(*asc_last(order)).offset(offset).limit(n)
    from wingspan.operators.keys import assign_ids

    ids = assign_ids(df, order, "__row", make_total=False)
    return ids.where((F.col("__row") > offset) & (F.col("__row") <= offset + n)).orderBy("__row").drop("__row")
