"""Foreign-key graph operators: cascading delete (J10) and cascading key
rename (J11), as chains of equi joins following the model's references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.operators.relational import anti_join, semi_join

Edge = tuple[str, Sequence[str], str, Sequence[str]]  # (child, child cols, parent, parent cols)


def topological(tables: Sequence[str], edges: Sequence[Edge]) -> list[str]:
    """Parents before children."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(t: str) -> None:
        if t in seen:
            return
        seen.add(t)
        for child, _, parent, _ in edges:
            if child == t and parent != t and parent in tables:
                visit(parent)
        order.append(t)

    for t in tables:
        visit(t)
    return order


def cascade_delete(tables: dict[str, DataFrame], edges: Sequence[Edge], keys: dict[str, str],
                   deleted_keys: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``DELETE`` with ``ON DELETE CASCADE``; returns the survivors of every table.

    ``deleted_keys[t]`` holds the key values removed directly from ``t`` (one
    column named ``keys[t]``). Walking parents before children, a child row
    goes when any of its references points at a removed parent row; a NULL
    reference never cascades. Only semi and anti joins: nothing is
    collected, and every removed-key set is derived by Spark from the data.
    """
    removed: dict[str, DataFrame] = {}
    survivors: dict[str, DataFrame] = {}
    for t in topological(list(tables), edges):
        df = tables[t]
        alive, gone = df, []
        if t in deleted_keys:
            pair = [(keys[t], keys[t])]
            alive = anti_join(alive, deleted_keys[t], pair)
            gone.append(semi_join(df, deleted_keys[t], pair))
        for child, ccols, parent, pcols in edges:
            if child == t and parent in removed:
                pairs = list(zip(ccols, pcols))
                alive = anti_join(alive, removed[parent], pairs)
                gone.append(semi_join(df, removed[parent], pairs))
        survivors[t] = alive
        if t in keys and gone:
            # removed keys come from semi joins on the parents' removed keys,
            # never from this table's survivors: the plan stays linear in the
            # graph. Duplicates do not change a semi/anti join, so no distinct.
            g = gone[0].select(keys[t])
            for x in gone[1:]:
                g = g.unionByName(x.select(keys[t]))
            removed[t] = g
    return survivors


def rekey(child: DataFrame, column: str, mapping: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """``ON UPDATE CASCADE``: rename key values in a referencing column.

    ``mapping`` holds (old, new) pairs, one per old value. Rows without a
    mapping keep their value. A left join; the optimiser broadcasts the
    mapping only when its measured size is under the broadcast threshold.
    """
    m = mapping.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    out = child.join(m, child[column] == m["__old"], "left")
    return out.select(*[F.coalesce(F.col("__new"), child[c]).alias(c) if c == column else child[c]
                        for c in child.columns])


def rekey_columns(child: DataFrame, columns: Sequence[str], mapping: DataFrame, flag: str | None = None) -> DataFrame:
    """J11 for keys of several columns: rows whose ``columns`` equal an old key (``old0``,
    ``old1``, ... of ``mapping``) take the new one (``new0``, ...), even if parts of it are NULL.
    A boolean column ``flag`` of ``child``, if given, becomes true for them."""
    n = range(len(columns))
    m = mapping.select(*[F.col(f"old{i}").alias(f"__old{i}") for i in n], *[F.col(f"new{i}").alias(f"__new{i}") for i in n], F.lit(True).alias("__hit"))
    on = reduce(and_, [child[c] == m[f"__old{i}"] for i, c in enumerate(columns)])
    new = {c: F.when(F.col("__hit"), F.col(f"__new{i}")).otherwise(child[c]).alias(c) for i, c in enumerate(columns)}
    if flag:
        new[flag] = (child[flag] | F.col("__hit").isNotNull()).alias(flag)
    return child.join(m, on, "left").select(*[new.get(c, child[c]) for c in child.columns])


def rename_targets(edges: Sequence[Edge], parent: str, columns: Sequence[str]) -> dict[str, list[tuple[str, ...]]]:
    """Which columns of which tables hold values of ``parent``'s ``columns``: the columns
    themselves, references to them, references to those, and so on; also where they are
    part of a longer key. Each tuple is in the order of ``columns``."""
    found: dict[str, list[tuple[str, ...]]] = {}
    todo = [(parent, tuple(columns))]
    while todo:
        table, cols = todo.pop(0)
        if cols in found.get(table, []):
            continue
        found.setdefault(table, []).append(cols)
        for child, ccols, par, pcols in edges:
            if par == table and (held := [c for c in cols if c in pcols]):
                if len(held) < len(cols):
                    raise ValueError(f"{child} references a part of ({', '.join(cols)}) of {table} only")
                todo.append((child, tuple(ccols[list(pcols).index(c)] for c in cols)))
    return found


def cascade_rename(tables: dict[str, DataFrame], edges: Sequence[Edge], parent: str, columns: Sequence[str],
                   mapping: DataFrame) -> dict[str, DataFrame]:
    """J11 through all levels: ``ON UPDATE CASCADE`` for a key of any number of columns
    (``mapping`` as in ``rekey_columns``). Tables that hold none of its values stay as they are."""
    out = dict(tables)
    for table, groups in rename_targets(edges, parent, columns).items():
        for cols in groups if table in out else ():
            out[table] = rekey_columns(out[table], cols, mapping)
    return out


def rekey_tables(tables: dict[str, DataFrame], edges: Sequence[Edge], parent: str,
                 mapping: DataFrame) -> dict[str, DataFrame]:
    """J11 over the graph: rename the parent's key and every single-column
    reference to it (one level, as each reference points at the key)."""
    out = dict(tables)
    for child, ccols, par, pcols in edges:
        if par == parent and child in out and len(ccols) == 1:
            out[child] = rekey(out[child], ccols[0], mapping)
    if parent in out:
        pk = [pc for ch, cc, par, pcs in edges if par == parent for pc in pcs][:1]
        if pk:
            out[parent] = rekey(out[parent], pk[0], mapping)
    return out
