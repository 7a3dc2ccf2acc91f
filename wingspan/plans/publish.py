"""Publishing (K1, K5-K8, K10, A4, J10, J11): staging writes, the scheme-partitioned
store with all-or-nothing replacement of one scheme, the load audit,
cascades from global tables, snapshots and statistics.

Layout of a store root::

    <root>/<table>/load_id=<load>/bms_id=<scheme>/part-*.parquet
    <root>/_commits/<version>.json              see ``commits``
    <root>/_deletes/<id>/part-*.parquet         key values of a delete set
    <root>/_leases/<id>                         versions that a reader still needs
    <root>/_rejects/<id>/part-*.parquet         values that a load could not read

A load appends its rows under a new ``load_id``, counting and checking them as
they are written (``Observation``), and only then, after every check passed,
commits a version naming that load as current for its schemes. Readers list
only the folders of current, non-empty loads and filter on the current (load,
scheme) pairs (partition pruning), so the cost of a read does not grow with the
load history. Replacing a scheme therefore never deletes or overwrites files in
place; an empty reload leaves the scheme empty; a failed load publishes nothing.

Two loaders may work at once. The one that commits second rebases: loads of
other schemes stay, its sequence ids move above theirs (as a number added when
the load is read; ``compact`` writes it in), and checks against tables that
changed meanwhile run again. Loads of one scheme at once, or ids that cannot be
moved because their caller chose them, refuse the second load.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wingspan.functions.geometry import ewkt
from wingspan.operators.graph import rekey_columns, rename_targets
from wingspan.operators.quality import fk_violations, key_violations, model_checks, row_rules
from wingspan.plans.commits import CommitLog, State
from wingspan.plans.load import conform, together
from wingspan.plans.model import MODEL, foreign_key_edges
from wingspan.session import drop_paths

GLOBAL = "__all__"  # bms_id partition value for tables that are not scheme-scoped
#: Loads that may commit between the start and the end of one load's commit.
ATTEMPTS = 100
#: K6: rows of a published file, at most (``spark.wingspan.rowsPerFile``).
ROWS_PER_FILE = 10_000_000
AUDIT_SCHEMA = "tbl string, bms_id string, n long"


class PublishError(RuntimeError):
    pass


def stage(df: DataFrame, root: str, name: str) -> str:
    """K1: overwrite a staging table (the source drops and rewrites it each load)."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def load_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """A2/A4: rows per table and scheme, ``(tbl, bms_id, n)``: one grouped
    count per table, unioned."""
    out = None
    for name, df in tables.items():
        b = F.col("bms_id") if "bms_id" in df.columns else F.lit(None).cast("string")
        part = df.groupBy(b.alias("bms_id")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("tbl"), "bms_id", "n")
        out = part if out is None else out.unionByName(part)
    return out


def write_batched(df: DataFrame, path: str, order: list[str], n: int = 100_000) -> None:
    """K6: the source inserts in fixed-size batches to bound memory. Here it is
    one distributed write, sorted within tasks, at most ``n`` rows per file;
    the batch number itself is ``batch_number`` on the ids."""
    df.sortWithinPartitions(*order).write.mode("errorifexists").option("maxRecordsPerFile", n).parquet(path)


def analyze_table(spark: SparkSession, table: str) -> None:
    """K10 for catalog tables: optimizer statistics for every column."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def collect_statistics(df: DataFrame) -> DataFrame:
    """K10 (statistics half of ``VACUUM ANALYZE``): one pass computing row
    count, and per column NULL count, min and max, as ``(column, rows, nulls, min, max)``."""
    orderable = [f.name for f in df.schema.fields
                 if f.dataType.typeName() not in ("map", "struct", "array", "binary")]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"__n{i}"))
        if c in orderable:
            aggs.append(F.min(c).cast("string").alias(f"__lo{i}"))
            aggs.append(F.max(c).cast("string").alias(f"__hi{i}"))
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(df.columns):
        lo = F.col(f"__lo{i}") if c in orderable else F.lit(None).cast("string")
        hi = F.col(f"__hi{i}") if c in orderable else F.lit(None).cast("string")
        rows.append(F.struct(F.lit(c).alias("column"), F.col("__rows").alias("rows"),
                             F.col(f"__n{i}").alias("nulls"), lo.alias("min"), hi.alias("max")))
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


@dataclass
class Written:
    """One table of a load in flight."""

    rows: dict[str, int]  # by scheme
    low: int | None = None  # of the sequence column
    high: int | None = None
    failed: dict[str, int] = field(default_factory=dict)  # rows that break a rule, by rule


@dataclass
class Load:
    """A load that is written but not yet current."""

    load_id: str
    schemes: list[str]
    tables: dict[str, Written]
    frames: dict[str, DataFrame]  # the rows as written
    cascaded: list[str]
    trusted: bool
    check: bool
    sources: dict[str, int]


@dataclass
class Store:
    """The published model under one root folder (shared storage)."""

    spark: SparkSession
    root: str
    last_cascade: dict | None = None  # rows removed by cascade in the last replacement, per table
    last_audit: list | None = None  # (tbl, bms_id, rows) written by the last replacement
    _log: CommitLog | None = field(default=None, repr=False)
    _base: State | None = field(default=None, repr=False)  # what the next replacement started from

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # -- state -------------------------------------------------------------
    @property
    def log(self) -> CommitLog:
        if self._log is None:
            self._log = CommitLog(self.spark, self.root)
        return self._log

    def _pinned(self, refresh: bool = False) -> State:
        """The state that the next replacement is based on: pinned when its marks are
        first asked for, so that ids and marks belong together."""
        if self._base is None or refresh:
            self._base = self.log.state()
        return self._base

    def manifest(self, refresh: bool = False) -> list[dict]:
        """Current (tbl, bms_id, load_id, rows, high_water, ...) entries: one
        per table and scheme, the only data the driver holds."""
        return self._pinned(refresh).rows()

    @staticmethod
    def _hw(entries: list[dict], table: str) -> int:
        return max((e["high_water"] for e in entries if e["tbl"] == table), default=0)

    def high_water(self, table: str) -> int:
        """The sequence mark of a table: new ids start above it."""
        return self._pinned().marks.get(table, 0)

    def audit(self) -> DataFrame:
        """A4 of everything published, ``(tbl, bms_id, n)``: rows as counted when they
        were written, so no table is read."""
        rows = [(t, None if b == GLOBAL else b, e["rows"]) for (t, b), e in sorted(self.log.state().entries.items())]
        return self.spark.createDataFrame(rows, AUDIT_SCHEMA)

    # -- reads -------------------------------------------------------------
    def _read_schema(self, name: str) -> T.StructType:
        fields = [f for f in MODEL[name].schema.fields if f.name != "bms_id"]
        return T.StructType(fields + [T.StructField("load_id", T.StringType()), T.StructField("bms_id", T.StringType())])

    def _read_loads(self, name: str, load_ids: list[str]) -> DataFrame:
        """Only the folders of the given loads are listed, never the history."""
        base = self._path(name)
        paths = [f"{base}/load_id={lid}" for lid in sorted(set(load_ids))]
        return self.spark.read.schema(self._read_schema(name)).option("basePath", base).parquet(*paths)

    def _columns(self, name: str) -> list[str]:
        spec = MODEL[name]
        return [*spec.schema.names, *(["bms_id"] if spec.scheme_scoped and "bms_id" not in spec.schema.names else [])]

    def _rows(self, name: str, state: State) -> DataFrame:
        """Current rows with load_id and bms_id: ids moved, delete sets applied."""
        current = {b: e for (t, b), e in state.entries.items() if t == name and e["rows"] > 0}
        if not current:
            return self.spark.createDataFrame([], self._read_schema(name))
        schemes: dict[str, list[str]] = {}
        for b, e in current.items():
            schemes.setdefault(e["load_id"], []).append(b)
        pairs = [(F.col("load_id") == lid) & F.col("bms_id").isin(*some) for lid, some in sorted(schemes.items())]
        df = self._read_loads(name, list(schemes)).where(reduce(or_, pairs))
        moved: dict[str, dict[str, int]] = {}
        for e in current.values():
            for c, by in e.get("shift", {}).items():
                moved.setdefault(c, {})[e["load_id"]] = by
        for c, by in moved.items():
            added = reduce(lambda when, x: when.when(F.col("load_id") == x[0], F.lit(x[1])), sorted(by.items()), F.when(F.lit(False), F.lit(0))).otherwise(0)
            df = df.withColumn(c, F.col(c) + added)
        for d in state.deletes:
            if d["tbl"] == name:
                keys = self.spark.read.parquet(self._path("_deletes", d["id"]))
                on = reduce(and_, [df[c] == keys[f"k{i}"] for i, c in enumerate(d["columns"])])
                df = df.join(keys, on & df["load_id"].isin(*d["loads"]), "left_anti")
        return df

    def table(self, name: str, entries: State | None = None) -> DataFrame:
        """The current rows of a model table (``bms_id`` kept as a column for
        scheme-scoped tables that do not declare it)."""
        return self._rows(name, entries or self.log.state()).select(*self._columns(name))

    @contextmanager
    def lease(self, seconds: float = 3600) -> Iterator[State]:
        """A state to read (``table(name, state)``) that ``vacuum`` leaves alone until the
        block or the time ends."""
        state = self.log.state()
        name = f"{uuid.uuid4().hex}-{max(state.version, 0)}-{int(time.time() + seconds)}"
        fs, jvm = self.log._fs, self.log._jvm  # noqa: SLF001
        path = jvm.org.apache.hadoop.fs.Path(self._path("_leases", name))
        fs.create(path, True).close()
        try:
            yield state
        finally:
            fs.delete(path, False)

    def _leased(self) -> int | None:
        """The oldest version that a reader holds."""
        fs, jvm = self.log._fs, self.log._jvm  # noqa: SLF001
        root = jvm.org.apache.hadoop.fs.Path(self._path("_leases"))
        names = [s.getPath().getName().split("-") for s in fs.listStatus(root)] if fs.exists(root) else []
        return min((int(n[1]) for n in names if len(n) == 3 and int(n[2]) > time.time()), default=None)

    # -- writes ------------------------------------------------------------
    def _write(self, name: str, df: DataFrame, load_id: str, schemes: Sequence[str], state: State, loaded: Sequence[str]) -> Written:
        """Append one table of a load, counted and checked by the writing job itself:
        rows by scheme, the range of ids, single-row rules, and references to published
        parents, whose keys are joined in."""
        spec = MODEL[name]
        df = conform(df, name)
        if "bms_id" not in df.columns:
            df = df.withColumn("bms_id", F.lit(GLOBAL))
        keep = [c for c in spec.schema.names if c != "bms_id"]
        metrics = {"rows": F.count(F.lit(1)), **{f"rule:{r}": F.count_if(p) for r, p in row_rules(name, spec.schema.names).items()}}
        if spec.serial:
            metrics |= {"low": F.min(spec.serial), "high": F.max(spec.serial)}
        # a global table's rows belong to no scheme, even if it has a column of that name
        names = list(schemes) if spec.scheme_scoped else [GLOBAL]
        metrics |= {f"scheme:{i}": F.count_if(F.col("bms_id") == b) for i, b in enumerate(names)}
        for fk in spec.foreign_keys:
            if fk.parent not in loaded:
                there, mark = self.table(fk.parent, state), f"__{'_'.join(fk.columns)}"
                keys = there.select(*[F.col(c).alias(f"{mark}{i}") for i, c in enumerate(fk.parent_columns)]).distinct().withColumn(mark, F.lit(True))
                df = df.join(keys, reduce(and_, [df[c] == keys[f"{mark}{i}"] for i, c in enumerate(fk.columns)]), "left")
                named = reduce(and_, [F.col(c).isNotNull() for c in fk.columns])
                metrics[f"rule:fk_{'_'.join(fk.columns)}"] = F.count_if(named & F.col(mark).isNull())
        if spec.scheme_scoped and not spec.serial:
            # numbered tables come ordered by scheme; others would leave a file per task and scheme
            df = df.hint("rebalance", "bms_id")
        seen = Observation()
        out = df.observe(seen, *[m.alias(k) for k, m in metrics.items()])
        # a folder of its own, so that loads side by side do not share the committer's scratch files
        most = int(self.spark.conf.get("spark.wingspan.rowsPerFile", str(ROWS_PER_FILE)))
        out.select(*keep, "bms_id").write.option("maxRecordsPerFile", most).partitionBy("bms_id").parquet(self._path(name, f"load_id={load_id}"))
        got = seen.get
        rows = {b: got[f"scheme:{i}"] for i, b in enumerate(names) if got[f"scheme:{i}"]}
        if got["rows"] != sum(rows.values()):  # never dropped silently
            other = self._read_loads(name, [load_id]).where(~F.coalesce(F.col("bms_id").isin(*names), F.lit(False))) if names else self._read_loads(name, [load_id])
            listed = sorted((str(r["bms_id"]), r["n"]) for r in other.groupBy("bms_id").agg(F.count(F.lit(1)).alias("n")).collect())
            raise PublishError("load refused: rows of other schemes: " + ", ".join(f"{name}.{b}={n}" for b, n in listed))
        return Written(rows, got.get("low"), got.get("high"), {k[5:]: n for k, n in got.items() if k.startswith("rule:") and n})

    def replace_schemes(self, scheme_ids: list[str], frames: dict[str, DataFrame], check: bool = True,
                        trusted_keys: bool = False, sources: dict[str, int] | None = None) -> str:
        """K5: replace every given scheme in every given table, atomically.

        Rows are appended under a new load id, checked (keys, NOT NULL,
        lengths, references among the loaded tables and the published
        parents), and only then made current by a new version.
        A row of a scheme that is not named refuses the load. Frames may be empty for a scheme: it then has no rows in that table.
        Cascade: a scheme-scoped table that references a replaced table and
        is not itself in ``frames`` loses the scheme's rows, counted in
        ``last_cascade``; other schemes are never touched. ``last_audit``
        holds the rows written per table and scheme. ``trusted_keys`` is for
        frames produced together by ``load_tables``: sequence keys and the
        references among them hold by construction and are not re-checked
        (each would be a shuffle of the fact table); all other checks run, those
        on single rows and on published parents in the writing job itself.
        ``sources`` are delivery numbers to commit with the load (C10).
        """
        load_id = uuid.uuid4().hex[:16]
        base = self._pinned()
        self._base = None  # whatever comes of it, the next replacement starts anew
        cascaded = self._cascade_targets(frames)
        names = list(frames)
        known = names if check else list(MODEL)  # parents that need no look
        jobs = [lambda n=n: self._write(n, frames[n], load_id, scheme_ids, base, known) for n in names]
        try:
            done = dict(zip(names, together(*jobs) if jobs else [], strict=True))
            # listed, not scanned: a folder that cannot be read is not made current
            frames = {n: self._read_loads(n, [load_id]).drop("load_id") for n in names}
            load = Load(load_id, list(scheme_ids), done, frames, cascaded, trusted_keys, check, sources or {})
            if check:
                self._check(load, base)
            self._commit(load, base)
        except PublishError:
            drop_paths(self.spark, [self._path(n, f"load_id={load_id}") for n in names])
            raise
        return load_id

    def _check(self, load: "Load", state: State, counted: bool = True) -> None:
        """Refuse the load on any violation: what the writing jobs counted, and keys and
        references that need the rows of several tables. ``counted`` False: references to
        published parents are checked again, since these changed."""
        bad = [(n, c, k) for n, w in load.tables.items() for c, k in sorted(w.failed.items())]
        frames = load.frames
        trusted = list(frames) if load.trusted else []
        if not load.trusted:
            bad += self._repeated_ids(load, frames, state)
        res = self.violations(frames, state, trusted, measured=True, published=not counted)
        if res is not None and not bad:
            bad = [(r["tbl"], r["check"], r["n"]) for r in res.where(F.col("n") > 0).collect()]  # at most one row per check
        if bad:
            raise PublishError("load refused: " + ", ".join(f"{t}.{c}={n}" for t, c, n in bad))

    def _repeated_ids(self, load: "Load", frames: dict[str, DataFrame], state: State) -> list[tuple[str, str, int]]:
        """Q1 across loads: ids that published rows of other schemes hold already. Every load's
        range of ids is in the state, so only loads whose range meets the new one are read."""
        bad = []
        for t, w in load.tables.items():
            spec = MODEL[t]
            near = {b: e for (x, b), e in state.entries.items() if x == t and spec.scheme_scoped and b not in load.schemes and e["rows"] > 0
                    and w.low is not None and e.get("low") is not None and e["low"] <= w.high and e["high"] >= w.low}
            if near and spec.serial:
                others = self._rows(t, replace(state, entries={(t, b): e for b, e in near.items()})).select(spec.serial)
                if n := frames[t].join(others, spec.serial, "left_semi").count():
                    bad.append((t, "published_key", n))
        return bad

    def _commit(self, load: "Load", base: State) -> None:
        """Make the load current, at the first version that no other loader took."""
        shift: dict[str, int] = {}
        for _ in range(ATTEMPTS):
            now = self.log.state()
            if now.version > base.version:
                shift = self._rebase(load, base, now)
            if self.log.append(self._version(load, now, shift)):
                self.last_cascade = self._cascade_counts(load.cascaded, load.schemes, now.rows())
                self.last_audit = sorted((t, b, n) for t, w in load.tables.items() for b, n in w.rows.items())
                return
        raise PublishError(f"load refused: {ATTEMPTS} other loads were committed while this one tried")

    def _rebase(self, load: "Load", base: State, now: State) -> dict[str, int]:
        """How far the load's ids move for commits made since ``base``; refuses what they exclude."""
        mine = {(t, b) for t in [*load.tables, *load.cascaded] for b in (load.schemes if MODEL[t].scheme_scoped else [GLOBAL])}
        changed = {k for k in {*base.entries, *now.entries} if base.entries.get(k) != now.entries.get(k)}
        if both := sorted(mine & changed):
            raise PublishError("another loader published " + ", ".join(f"{t}.{b}" for t, b in both)
                               + f" during the load (versions {base.version + 1} to {now.version}): nothing of this load was made current")
        kin = {(c, fk.parent) for c, fk in foreign_key_edges()}
        tables = {t for t, _ in changed} | {d["tbl"] for d in now.deletes if d not in base.deletes}
        moved = any(now.marks.get(t, 0) != base.marks.get(t, 0) for t in load.tables)
        if load.check and (moved and not load.trusted or any((m, t) in kin or (t, m) in kin for m in load.tables for t in tables)):
            self._check(load, now, counted=False)
        shift = {}
        for t, w in load.tables.items():
            by = now.marks.get(t, 0) - base.marks.get(t, 0)
            if by and load.trusted and w.low is not None and w.low > base.marks.get(t, 0):
                shift[t] = by  # ids that a caller chose are not moved: the check above has compared them
        return shift

    def _version(self, load: "Load", now: State, shift: dict[str, int]) -> dict:
        """The commit that makes the load current on top of ``now``."""
        entries, marks = [], {}
        for t in sorted([*load.tables, *load.cascaded]):
            w = load.tables.get(t, Written({}))
            spec = MODEL[t]
            moved = {c: shift[p] for c, p in [(spec.serial, t), *[(fk.columns[0], fk.parent) for fk in spec.foreign_keys if len(fk.columns) == 1]]
                     if c and p in shift}
            by = moved.get(spec.serial, 0)
            for b in load.schemes if spec.scheme_scoped else [GLOBAL]:
                entries.append({"tbl": t, "bms_id": b, "load_id": load.load_id, "rows": w.rows.get(b, 0), "shift": moved,
                                "low": None if w.low is None else w.low + by, "high": None if w.high is None else w.high + by})
            if w.high is not None:
                marks[t] = w.high + by
        return {"version": now.version + 1, "entries": entries, "marks": marks, "sources": load.sources}

    @staticmethod
    def _cascade_targets(frames: dict[str, DataFrame]) -> list[str]:
        """ON DELETE CASCADE: scheme-scoped tables that reference a replaced,
        scheme-scoped table (transitively) and are not reloaded lose the scheme's
        rows. A new version of a global table never removes rows of a scheme: it is
        refused if it would leave orphans (``violations``); ``delete_keys`` removes them."""
        hit = {name for name in frames if MODEL[name].scheme_scoped}
        changed = True
        while changed:
            changed = False
            for child, fk in foreign_key_edges():
                if fk.parent in hit and child not in hit and MODEL[child].scheme_scoped:
                    hit.add(child)
                    changed = True
        return sorted(hit - set(frames))

    @staticmethod
    def _cascade_counts(cascaded: list[str], scheme_ids: list[str], entries: list[dict]) -> dict[str, int]:
        """Rows each cascaded table loses: read from the manifest, no job."""
        return {t: sum(e["rows"] for e in entries if e["tbl"] == t and e["bms_id"] in scheme_ids) for t in cascaded}

    def violations(self, frames: dict[str, DataFrame], entries: State | None = None, trusted: Sequence[str] = (),
                   measured: bool = False, published: bool = True) -> DataFrame | None:
        """Q1-Q4 on new rows, ``(tbl, check, n)``. References are checked against
        the new rows of the same load or the published parents; a parent that was
        never published is an empty parent. A new version of a global table
        (species, habitats) must keep every row that published children name.
        ``measured`` and ``published`` False leave out what the writing job counts
        itself: rules on single rows and references to published parents."""
        state = entries or self.log.state()
        parents = {fk.parent: self.table(fk.parent, state)
                   for name in frames for fk in MODEL[name].foreign_keys if published and fk.parent not in frames}
        res = model_checks({**frames, **parents}, only=list(frames), trusted=trusted, measured=measured)
        parts = [] if res is None else [res]
        for child, fk in foreign_key_edges():
            if fk.parent in frames and child not in frames and not MODEL[fk.parent].scheme_scoped and state.loads(child):
                orphans = fk_violations(self.table(child, state), frames[fk.parent],
                                        list(zip(fk.columns, fk.parent_columns)))
                parts.append(orphans.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(child).alias("tbl"), F.lit(f"orphan_{'_'.join(fk.columns)}").alias("check"), "n"))
        return reduce(DataFrame.unionByName, parts) if parts else None

    # -- cascades from any table -------------------------------------------
    def _retry(self, make: Callable[[State], tuple[dict, dict[str, int]]]) -> dict[str, int]:
        """Commit what ``make`` derives from the newest state, anew if another loader was first."""
        for _ in range(ATTEMPTS):
            state = self.log.state()
            commit, result = make(state)
            if self.log.append({"version": state.version + 1, **commit}):
                self._base = None
                return result
        raise PublishError(f"{ATTEMPTS} other loads were committed while this change tried")

    def delete_keys(self, name: str, keys: DataFrame) -> dict[str, int]:
        """J10 on the store: delete the rows of ``name`` whose primary key is in ``keys``, and
        with them every row that references them, through all levels (ON DELETE CASCADE; a
        NULL reference stays). Nothing is rewritten: the key values are written once as delete
        sets, committed as one version, applied by anti joins when tables are read, and
        written in by ``compact``. Returns the rows removed by table."""
        return self._retry(lambda state: self._delete(state, name, keys))

    def _delete(self, state: State, name: str, keys: DataFrame) -> tuple[dict, dict[str, int]]:
        pk = list(MODEL[name].primary_key)
        # (table, columns, their values): the named keys, then references to rows that go
        todo: list[tuple[str, tuple[str, ...], DataFrame]] = [(name, tuple(pk), keys.select(*pk).distinct())]
        sets: list[dict] = []
        while todo:
            table, columns, values = todo.pop(0)
            if not (loads := sorted(state.loads(table))):
                continue
            sid = uuid.uuid4().hex[:16]
            values.toDF(*[f"k{i}" for i in range(len(columns))]).write.parquet(self._path("_deletes", sid))
            values = self.spark.read.parquet(self._path("_deletes", sid))
            sets.append({"id": sid, "tbl": table, "columns": list(columns), "loads": loads})
            for child, fk in foreign_key_edges():
                if fk.parent != table:
                    continue
                if tuple(fk.parent_columns) == columns:  # the values are those that the child names
                    named = values.toDF(*fk.parent_columns)
                else:  # they are in the rows that go
                    rows = self._rows(table, state)
                    on = reduce(and_, [rows[c] == values[f"k{i}"] for i, c in enumerate(columns)])
                    named = rows.join(values, on, "left_semi").select(*fk.parent_columns).distinct()
                todo.append((child, tuple(fk.columns), named))
        after = State(state.version, state.entries, state.marks, [*state.deletes, *sets])
        removed, entries = {}, []
        for table in dict.fromkeys(d["tbl"] for d in sets):  # a row that goes for two reasons goes once
            left = {r["bms_id"]: r["n"] for r in self._rows(table, after).groupBy("bms_id").agg(F.count(F.lit(1)).alias("n")).collect()}
            for (t, b), e in state.entries.items():
                if t == table and e["rows"] != left.get(b, 0):
                    removed[t] = removed.get(t, 0) + e["rows"] - left.get(b, 0)
                    entries.append({"tbl": t, "bms_id": b, **e, "rows": left.get(b, 0)})
        return {"entries": entries, "deletes": [d for d in sets if d["tbl"] in removed]}, removed

    def rekey(self, name: str, mapping: DataFrame) -> dict[str, int]:
        """J11 on the store: rename key values of ``name`` (``mapping``: the key columns, and
        the same with ``new_`` before their names) in the table itself and in every reference to
        it, through all levels (ON UPDATE CASCADE), committed as one version. A renamed scheme
        takes its rows of every table along. Only schemes that hold a renamed value are written
        anew. A rename that makes two keys equal, or names an old key twice, is refused.
        Returns the rows changed by table."""
        pk = list(MODEL[name].primary_key)
        if not key_violations(mapping, pk).isEmpty():
            raise PublishError(f"rename refused: an old key of {name} is named twice")
        mapping = mapping.select(*[F.col(c).alias(f"old{i}") for i, c in enumerate(pk)], *[F.col(f"new_{c}").alias(f"new{i}") for i, c in enumerate(pk)])
        return self._retry(lambda state: self._rekey(state, name, pk, mapping))

    def _rekey(self, state: State, name: str, pk: list[str], mapping: DataFrame) -> tuple[dict, dict[str, int]]:
        load_id, renamed = uuid.uuid4().hex[:16], {}
        columns = rename_targets([(c, fk.columns, fk.parent, fk.parent_columns) for c, fk in foreign_key_edges()], name, pk)
        if pk == ["bms_id"]:  # a scheme also names the folders of tables that do not declare the column
            columns |= {t: [("bms_id",)] for t, spec in MODEL.items() if spec.scheme_scoped and t not in columns}
        commit: dict = {"removed": [], "entries": [], "marks": {}}
        for t, groups in columns.items():
            out = self._rows(t, state).withColumns({"__was": F.col("bms_id"), "__renamed": F.lit(False)})
            for cols in groups:
                out = rekey_columns(out, cols, mapping, "__renamed")
            if t == name and not key_violations(out, pk).isEmpty():
                raise PublishError(f"rename refused: it makes keys of {name} equal")
            serial = F.col(MODEL[t].serial) if MODEL[t].serial else F.lit(None).cast("long")
            per = out.groupBy("__was", "bms_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("__renamed").alias("k"), F.min(serial).alias("low"), F.max(serial).alias("high"))
            found = per.collect()  # a row per scheme, before and after
            touched = sorted({r["__was"] for r in found if r["k"]})
            if not touched:
                continue
            renamed[t] = sum(r["k"] for r in found)
            keep = [c for c in MODEL[t].schema.names if c != "bms_id"]
            out.where(F.col("__was").isin(*touched)).select(*keep, "bms_id").write.partitionBy("bms_id").parquet(self._path(t, f"load_id={load_id}"))
            commit["removed"] += [[t, b] for b in touched]
            for b in sorted({r["bms_id"] for r in found if r["__was"] in touched}):
                if (t, b) in state.entries and b not in touched and state.entries[t, b]["rows"]:
                    raise PublishError(f"rename refused: {t} has rows of {b} already")
                some = [r for r in found if r["bms_id"] == b and r["__was"] in touched]
                low, high = (f((r[c] for r in some if r[c] is not None), default=None) for f, c in ((min, "low"), (max, "high")))
                commit["entries"].append({"tbl": t, "bms_id": b, "load_id": load_id, "rows": sum(r["n"] for r in some), "shift": {}, "low": low, "high": high})
                if high is not None:
                    commit["marks"][t] = max(high, commit["marks"].get(t, 0))
        return commit, renamed

    def compact(self, names: Sequence[str] | None = None) -> dict[str, int]:
        """Write moved ids and delete sets into the files: every load that has any is written
        anew without, as one version. Returns the rows written by table."""
        return self._retry(lambda state: self._compact(state, list(names or MODEL)))

    def _compact(self, state: State, names: list[str]) -> tuple[dict, dict[str, int]]:
        load_id, entries, written = uuid.uuid4().hex[:16], [], {}
        for t in names:
            deleted = {lid for d in state.deletes if d["tbl"] == t for lid in d["loads"]}
            todo = {b: e for (x, b), e in state.entries.items() if x == t and (e.get("shift") or e["load_id"] in deleted)}
            if not todo:
                continue
            loads = sorted({e["load_id"] for e in todo.values()})
            keep = [c for c in MODEL[t].schema.names if c != "bms_id"]
            rows = self._rows(t, state).where(F.col("load_id").isin(*loads) & F.col("bms_id").isin(*todo))
            rows.select(*keep, "bms_id").write.partitionBy("bms_id").parquet(self._path(t, f"load_id={load_id}"))
            written[t] = sum(e["rows"] for e in todo.values())
            entries += [{"tbl": t, "bms_id": b, **e, "load_id": load_id, "shift": {}} for b, e in todo.items()]
        return {"entries": entries}, written

    # -- storage -----------------------------------------------------------
    def superseded_loads(self) -> list[tuple[str, str]]:
        """(table, load_id) pairs that an earlier version named and the current one does
        not. Loads never made current (in flight) are not listed. Kept in the state, so the
        history is not read."""
        return sorted((r["tbl"], r["load_id"]) for r in self.log.state().retired)

    # -- rejects -------------------------------------------------------------
    def keep_rejects(self, found: DataFrame, strict: bool = False) -> DataFrame:
        """F8: write the rejects of a load, ``(tbl, bms_id, col, value, n)``, beside the
        tables, counted by the writing job. ``strict`` refuses the load if there are any;
        the list stays and the refusal names its folder."""
        path, seen = self._path("_rejects", uuid.uuid4().hex[:16]), Observation()
        found.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("n")).write.parquet(path)
        if strict and (n := seen.get["n"]):
            raise PublishError(f"load refused: {n} rejected values, listed in {path}")
        return self.spark.read.schema(found.schema).parquet(path)

    def vacuum(self) -> int:
        """Remove the folders of superseded loads and delete sets (the storage half of the
        source's VACUUM) that no lease needs; returns how many folders were removed."""
        state, oldest = self.log.state(), self._leased()
        due = [(r["tbl"], r["load_id"]) for r in state.retired if not r.get("gone") and (oldest is None or r["version"] <= oldest)]
        n = drop_paths(self.spark, [self._path(t, lid if t == "_deletes" else f"load_id={lid}") for t, lid in due])
        if due or any(r.get("gone") for r in state.retired):
            self._retry(lambda state: ({"vacuumed": [list(x) for x in due]}, {}))
        return n

    def export_snapshot(self, path: str, fmt: str = "parquet") -> list[str]:
        """K7: every model table's current rows under one new snapshot folder
        (fails if it exists); CSV renders points as EWKT text."""
        state = self.log.state()
        done = []
        for name in MODEL:
            df = self.table(name, state)
            target = f"{path.rstrip('/')}/{name}"
            if fmt == "csv":
                geo = [f.name for f in df.schema.fields if f.dataType.typeName() == "struct"]
                df = df.select(*[ewkt(c).alias(c) if c in geo else F.col(c) for c in df.columns])
                df.write.mode("errorifexists").option("header", True).csv(target)
            else:
                df.write.mode("errorifexists").parquet(target)
            done.append(target)
        return done


def init_model(spark: SparkSession, root: str) -> Store:
    """K8: a new, empty model namespace: every table written empty with its
    declared schema, and a first, empty version. ``root`` must not exist yet."""
    store = Store(spark, root)
    for name, spec in MODEL.items():
        spark.createDataFrame([], spec.schema).write.mode("errorifexists").parquet(store._path("_schema", name))
    if not store.log.append({"version": 0}):
        raise PublishError(f"{root} has a commit log already")
    return store
