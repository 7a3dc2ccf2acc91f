"""Operator 5: suffix-array dedup over bytes.

Method: deep-shallow sorting of a sparse suffix array. Every string of
``length`` bytes contains an anchor, the 64-byte gram with the smallest
fingerprint in it, so two equal strings share an anchor at the same place. Only
anchors that occur twice or more can lie in a repeated string. Their suffixes
(and the texts before them, read backwards) are sorted group by group: multikey
quicksort on eight-byte keys to a shallow depth, then blind tries for the groups
that still share a long prefix. The common prefix lengths of neighbours in both
orders say for every place of the string around its anchor whether it occurs
again.

Anchors whose whole surroundings occur again are settled by one fingerprint and
are not sorted, but for one that stands for all. Groups beyond ``GROUP`` members
are split before sorting, as often as needed: the places of the string around
the anchor are halved, and each half goes by the longer text that all its
strings share, so strings that do not repeat fall apart; this is exact. Within a
batch, repeated surroundings and frequent anchors are settled or set aside at
once, so a passage that stands in a third of all documents does not meet in one
task.

Defined results: a NULL text is empty; texts shorter than ``length`` lose nothing;
repeated rows are elsewhere to each other; an empty table gives an empty result;
ties cannot matter; very long texts are treated whole, in overlapping blocks;
only ``id_col`` and ``text_col`` are read. Equality is that of 64-bit fingerprints
of anchors, and then of their bytes or of a second fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import U, binary_rows, map_arrow, mix, prefix, row_key, sliding_min, stage, table

#: Bytes of an anchor, and members of a group that is sorted without splitting.
GRAM, GROUP = 64, 10_000
#: Equal anchors in a batch from which on they count as frequent.
FREQUENT = 64
#: Multikey quicksort: bytes of a key, depth, and group size that goes to a trie at once.
KEY, SHALLOW, SMALL = 8, 32, 16
BLOCK = 1 << 20


def anchors(data: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, fingerprint, fingerprint of the surroundings) of a text's anchors."""
    n = len(data)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, U), np.empty(0, U)
    side = length - gram
    places, prints, around = [], [], []
    at = 0
    while at + length <= n:  # strings that start in [at, at + BLOCK)
        lo, hi = max(0, at - side), min(n, at + BLOCK + length - 1 + side)
        part = data[lo:hi]
        p, inv = prefix(part)
        g = mix((p[gram:] - p[:-gram]) * inv[: len(p) - gram])
        first = at - lo
        m = sliding_min(g[first : first + min(BLOCK + length - 1, n - at) - gram + 1], side + 1)
        # a gram is an anchor if it equals the largest of the minima of the strings around it
        pad = np.zeros(side, U)
        high = ~sliding_min(~np.concatenate([pad, m, pad]), side + 1)
        here = g[first : first + len(high)]
        a = np.flatnonzero(here == high) + first
        left, right = np.maximum(a - side, 0), np.minimum(a + length, len(part))
        c = mix((p[right] - p[left]) * inv[left] + ((a - left) * 1000 + (right - a)).astype(U) * U(0x9E3779B97F4A7C15))
        places.append(a + lo)
        prints.append(g[a])
        around.append(c)
        at += BLOCK
    place = np.concatenate(places)
    if len(places) > 1:
        place, keep = np.unique(place, return_index=True)
        return place, np.concatenate(prints)[keep], np.concatenate(around)[keep]
    return place, prints[0], around[0]


#: What a row of the first pass is: to be looked up; settled (a repeated place); a
#: settled place that stands for its like; a frequent anchor's place; a frequent anchor.
LOOK, DONE, STANDS, OFTEN, MARK = range(5)


def _first_pass(length: int):
    """Rows (h, c, rid, pos, kind) of the anchors of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = np.asarray(b.column(0))
            got = [anchors(data, length) for data in binary_rows(b.column(1))]
            pos = np.concatenate([g[0] for g in got]) if got else np.empty(0, np.int64)
            if not len(pos):
                continue
            h, c = np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])
            r = np.repeat(rid, [len(g[0]) for g in got])
            order = np.lexsort((c, h))
            h, c, r, pos = h[order], c[order], r[order], pos[order]
            new_h = np.concatenate([[True], h[1:] != h[:-1]])
            new_c = new_h | np.concatenate([[True], c[1:] != c[:-1]])
            size = lambda new: np.diff(np.append(np.flatnonzero(new), len(new)))
            same = np.repeat(size(new_c), size(new_c)) > 1
            stands = same & new_c
            # distinct surroundings left in each group of equal anchors
            often = np.repeat(np.add.reduceat(new_c.astype(np.int64), np.flatnonzero(new_h)), size(new_h)) > FREQUENT
            mark = np.flatnonzero(new_h & often)
            kind = np.where(same, DONE, np.where(often, OFTEN, LOOK))
            extra = np.flatnonzero(stands)
            rows = np.concatenate([np.arange(len(h)), extra, mark])
            kinds = np.concatenate([kind, np.where(often[extra], OFTEN + 2, STANDS), np.full(len(mark), MARK)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[rows].view(np.int64)), pa.array(c[rows].view(np.int64)), pa.array(r[rows]), pa.array(pos[rows], pa.int64()),
                 pa.array(kinds, pa.int32())], names=["h", "c", "rid", "pos", "kind"])

    return run


#: A settled place of a frequent anchor that stands for its like.
OFTEN_STANDS = OFTEN + 2


def _surroundings(length: int):
    """Rows (h, often, want, rid, pos, left, ctx): the bytes around the places asked for."""
    side = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid, off = np.asarray(b.column(0)), np.asarray(b.column(2).offsets)
            flat = b.column(2).values
            pos, h = np.asarray(flat.field(0)), np.asarray(flat.field(1))
            often, want = np.asarray(flat.field(2)), np.asarray(flat.field(3))
            texts = list(binary_rows(b.column(1)))
            ctx, left, size = [], [], 0
            first = off[0]
            for i in range(len(texts)):
                t = texts[i]
                for j in range(off[i], off[i + 1]):
                    p = int(pos[j])
                    lo = max(0, p - side)
                    left.append(p - lo)
                    ctx.append(t[lo : p + length].tobytes())
                    size += len(ctx[-1])
                if size > 1 << 22 or i == len(texts) - 1:
                    last = off[i + 1]
                    who = np.repeat(rid, np.diff(off))[first - off[0] : last - off[0]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[first:last]), pa.array(often[first:last]), pa.array(want[first:last]), pa.array(who),
                         pa.array(pos[first:last]), pa.array(left, pa.int32()), pa.array(ctx, pa.binary())],
                        names=["h", "often", "want", "rid", "pos", "left", "ctx"])
                    ctx, left, size, first = [], [], 0, last

    return run


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


class _Node:
    """A branch of a blind trie: the depth at which its strings differ first."""

    __slots__ = ("depth", "kids")

    def __init__(self, depth: int) -> None:
        self.depth, self.kids = depth, {}


def blind_trie(items: list[int], strings: list[bytes]) -> list[int]:
    """``items`` in the order of their strings. A string goes down by the branching
    bytes only, is compared once with the leaf it meets, and is then put in at the
    depth where they differ."""
    root: object = [items[0]]
    for i in items[1:]:
        s, node = strings[i], root
        while type(node) is _Node:
            node = node.kids.get(s[node.depth]) or next(iter(node.kids.values()))
        other = strings[node[0]]
        if s == other:
            node.append(i)
            continue
        d = _common(s, other)
        above, node = None, root
        while type(node) is _Node and node.depth < d:
            above, node = node, node.kids[s[node.depth]]
        if type(node) is _Node and node.depth == d:
            node.kids[s[d]] = [i]
            continue
        branch = _Node(d)
        branch.kids = {other[d]: node, s[d]: [i]}
        if above is None:
            root = branch
        else:
            above.kids[s[above.depth]] = branch
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if type(node) is _Node:
            todo.extend(node.kids[k] for k in sorted(node.kids, reverse=True))
        else:
            out += node
    return out


def deep_shallow(items: list[int], strings: list[bytes]) -> list[int]:
    """Sort ``items`` by their strings (of one length): multikey quicksort, three
    parts by the key at a depth, down to SHALLOW; tries for what is left."""
    out: list[int] = []
    todo = [(items, 0)]
    while todo:
        part, depth = todo.pop()
        if len(part) < 2:
            out += part
        elif len(part) <= SMALL or depth >= SHALLOW:
            out += blind_trie(part, strings)
        else:
            keys = [strings[i][depth : depth + KEY] for i in part]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [i for i, k in zip(part, keys, strict=True) if k < pivot]
            more = [i for i, k in zip(part, keys, strict=True) if k > pivot]
            same = [i for i, k in zip(part, keys, strict=True) if k == pivot]
            todo += [(more, depth), (same, depth + KEY), (less, depth)]
    return out


def _sorted(groups: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): members sorted within their groups (runs from groups[k] on),
    and each member's common prefix with the one before it (-1: another group)."""
    ends = np.append(groups[1:], len(strings))
    order: list[int] = []
    for s, e in zip(groups.tolist(), ends.tolist(), strict=True):
        order += deep_shallow(list(range(s, e)), strings)
    order_ = np.array(order)
    width = len(strings[0])
    common = np.full(len(strings), width, np.int64)
    if width:
        m = np.frombuffer(b"".join(strings), np.uint8).reshape(len(strings), width)[order_]
        differ = m[1:] != m[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[groups] = -1
    return order_, common


def repeated_places(gid: np.ndarray, a: np.ndarray, b: np.ndarray, pos: np.ndarray, left: np.ndarray, ctx: list[bytes],
                    length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, start, stop): the bytes around each member's anchor that lie in
    strings which another member of its group has too. Rows are sorted by group; a
    member's strings start a to b bytes before its anchor."""
    right = np.array([len(c) for c in ctx]) - left
    wide = int((b - a).max(initial=0))
    lo, hi = np.maximum(a, length - right), np.minimum(b, left)
    before = [c[max(0, x - z) : x - y][::-1].ljust(wide, b"\0") if x > y else bytes(wide)
              for c, x, y, z in zip(ctx, left.tolist(), a.tolist(), b.tolist(), strict=True)]
    behind = [c[x + length - z : x + length - y].ljust(wide, b"\0")
              for c, x, y, z in zip(ctx, left.tolist(), a.tolist(), b.tolist(), strict=True)]
    group = np.flatnonzero(np.concatenate([[True], (gid[1:] != gid[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    order_r, common_r = _sorted(group, behind)
    order_l, common_l = _sorted(group, before)
    ar, al, br = a[order_r], a[order_l], b[order_r]
    n = len(gid)
    cls_r, cls_l = np.empty(n, np.int64), np.empty(n, np.int64)
    open_from = np.full(n, -1, np.int64)
    who, start, stop = [], [], []

    def close(at: np.ndarray, s: int) -> None:
        """The places open_from..s-1 of these members repeat."""
        who.append(at)
        start.append(pos[at] - (s - 1))
        stop.append(pos[at] - open_from[at] + length)
        open_from[at] = -1

    first, last = int(a.min()), int(b.max())
    for s in range(first, last + 1):
        cls_r[order_r] = np.cumsum(common_r < br - s)
        cls_l[order_l] = np.cumsum(common_l < s - al)
        valid = np.flatnonzero((lo <= s) & (s <= hi))
        key = cls_r[valid] * (n + 1) + cls_l[valid]
        o = np.argsort(key, kind="stable")
        k = key[o]
        eq = k[1:] == k[:-1]
        again = np.zeros(n, bool)
        again[valid[o]] = np.concatenate([[False], eq]) | np.concatenate([eq, [False]]) if len(k) else False
        done = np.flatnonzero(~again & (open_from >= 0))
        if len(done):
            close(done, s)
        open_from[again & (open_from < 0)] = s
    done = np.flatnonzero(open_from >= 0)
    if len(done):
        close(done, last + 1)
    if not who:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(who), np.concatenate(start), np.concatenate(stop)


def _sort_groups(length: int):
    """Rows (rid, start, stop) from rows (gid, a, b, rid, pos, left, ctx, want) sorted
    by (gid, a, b): groups are taken together, across batches where they go on."""

    def flush(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        col = {c: np.asarray(t[c]) for c in ("gid", "a", "b", "rid", "pos", "left", "want")}
        who, start, stop = repeated_places(col["gid"], col["a"].astype(np.int64), col["b"].astype(np.int64), col["pos"],
                                           col["left"].astype(np.int64), t["ctx"].to_pylist(), length)
        keep = col["want"][who]
        return pa.RecordBatch.from_arrays([pa.array(col["rid"][who[keep]]), pa.array(start[keep]), pa.array(stop[keep])],
                                          names=["rid", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < 4000:
                continue
            g = np.asarray(held["gid"].combine_chunks())
            cut = int(np.searchsorted(g == g[-1], True))  # the last group may go on
            if cut:
                yield flush(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield flush(held)

    return run


def _split(spark: SparkSession, rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Large groups: (spans settled on the way, rows in groups small enough to sort)."""
    spans = small = None
    rows = rows.withColumn("a", F.lit(0)).withColumn("b", F.lit(length - GRAM))
    turn = 0
    while True:
        right = F.octet_length("ctx") - F.col("left")
        rows = rows.withColumn("lo", F.greatest(F.col("a"), F.lit(length) - right)).withColumn("hi", F.least("b", "left")).where("lo <= hi")
        part = lambda x, n: F.substring(F.col("ctx"), F.col("left") - x + 1, n)
        rows = rows.withColumn("gid", F.xxhash64("a", "b", part(F.col("a"), F.col("a") + length - F.col("b"))))
        rows = rows.withColumn("u", F.xxhash64("lo", "hi", part(F.col("hi"), F.col("hi") + length - F.col("lo"))))
        per = rows.groupBy("gid", "u").agg(F.count("*").alias("n"), F.min(F.struct("rid", "pos")).alias("one"))
        groups = per.groupBy("gid").agg(F.count("*").alias("classes"))
        seen = rows.join(per, ["gid", "u"]).join(groups, "gid").withColumn("stands", F.struct("rid", "pos") == F.col("one"))
        seen = seen.select("gid", "a", "b", "lo", "hi", "rid", "pos", "left", "ctx", "want", "n", "stands", "classes")
        seen = stage(spark, seen.where("n > 1 or classes > 1"), f"split{turn}")
        done = seen.where("n > 1 and want").select("rid", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("stop"))
        left = seen.where("classes > 1 and (n = 1 or stands)").withColumn("want", F.col("want") & (F.col("n") == 1))
        ready = left.where(F.col("classes") <= GROUP).select("gid", "a", "b", "rid", "pos", "left", "ctx", "want")
        spans = done if spans is None else spans.unionByName(done)
        small = ready if small is None else small.unionByName(ready)
        large = left.where(F.col("classes") > GROUP)
        if large.limit(1).count() == 0:
            return spans, small
        mid = F.expr("(a + b) div 2").cast("int")
        halves = F.explode(F.array(F.struct(F.col("a").alias("x"), mid.alias("y")), F.struct((mid + 1).alias("x"), F.col("b").alias("y"))))
        rows = large.withColumn("half", halves).select("rid", "pos", "left", "ctx", "want", F.col("half.x").alias("a"), F.col("half.y").alias("b"))
        turn += 1


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, start, stop): bytes of each row key's text that lie in a string of
    ``length`` bytes which starts somewhere else too (spans may overlap)."""
    side = length - GRAM
    src = docs.select(row_key(id_col, text_col).alias("rid"), F.col(text_col).cast("binary").alias("text")).where(
        F.octet_length(text_col) >= length)
    rows = map_arrow(src, _first_pass(length), "h long, c long, rid long, pos long, kind int")
    meets = F.col("kind").isin(LOOK, STANDS, MARK)
    rows = rows.withColumn("key", F.when(meets, F.col("h")).otherwise(F.xxhash64("rid", "pos")))
    w, wc = Window.partitionBy("key"), Window.partitionBy("key", "c")
    rows = rows.withColumn("n", F.sum((F.col("kind") != MARK).cast("int")).over(w)).withColumn("often", F.max((F.col("kind") == MARK).cast("int")).over(w))
    rows = rows.withColumn("nc", F.sum((F.col("kind") != MARK).cast("int")).over(wc))
    rows = rows.withColumn("stands", F.struct("kind", "rid", "pos") == F.min(F.when(F.col("kind") != MARK, F.struct("kind", "rid", "pos"))).over(wc))
    done = (F.col("kind") == DONE) | ((F.col("kind") == LOOK) & (F.col("nc") > 1))
    alone = (F.col("kind") == OFTEN) | ((F.col("kind") == LOOK) & (F.col("nc") == 1) & ((F.col("n") > 1) | (F.col("often") == 1)))
    like = (F.col("kind") == OFTEN_STANDS) | (F.col("kind").isin(LOOK, STANDS) & (F.col("nc") >= 1) & F.col("stands") & ((F.col("n") > F.col("nc")) | (F.col("often") == 1)))
    rows = rows.select("h", "rid", "pos", done.alias("done"), alone.alias("want"), (alone | like).alias("ask"),
                       (F.col("kind").isin(OFTEN, OFTEN_STANDS) | (F.col("often") == 1) | (F.col("n") > GROUP)).alias("often"))
    found = stage(spark, rows.where("done or ask"), "anchors")
    spans = found.where("done").select("rid", F.greatest(F.col("pos") - side, F.lit(0)).alias("start"), (F.col("pos") + length).alias("stop"))

    ask = found.where("ask").groupBy("rid").agg(F.collect_list(F.struct("pos", "h", "often", "want")).alias("ask"))
    near = map_arrow(src.join(ask, "rid").select("rid", "text", "ask"), _surroundings(length),
                     "h long, often boolean, want boolean, rid long, pos long, left int, ctx binary")
    near = stage(spark, near, "surroundings")
    sort = near.where("not often").select(F.col("h").alias("gid"), F.lit(0).alias("a"), F.lit(side).alias("b"), "rid", "pos", "left", "ctx", "want")
    hot = near.where("often").drop("h", "often")
    if hot.limit(1).count():
        more, small = _split(spark, hot, length)
        spans, sort = spans.unionByName(more), sort.unionByName(small)
    sort = sort.repartition("gid", "a", "b").sortWithinPartitions("gid", "a", "b")
    last = map_arrow(sort, _sort_groups(length), "rid long, start long, stop long")
    return stage(spark, spans.unionByName(last), "spans")


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): ``spans`` are the maximal removed byte
    runs [start, stop), ``kept`` the remaining bytes (binary: a cut may split a
    character)."""
    found = repeated_spans(spark, docs, length, id_col, text_col)
    per = found.groupBy("rid").agg(F.collect_list("start").alias("start"), F.collect_list(F.struct("start", "stop")).alias("both"))
    per = per.select("rid", F.transform("both", lambda x: x["start"]).alias("start"), F.transform("both", lambda x: x["stop"]).alias("stop"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, stops, out, size = b.column(2), b.column(3), [], 0
            first = 0
            for i, data in enumerate(binary_rows(b.column(1))):
                n = len(data)
                runs = []
                if starts[i].is_valid:
                    s, e = np.asarray(starts[i].values), np.minimum(np.asarray(stops[i].values), n)
                    o = np.argsort(s, kind="stable")
                    s, e = s[o], np.maximum.accumulate(e[o])
                    new = np.concatenate([[True], s[1:] > e[:-1]])
                    runs = list(zip(s[new].tolist(), e[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)].tolist(), strict=True))
                kept, at = [], 0
                for x, y in runs:
                    kept.append(data[at:x])
                    at = y
                kept.append(data[at:])
                kept = np.concatenate(kept).tobytes()
                size += len(kept)
                out.append((n, n - len(kept), [{"start": x, "stop": y} for x, y in runs], kept))
                if size > 1 << 23 or i == b.num_rows - 1:
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(first, len(out)), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                         pa.array(cols[2], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(cols[3], pa.binary())],
                        names=[id_col, "n_bytes", "n_removed", "spans", "kept"])
                    out, size, first = [], 0, i + 1

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(row_key(id_col, text_col).alias("rid"), id_col, F.col(text_col).cast("binary").alias("__text"))
    src = src.join(per, "rid", "left").select(id_col, "__text", "start", "stop")
    return map_arrow(src, cut, f"`{id_col}` {kind}, n_bytes long, n_removed long, spans array<struct<start:bigint,stop:bigint>>, kept binary")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
