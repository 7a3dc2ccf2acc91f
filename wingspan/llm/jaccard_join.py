"""Operator 7: n-gram Jaccard self-join of whole documents.

Method: size-aware heavy-light join. A document is the set of its distinct
five-word shingles; equal sets are one node from the start. Small sets enumerate
subsets of a fixed size: two sets of n and m shingles reach the similarity just
if they share ceil(t (n + m) / (1 + t)) shingles, so each small set writes all its
subsets of that size for every size its partner can have, and equal subsets are
links. Large sets are found by scanning inverted lists over the part of a set
that every partner must touch, rarest shingles first, and each candidate is
compared exactly. The boundary between small and large is the size with the
least total cost: number of subsets against list entries and comparisons, from
the counts of the smallest set sizes. Candidates are first held against parity
signatures of the sets, a thirtieth of their size: sets differ in at least as
many shingles as their signatures in cells, so this loses no pair.

Pairs are written out for short lists only. Each set with longer lists goes, once,
to the group of its longest list, and a group is compared exactly inside a task
(beyond ``BLOCK`` members in blocks, every two of which meet); it reports just the
links that connect its similar sets. What remains are pairs of one list but of
different groups and components; these are compared one by one. So every pair
of a list is either compared or connected, and none is lost.

Which shingles count as frequent only orders the lists (any fixed order is
right): each task reports shingles that several of its documents share, and the
``HEAVY`` most frequent are put last.

Defined results: NULL or wordless texts have an empty set and are linked with
nothing (their component is their own id); fewer words than a shingle give one
shingle of the whole sequence; rows with equal sets are linked, repeated rows
included; a NULL id counts as larger than all ids and is returned where a
component has no other; an empty table gives an empty result; very long texts
are treated whole; only ``id_col`` and ``text_col`` are read. Shingles and sets
are 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import U, binary_rows, grams, map_arrow, mix, row_key, stage, table, word_hashes
from wingspan.llm.components import components

#: Frequent shingles that order the lists (64-bit numbers sent to every task).
HEAVY = 1 << 18
#: Set sizes among which the boundary is chosen.
SMALL_SIZES = 16
#: Cost of a list entry, counted in subsets: its row, and its share of comparisons.
ENTRY_COST = 3.0
#: Members of a list whose pairs are written out; longer lists are compared in blocks of BLOCK.
SHORT_LIST, BLOCK = 6, 1000


def need(n: int, m: int, t: int) -> int:
    """Least intersection of sets of n and m shingles that are t percent similar."""
    return -(-t * (n + m) // (100 + t))


def partners(n: int, t: int) -> range:
    """Sizes a partner can have."""
    return range(-(-t * n // 100), 100 * n // t + 1)


def prefix_length(n: int, t: int) -> int:
    """How many of its first shingles a set needs so that it meets every partner's."""
    return n - -(-t * n // 100) + 1


def shingles(data: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct shingle fingerprints of a text."""
    words = word_hashes(data, lower=True)
    return np.unique(grams(words, min(k, len(words)))) if len(words) else np.empty(0, U)


def _print(s: np.ndarray) -> int:
    """Fingerprint of a set."""
    if not len(s):
        return 0
    h = mix(np.array([(s * U(0x9FB21C651E98DF25)).sum(dtype=U) ^ np.bitwise_xor.reduce(mix(s.copy())) + U(len(s))], U))
    return int(h.view(np.int64)[0])


def _signature(s: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each of at least 2n cells, as 64-bit words."""
    if not len(s):
        return np.empty(0, np.int64)
    cells = 1 << max(6, int(2 * len(s) - 1).bit_length())
    odd = np.bincount((s & U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _profile(k: int):
    """Rows (rid, id, n, node, token, count, sig): a row for every document, and one for
    every shingle that several different sets of the batch hold."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, sigs, held, seen, freq = [], [], [], [], set(), []
            for i, data in enumerate(binary_rows(b.column(2))):
                s = shingles(data, k)
                sizes.append(len(s))
                nodes.append(_print(s))
                sigs.append(_signature(s))
                if nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    held.append(s)
                if held and (i % 4000 == 3999 or i == b.num_rows - 1):
                    v, c = np.unique(np.concatenate(held), return_counts=True)
                    freq.append((v[c > 1], c[c > 1]))
                    held = []
            v, c = (np.concatenate([f[j] for f in freq]) if freq else np.empty(0, U if j == 0 else np.int64) for j in (0, 1))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [*(pa.concat_arrays([b.column(j), pa.nulls(len(v), pa.int64())]) for j in (0, 1)), pa.array(sizes + [None] * len(v), pa.int64()),
                 pa.array(nodes + [None] * len(v), pa.int64()), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(v.view(np.int64))]),
                 pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c, pa.int64())]),
                 pa.array(sigs + [None] * len(v), pa.list_(pa.int64()))], names=["rid", "id", "n", "node", "token", "count", "sig"])

    return profile


def boundary(counts: dict[int, int], t: int) -> int:
    """The size up to which sets enumerate subsets: least total cost."""
    best, pick, below = 0.0, 0, 0.0
    for n in range(1, SMALL_SIZES + 1):
        subsets = sum(comb(n, need(n, m, t)) for m in partners(n, t) if need(n, m, t) <= min(n, m))
        below += counts.get(n, 0) * (subsets - ENTRY_COST * prefix_length(n, t))
        if below <= best:
            best, pick = below, n
    return pick


def _keys(k: int, t: int, small: int, heavy_sorted: np.ndarray, heavy_rank: np.ndarray):
    """Rows (token, node, n, pair): for every distinct set of a batch, its subsets
    (pair = larger size * 1000 + smaller size) and its list entries (pair = 0)."""

    def order(s: np.ndarray) -> np.ndarray:
        if not len(heavy_sorted):
            return s
        at = np.minimum(np.searchsorted(heavy_sorted, s), len(heavy_sorted) - 1)
        rank = np.where(heavy_sorted[at] == s, heavy_rank[at], -1)
        return s[np.argsort(rank, kind="stable")]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, who, size, pairs, seen = [], [], [], [], set()
            for data in binary_rows(b.column(0)):
                s = shingles(data, k)
                n, node = len(s), _print(s)
                if not n or node in seen:
                    continue
                seen.add(node)
                if n > small or 100 * n // t > small:  # a partner may be large
                    got = order(s)[: prefix_length(n, t)]
                    out.append(got)
                    pairs.append(np.zeros(len(got), np.int64))
                    who.append(np.full(len(got), node, np.int64))
                    size.append(np.full(len(got), n, np.int64))
                if n <= small:
                    for m in partners(n, t):
                        c = need(n, m, t)
                        if m <= small and m > 0 and c <= min(n, m):
                            pick = np.array(list(combinations(range(n), c)))
                            tag = max(n, m) * 1000 + min(n, m)
                            got = mix(mix(s.copy())[pick].sum(axis=1, dtype=U) + mix(np.array([tag], U)))
                            out.append(got)
                            pairs.append(np.full(len(got), tag, np.int64))
                            who.append(np.full(len(got), node, np.int64))
                            size.append(np.full(len(got), n, np.int64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(who)),
                                                  pa.array(np.concatenate(size)), pa.array(np.concatenate(pairs))],
                                                 names=["token", "node", "n", "pair"])

    return keys


def _close(a: str, b: str, t: int):
    return (100 * F.least(a, b) >= t * F.greatest(a, b))


def join_documents(spark: SparkSession, docs: DataFrame, k: int = 5, t: int = 80, id_col: str = "doc_id",
                   text_col: str = "text", keys_too: bool = False) -> DataFrame:
    """(id, n_shingles, component): one row for every row of ``docs``; two documents
    are linked if their shingle sets are at least t percent similar. ``keys_too`` adds
    rid, the row key, and node, the same for all rows of a component (NULL without words)."""
    src = docs.select(row_key(id_col, text_col).alias("rid"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    profile = stage(spark, map_arrow(src, _profile(k), "rid long, id long, n long, node long, token long, count long, sig array<bigint>"), "profile")
    rows = profile.where("node is not null").select("rid", "id", "n", "node")
    counts = {r["n"]: r["c"] for r in rows.where(F.col("n").between(1, SMALL_SIZES)).groupBy("n").agg(F.count("*").alias("c")).collect()}
    small = boundary(counts, t)
    heavy = profile.where("token is not null").groupBy("token").agg(F.sum("count").alias("c")).orderBy(F.desc("c"), "token").limit(HEAVY)
    got = heavy.toArrow()  # HEAVY rows at most
    tokens = np.asarray(got["token"]).view(U)
    by = np.argsort(tokens)
    rank = len(tokens) - np.arange(len(tokens))

    keys = map_arrow(src.select("text"), _keys(k, t, small, tokens[by], rank[by]), "token long, node long, n long, pair long")
    # the distinct members of each list, dealt by its token alone; lists of one go
    member = keys.repartition("token").dropDuplicates(["token", "node"])
    member = member.withColumn("m", F.count("*").over(Window.partitionBy("token"))).where("m > 1")
    lists = stage(spark, member, "lists")

    # equal subsets are links: all pairs of the two sizes, so a star from either size's first node does
    sub = lists.where("pair > 0").withColumn("low", F.expr("pair % 1000"))
    first = sub.groupBy("token", "pair").agg(F.min(F.when(F.col("n") == F.col("low"), F.col("node"))).alias("x"),
                                             F.min(F.when(F.col("n") != F.col("low"), F.col("node"))).alias("y"))
    both = sub.join(first, ["token", "pair"])
    same = F.col("low") == F.expr("pair div 1000")
    links = both.select("node", F.when(same | (F.col("n") != F.col("low")), F.col("x")).otherwise(F.col("y")).alias("to"))
    links = links.where("to is not null and node <> to").distinct()
    links = stage(spark, links.select(F.col("node").alias("a"), F.col("to").alias("b")), "subset-links")

    lists = lists.where("pair = 0").select("token", "node", "n", "m")
    signs = profile.where("n > 0").groupBy("node").agg(F.min("rid").alias("rid"), F.first("sig").alias("sig"))
    signs = stage(spark, signs.join(lists.select("node").distinct(), "node", "left_semi"), "signs")
    short, long = lists.where(f"m <= {SHORT_LIST}"), lists.where(f"m > {SHORT_LIST}")
    close = stage(spark, _plausible(_short_pairs(short, t), signs, t), "close")
    group = long.groupBy("node").agg(F.max(F.struct("m", "token")).alias("g")).join(long.groupBy("node").agg(F.first("n").alias("n")), "node")
    group = group.select("node", "n", F.col("g.token").alias("group"))
    group = stage(spark, group, "groups")
    signed = group.join(signs.select("node", "sig"), "node")
    wanted = _per_group(_dealt(signed, "group"), ["node", "n", "sig"], _with_partner(t), "node long")
    wanted = stage(spark, wanted.distinct(), "wanted")
    sets = _sets_of(spark, _ends(close).unionByName(wanted).distinct(), src, signs, k)
    links = links.unionByName(_compare(close, sets, t)).unionByName(_within_groups(group.join(wanted, "node"), sets, t))
    links = stage(spark, links.distinct(), "links")
    label = stage(spark, components(spark, links), "labels")
    rest = stage(spark, _cross_pairs(long, group, label, signs, t), "cross")
    if rest.limit(1).count():
        found = _compare(rest, _sets_of(spark, _ends(rest).distinct(), src, signs, k), t)
        label = label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found)
        label = stage(spark, components(spark, label), "labels")

    least = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    least = least.join(label, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    of = least.join(smallest, "component").select("node", "component_id", "component")
    out = rows.join(of, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                      *(["rid", F.when(F.col("n") > 0, F.col("component")).alias("node")] if keys_too else []))


def _sets(k: int):
    """Rows (node, shingles): the sets of the texts."""

    def batch(node: list, off: list, vals: list) -> pa.RecordBatch:
        arr = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(vals).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), arr], names=["node", "shingles"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, off, vals = [], [0], []
            for data in binary_rows(b.column(0)):
                s = shingles(data, k)
                node.append(_print(s))
                vals.append(s)
                off.append(off[-1] + len(s))
                if off[-1] > 1 << 20:
                    yield batch(node, off, vals)
                    node, off, vals = [], [0], []
            if node:
                yield batch(node, off, vals)

    return sets


def _short_pairs(short: DataFrame, t: int) -> DataFrame:
    """All pairs of the short lists, each once."""
    a = short.select("token", F.col("node").alias("a"), F.col("n").alias("na"))
    b = short.select("token", F.col("node").alias("b"), F.col("n").alias("nb"))
    return a.join(b, "token").where((F.col("a") < F.col("b")) & _close("na", "nb", t)).drop("token").distinct()


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Adds (x, y): the members of a group up to BLOCK are one block (0, 0); those of
    a larger group are dealt into blocks, and every two blocks meet at (x, y)."""
    size = rows.groupBy(key).agg(F.count("*").alias("__m")).where("__m > 1")
    rows = rows.join(size, key).withColumn("__blocks", F.ceil(F.col("__m") / BLOCK).cast("int"))
    rows = rows.withColumn("__mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col("__blocks")).cast("int"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    rows = rows.withColumn("x", F.least("__mine", "__other")).withColumn("y", F.greatest("__mine", "__other"))
    return rows.withColumnRenamed(key, "__key").drop("__m", "__blocks", "__mine", "__other")


def _per_group(rows: DataFrame, names: list[str], f: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """f over the rows of each (key, x, y) of ``_dealt``, group by group within a task."""
    keys = ["__key", "x", "y"]
    rows = rows.select(*keys, *names).repartition(*keys).sortWithinPartitions(*keys)

    def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        cols = [np.asarray(t[c]) for c in keys]
        edge = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)]))
        for s, e in zip(edge.tolist(), np.append(edge[1:], t.num_rows).tolist(), strict=True):
            if e - s > 1 and (out := f(t.slice(s, e - s).combine_chunks())) is not None:
                yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            cols = [np.asarray(held[c].combine_chunks()) for c in keys]
            cut = int(np.flatnonzero(np.all([c == c[-1] for c in cols], axis=0))[0])  # the last group may go on
            if cut:
                yield from flush(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from flush(held)

    return map_arrow(rows, run, schema)


def _arrays(t: pa.Table, name: str) -> list[np.ndarray]:
    col = t[name].combine_chunks()
    off, flat = np.asarray(col.offsets), np.asarray(col.values)
    return [flat[off[i] : off[i + 1]] for i in range(len(col))]


def _near(sigs: list[np.ndarray], n: np.ndarray, t: int) -> np.ndarray:
    """Matrix of the pairs that their signatures allow (see ``_plausible``); the longer
    signature is folded to the other's length, and further apart none can match."""
    words = np.array([len(s) for s in sigs])
    out = np.zeros((len(sigs), len(sigs)), bool)
    for w in np.unique(words):
        at = np.flatnonzero((words == w) | (words == 2 * w))
        rows = np.stack([sigs[i] if words[i] == w else sigs[i][:w] ^ sigs[i][w:] for i in at]).view(U)
        differ = np.zeros((len(at), len(at)), np.int32)
        for j in range(w):
            differ += np.bitwise_count(rows[:, None, j] ^ rows[None, :, j])
        both = n[at][:, None] + n[at][None, :]
        ok = (100 + t) * (both - differ) >= 2 * t * both
        ok &= 100 * np.minimum(n[at][:, None], n[at][None, :]) >= t * np.maximum(n[at][:, None], n[at][None, :])
        out[np.ix_(at, at)] |= ok & ((words[at] == w)[:, None] | (words[at] == w)[None, :])
    np.fill_diagonal(out, False)
    return out


def _with_partner(t: int):
    """The members of a group that may be similar to another member."""

    def f(rows: pa.Table) -> pa.RecordBatch:
        near = _near(_arrays(rows, "sig"), np.asarray(rows["n"].combine_chunks()), t)
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(rows["node"].combine_chunks())[near.any(axis=0)])], names=["node"])

    return f


def _cross_pairs(long: DataFrame, group: DataFrame, label: DataFrame, signs: DataFrame, t: int) -> DataFrame:
    """Pairs (a, b) of the long lists that no group has compared and no link connects,
    and that their signatures allow."""
    now = long.join(group.select("node", "group"), "node").join(label, "node", "left").withColumn("label", F.coalesce("component", "node"))
    per = now.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("group").alias("c"), F.max("group").alias("d"))
    now = now.join(per.where("a < b and c < d").select("token"), "token").join(signs.select("node", "sig"), "node")

    def f(rows: pa.Table) -> pa.RecordBatch | None:
        node, grp, lab, n = (np.asarray(rows[c].combine_chunks()) for c in ("node", "group", "label", "n"))
        near = _near(_arrays(rows, "sig"), n, t) & (grp[:, None] != grp[None, :]) & (lab[:, None] != lab[None, :])
        i, j = np.nonzero(near & (node[:, None] < node[None, :]))
        return pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["a", "b"]) if len(i) else None

    rows = now.select("token", "node", "n", "group", "label", "sig")
    return _per_group(_dealt(rows, "token"), ["node", "n", "group", "label", "sig"], f, "a long, b long").distinct()


def _joined(sets: list[np.ndarray], node: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root): the components of the similar pairs among some sets, by all
    their exact intersections (columns of shared shingles, a part at a time)."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.float32)
    flat, who = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[inverse]
    column, who = (np.cumsum(shared) - 1)[inverse[keep]], who[keep]
    order = np.argsort(column, kind="stable")
    column, who = column[order], who[order]
    common = np.zeros((m, m), np.float32)
    total, step = int(shared.sum()), 2048
    for c in range(0, total, step):
        lo, hi = np.searchsorted(column, [c, c + step])
        part = np.zeros((m, step), np.float32)
        part[who[lo:hi], column[lo:hi] - c] = 1
        common += part @ part.T
    similar = 100 * common >= t * (size[:, None] + size[None, :] - common)
    root = np.full(m, -1)
    for i in range(m):
        if root[i] < 0:
            root[i], front = i, [i]
            while front:
                new = np.flatnonzero(similar[front].any(axis=0) & (root < 0))
                root[new] = i
                front = new.tolist()
    linked = root != np.arange(m)
    return node[linked], node[root[linked]]


def _within_groups(group: DataFrame, sets: DataFrame, t: int) -> DataFrame:
    """Links (a, b) that connect whatever is similar within a group."""

    def f(rows: pa.Table) -> pa.RecordBatch:
        a, b = _joined(_arrays(rows, "shingles"), np.asarray(rows["node"].combine_chunks()), t)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _per_group(_dealt(group.select("node", "group"), "group").join(sets.hint("merge"), "node"), ["node", "shingles"], f, "a long, b long")


def _sets_of(spark: SparkSession, nodes: DataFrame, src: DataFrame, signs: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of some nodes, from the text of one row of each."""
    # the same join at every size: texts are dealt by row key (a broadcast would end beyond its limit)
    texts = src.select("rid", "text").join(signs.join(nodes, "node").select("rid").hint("merge"), "rid").select("text")
    return stage(spark, map_arrow(texts, _sets(k), "node long, shingles array<bigint>"), "sets")


def _plausible(pairs: DataFrame, signs: DataFrame, t: int) -> DataFrame:
    """The pairs that can be similar enough by their signatures: sets differ in at
    least as many shingles as their signatures in cells, so none is lost."""
    x = signs.select(F.col("node").alias("a"), F.col("sig").alias("x"))
    y = signs.select(F.col("node").alias("b"), F.col("sig").alias("y"))
    xor = lambda p, q: p.bitwiseXOR(q)

    def fold(c: str, other: str) -> Column:
        """Half as many cells, where the other set has that many."""
        half = (F.size(c) / 2).cast("int")
        return F.when(F.size(c) > F.size(other), F.zip_with(F.slice(c, F.lit(1), half), F.slice(c, half + 1, half), xor)).otherwise(F.col(c))

    both = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").select("a", "b", "na", "nb", fold("x", "y").alias("x"), fold("y", "x").alias("y"))
    differ = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, c: s + c)
    # similar enough: 100 * common >= t * (na + nb - common), with common <= (na + nb - differ) / 2
    return both.where((100 + t) * (F.col("na") + F.col("nb") - differ) >= 2 * t * (F.col("na") + F.col("nb"))).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _compare(pairs: DataFrame, sets: DataFrame, t: int) -> DataFrame:
    """The pairs that are similar enough, by their whole sets."""
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= t * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(spark, table(spark, sf_dir, "documents"))
