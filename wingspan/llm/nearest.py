"""Operator 13: approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner products are brought to Euclidean distance on the unit sphere: a
row x becomes (x / M, sqrt(1 - |x|^2 / M^2)) with M the largest norm, a query q
becomes (q / |q|, 0). A table of the index hashes a unit vector y by ``width``
functions floor((a . y + b) / w) with Gaussian, hence 2-stable, directions a and
random offsets b; the functions' numbers are the bucket. The directions of all
tables are made orthogonal as far as the dimension allows, so that the tables
fail independently.

Multiprobe: a row at cosine c from the query projects to a . x around c (a . q)
with deviation sqrt((1 - c^2) (|a|^2 - (a . q)^2) / d), which gives each
function's numbers their chances and, multiplied, each perturbed bucket its
chance of holding a wanted neighbour. Buckets are visited in order of estimated
success per row that has to be looked at (chance over the bucket's expected
share of the rows), until the chances visited in every table add up to what
``recall`` asks for over all tables. c is the query's own: its similarity to the
row of the sample that stands for its ``top``-th neighbour. The buckets of the
sample's rows nearest to the query are visited first: where many rows lie close
together, success is known there and the estimate per row would put them last. Rows in visited
buckets are candidates, and only they; the tables' candidates are merged and
reranked by their exact scores on the original vectors.

The index is fitted on a sample of SAMPLE rows at most (widths, shares of the
functions' numbers, c); every row is indexed. The number of functions grows with
the logarithm of the rows, so that buckets keep their size. A query that finds
fewer than ``top`` rows visits all buckets in a second pass, so that nobody
lacks neighbours.

Scale: rows and queries meet in cells. A cell is a share of a table's buckets
of about CELL rows, or a slice of that size of one bucket; buckets larger than
that are found by exact counts and sliced, and a table of N rows has at most
tables * N / heavy_limit(N) of those, at most HEAVY in all, so their list is
bounded. A task holds one cell's rows and reads its queries as a stream, so
no pairs are written: each task merges what it finds and returns ``top`` rows a
query.

Defined results: vectors that are NULL, empty, zero, or hold NULL, NaN or
infinite components, and rows with NULL vec_id take no part; shorter vectors
count as padded with zeros; rows equal in id and vector count once; rows with
one id and different vectors are different rows, each a query and each the
other's candidate; ties go to the smaller vec_id; an empty table gives no rows;
only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import map_arrow, mix, stage, table

#: Rows that the index is fitted on, at most.
SAMPLE = 4096
#: Rows of a cell, about.
CELL = 8192
#: Buckets on the list of those that are sliced, at most.
HEAVY = 1_000_000
#: Rows that a bucket holds on average when the number of functions is chosen.
BUCKET = 32
#: Numbers of a function are kept within this many of 0.
REACH = 7
#: Rows of the sample beyond ``Index.rank`` whose buckets a query visits in any case.
KNOWN = 8
U = np.uint64


def heavy_limit(rows: int, tables: int) -> int:
    """Buckets with more rows are sliced; HEAVY of them at most."""
    return max(CELL, tables * rows // HEAVY + 1)


@dataclass
class Index:
    """The fitted index: small, sent to every task."""

    dim: int  # of the original vectors
    norm: float  # the largest one
    directions: np.ndarray  # tables x width x (dim + 1)
    offsets: np.ndarray  # tables x width
    step: np.ndarray  # tables x width: w of each function
    share: np.ndarray  # tables x width x numbers: of the sample's rows
    sample: np.ndarray  # unit vectors
    rank: int  # of the sample's rows, the one that stands for a query's top-th neighbour
    cells: int  # per table
    success: float  # chances to visit in each table
    heavy: dict[int, tuple[int, int]]  # bucket -> (place on the list, slices)

    @property
    def tables(self) -> int:
        return len(self.directions)

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Rows on the unit sphere."""
        y = x / self.norm
        return np.hstack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1)))[:, None]])

    def aim(self, q: np.ndarray) -> np.ndarray:
        """Queries on the unit sphere."""
        return np.hstack([q / np.sqrt((q * q).sum(1))[:, None], np.zeros((len(q), 1))])

    def numbers(self, y: np.ndarray, t: int) -> np.ndarray:
        """The functions' numbers, from 0 to 2 * REACH."""
        h = np.floor((y @ self.directions[t].T + self.offsets[t]) / self.step[t])
        return (np.clip(h, -REACH, REACH) + REACH).astype(np.int64)

    def bucket(self, numbers: np.ndarray, t: int) -> np.ndarray:
        """A bucket's name; the numbers of up to 15 functions are kept exactly."""
        name = np.full(len(numbers), t, np.int64)
        for column in numbers.T:
            name = name * (2 * REACH + 2) + column
        return name

    def cell(self, bucket: np.ndarray, t: int) -> np.ndarray:
        """The cell of a bucket that is not sliced."""
        return t * (1 << 40) + (mix(bucket.astype(U)) % U(self.cells)).astype(np.int64)

    def slices(self, bucket: int) -> list[int]:
        place, n = self.heavy[bucket]
        return [-(1 + place * (1 << 32) + s) for s in range(n)]


def _phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function."""
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


def chances(index: Index, q: np.ndarray, t: int, cosine: float) -> np.ndarray:
    """width x numbers: the chance that a row at this cosine has each number."""
    a, b, w = index.directions[t], index.offsets[t], index.step[t]
    at = a @ q
    spread = np.sqrt(np.maximum(1e-18, (1 - cosine**2) * ((a * a).sum(1) - at**2) / max(1, index.dim - 1)))
    edges = (np.arange(-REACH + 1, REACH + 1)[None, :] * w[:, None] - b[:, None] - cosine * at[:, None]) / spread[:, None]
    cumulative = np.hstack([np.zeros((len(a), 1)), _phi(edges), np.ones((len(a), 1))])
    return np.diff(cumulative, axis=1)


def probes(index: Index, q: np.ndarray, t: int, cosine: float, fall: list[float] | None = None) -> np.ndarray:
    """The numbers of the buckets to visit in table t, best estimated success first:
    partial buckets are extended function by function and kept while their best
    extension can reach the threshold, which falls until the chances suffice.
    ``fall`` keeps how far it had to fall for the query before, where this one begins."""
    width = index.directions.shape[1]
    if width == 0:
        return np.empty((1, 0), np.int64)
    p = chances(index, q, t, cosine)
    gain = np.log(np.maximum(p, 1e-300)) - np.log(index.share[t])
    worth = p > 1e-2 * p.max(1, keepdims=True)  # numbers next to never taken are not listed
    best = np.where(worth, gain, -np.inf).max(1)
    rest = np.append(np.cumsum(best[::-1])[::-1][1:], 0.0)  # what the functions behind can add at best
    step, radix = 0.25 * math.sqrt(width), 2 * REACH + 2
    fall = [step] if fall is None else fall
    drop, tries = max(step, fall[0]), 0
    while True:
        low, code, score, chance = best.sum() - drop, np.zeros(1, np.int64), np.zeros(1), np.ones(1)
        for i in range(width):
            options = np.flatnonzero(worth[i])
            s = score[:, None] + gain[i, options][None, :]
            before, behind = np.nonzero(s + rest[i] >= low)
            code = code[before] * radix + options[behind]
            score, chance = s[before, behind], chance[before] * p[i, options[behind]]
        tries += 1
        enough = chance.sum() >= index.success
        if enough or len(code) >= np.prod(worth.sum(1)):  # the second: nothing is left to list
            # the next query begins a little above where this one ended
            fall[0] = drop if tries > 1 else drop - 0.1 * step
            order = np.argsort(-score, kind="stable")
            if enough:
                order = order[: int(np.searchsorted(np.cumsum(chance[order]), index.success)) + 1]
            return code[order][:, None] // radix ** np.arange(width - 1, -1, -1) % radix
        drop += step


def fit_index(vectors: np.ndarray, rows: int, norm: float, top: int, tables: int, recall: float, seed: int) -> Index:
    """The index for ``rows`` rows of which ``vectors`` are a sample, without slices."""
    dim = vectors.shape[1]
    rng = np.random.default_rng(seed)
    index = Index(dim, norm, np.zeros((tables, 0, dim + 1)), np.zeros((tables, 0)), np.zeros((tables, 0)), np.zeros((tables, 0, 0)),
                  vectors, max(1, math.ceil(top * len(vectors) / max(1, rows))), max(1, round(rows / CELL)), 1 - (1 - recall) ** (1 / tables), {})
    index.sample = index.lift(vectors)
    # a function tells about exp(1.1) = 3 kinds of rows apart: so many fill rows / BUCKET buckets
    spread = 1.1
    width = min(15, max(0, round(math.log(max(1, rows / BUCKET)) / spread)))
    a = rng.standard_normal((tables * width, dim + 1))
    for at in range(0, len(a), dim + 1):  # orthogonal in groups of as many as the dimension allows, lengths kept
        part = a[at : at + dim + 1]
        a[at : at + dim + 1] = np.linalg.qr(part.T)[0].T * np.sqrt((part * part).sum(1))[:, None]
    index.directions = a.reshape(tables, width, dim + 1)
    seen = np.einsum("twd,nd->twn", index.directions, index.sample)
    index.step = 2.0 * np.maximum(seen.std(2), 1e-9) if len(vectors) else np.ones((tables, width))
    index.offsets = (rng.random((tables, width)) - 0.5) * index.step - (seen.mean(2) if len(vectors) else 0)
    share = np.full((tables, width, 2 * REACH + 1), 0.5)  # half a row where the sample has none
    for t in range(tables):
        numbers = index.numbers(index.sample, t)
        for i in range(width):
            share[t, i] += np.bincount(numbers[:, i], minlength=2 * REACH + 1)
    index.share = share / share.sum(2, keepdims=True) if width else share
    return index


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of doubles, padded with zeros."""
    out = np.zeros((len(col), dim))
    flat = col.flatten().to_numpy(zero_copy_only=False)
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, rid, v): the rows that take part; ``rid`` tells rows with one id apart."""
    v = F.col("embedding").cast("array<double>")
    bare = rows.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return bare.where(F.coalesce(fine, F.lit(False))).select("vec_id", F.xxhash64("vec_id", "v").alias("rid"), "v")


def _buckets(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = index.lift(_matrix(batch.column("v"), index.dim))
            for t in range(index.tables):
                yield pa.RecordBatch.from_arrays([pa.array(index.bucket(index.numbers(y, t), t), pa.int64())], names=["bucket"])
    return run


CELLS = "cell long, query boolean, vec_id long, rid long, buckets array<long>, v array<double>"
_CELLS = pa.schema([("cell", pa.int64()), ("query", pa.bool_()), ("vec_id", pa.int64()), ("rid", pa.int64()),
                    ("buckets", pa.list_(pa.int64())), ("v", pa.list_(pa.float64()))])


def _file_rows(index: Index, tables: int):
    """Every row to its cell in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(sorted(index.heavy), np.int64)
        for batch in batches:
            y, rid = index.lift(_matrix(batch.column("v"), index.dim)), batch.column("rid").to_numpy()
            for t in range(tables):
                bucket = index.bucket(index.numbers(y, t), t)
                cell = index.cell(bucket, t)
                for i in np.flatnonzero(np.isin(bucket, names)):
                    s = index.slices(int(bucket[i]))
                    cell[i] = s[int(mix(rid[i : i + 1].astype(U))[0] % U(len(s)))]
                one = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1), pa.int32()), pa.array(bucket, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(np.zeros(len(y), bool)), batch.column("vec_id"), batch.column("rid"), one,
                                                  batch.column("v").cast(pa.list_(pa.float64()))], schema=_CELLS)
    return run


def neighbours_in_sample(index: Index, q: np.ndarray) -> tuple[float, np.ndarray]:
    """The cosine to look for, and the nearest rows of the sample."""
    cosine = index.sample @ q
    near = np.argsort(-cosine, kind="stable")[: index.rank + KNOWN + 1]
    if len(near) and cosine[near[0]] >= 1 - 1e-12:
        near = near[1:]  # the query itself, or one of its copies
    if not len(near):
        return 0.0, index.sample[:0]
    return float(np.clip(cosine[near[min(index.rank, len(near)) - 1]], 0.0, 0.9999)), index.sample[near]


def _file_queries(index: Index, tables: int, everything: bool):
    """Every query to the cells of the buckets that it visits (``everything``: to all cells,
    without buckets, which stands for all of them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fall, names = [[0.0] for _ in range(tables)], np.array(sorted(index.heavy), np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), index.dim)
            aims = index.aim(x) if len(x) else x
            for j, q in enumerate(aims):
                if everything:
                    cell = np.array([t * (1 << 40) + c for t in range(tables) for c in range(index.cells)] + [
                        s for b in index.heavy if b in _of_tables(index, tables) for s in index.slices(b)], np.int64)
                    bucket = np.empty(0, np.int64)
                    ends = np.zeros(len(cell) + 1, np.int64)
                else:
                    c, near = neighbours_in_sample(index, q)
                    cells, buckets = [], []
                    for t in range(tables):
                        bucket = np.unique(index.bucket(np.concatenate([index.numbers(near, t), probes(index, q, t, c, fall[t])]), t))
                        sliced = np.isin(bucket, names)
                        buckets.append(bucket[~sliced])
                        cells.append(index.cell(bucket[~sliced], t))
                        for b in bucket[sliced].tolist():
                            cells.append(np.array(index.slices(b), np.int64))
                            buckets.append(np.full(len(cells[-1]), b, np.int64))
                    cell, bucket = np.concatenate(cells), np.concatenate(buckets)
                    order = np.argsort(cell, kind="stable")
                    bucket = bucket[order]
                    cell, starts = np.unique(cell[order], return_index=True)
                    ends = np.append(starts, len(bucket))
                for at in range(0, len(cell), 4096):
                    some = cell[at : at + 4096]
                    n, part = len(some), ends[at : at + 4097]
                    vector = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * index.dim, pa.int32()), pa.array(np.tile(x[j], n)))
                    visits = pa.ListArray.from_arrays(pa.array(part - part[0], pa.int32()), pa.array(bucket[part[0] : part[-1]]))
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.ones(n, bool)), pa.array([batch.column("vec_id")[j].as_py()] * n, pa.int64()),
                                                      pa.array([batch.column("rid")[j].as_py()] * n, pa.int64()), visits, vector], schema=_CELLS)
    return run


def _of_tables(index: Index, tables: int) -> set[int]:
    """Sliced buckets of the first tables."""
    radix = (2 * REACH + 2) ** index.directions.shape[1]
    return {b for b in index.heavy if b // radix < tables}


FOUND = "query_id long, query_rid long, vec_id long, rid long, score double"
_FOUND = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]


class _Best:
    """The best rows of some queries, merged cell by cell."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, {}

    def add(self, query: tuple[int, int], ids: np.ndarray, rids: np.ndarray, scores: np.ndarray) -> None:
        if query in self.rows:
            a, b, c = self.rows[query]
            ids, rids, scores = np.concatenate([a, ids]), np.concatenate([b, rids]), np.concatenate([c, scores])
        order = np.lexsort((rids, ids, -scores))
        ids, rids, scores = ids[order], rids[order], scores[order]
        new = np.ones(len(ids), bool)  # a row found in two tables has one score, so its finds stand together
        new[1:] = (ids[1:] != ids[:-1]) | (rids[1:] != rids[:-1])
        self.rows[query] = ids[new][: self.top], rids[new][: self.top], scores[new][: self.top]

    def least(self, query: tuple[int, int]) -> float:
        """The score that a row must reach to count."""
        scores = self.rows[query][2] if query in self.rows else ()
        return scores[-1] if len(scores) == self.top else -math.inf

    def batch(self) -> pa.RecordBatch:
        of = [(np.full(len(r[0]), q[0]), np.full(len(r[0]), q[1]), *r) for q, r in self.rows.items()]
        self.rows = {}
        columns = [np.concatenate(c) for c in zip(*of, strict=True)] if of else [np.empty(0)] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND, strict=True)], names=[c.split()[0] for c in FOUND.split(", ")])


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision: summed with spare bits, so that the place of a
    row in a block does not change its score."""
    return (x.astype(np.longdouble) * q.astype(np.longdouble)).sum(1).astype(float)


def _search(dim: int, top: int, most: int = 20_000):
    """Rows sorted by (cell, query) to the best finds of each query in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, cell, slack = _Best(top), None, (dim + 8) * 2.0**-22
        parts: list[tuple[np.ndarray, ...]] = []
        ids = rids = known = place = x = short = size = None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)] if len(cells) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if cells[a] != cell:
                    cell, parts, x = cells[a], [], None
                asks = part.column("query").to_numpy(zero_copy_only=False)
                rows = part.filter(pa.array(~asks))
                if rows.num_rows:
                    parts.append((rows.column("vec_id").to_numpy(), rows.column("rid").to_numpy(), rows.column("buckets").flatten().to_numpy(), _matrix(rows.column("v"), dim)))
                asks = part.filter(pa.array(asks))
                if not asks.num_rows or not parts:
                    continue
                if x is None:  # the cell's rows are complete
                    ids, rids, buckets, x = (np.concatenate(c) for c in zip(*parts, strict=True))
                    known, place = np.unique(buckets, return_inverse=True)
                    size = np.sqrt((x * x).sum(1)).max()
                    short = (x / size).astype(np.float32)  # for a first look; its error is below ``slack``
                    parts = parts[:1]
                q = _matrix(asks.column("v"), dim)
                reach = size * np.sqrt((q * q).sum(1))
                scores = (q * (size / reach)[:, None]).astype(np.float32) @ short.T
                asking, visits = asks.column("vec_id").to_pylist(), asks.column("buckets")
                for j, name in enumerate(zip(asking, asks.column("rid").to_pylist(), strict=True)):
                    visited = visits[j].values.to_numpy()
                    here = np.full(len(known), not len(visited))
                    at = np.minimum(np.searchsorted(known, visited), len(known) - 1)
                    here[at[known[at] == visited]] = True
                    least = best.least(name) / reach[j] - slack  # as good as what this task has found for the query
                    some = np.flatnonzero(here[place] & (scores[j] >= least))
                    some = some[(ids[some] != name[0]) | (rids[some] != name[1])]
                    if len(some) > top:  # equal rows may stand twice, so ties stay until the exact scores are there
                        s = scores[j, some]
                        some = some[s >= np.partition(s, len(s) - top)[len(s) - top] - 2 * slack]
                    if len(some):
                        best.add(name, ids[some], rids[some], _exact(x[some], q[j]))
                if len(best.rows) > most:
                    yield best.batch()
        yield best.batch()
    return run


def _pass(rows: DataFrame, queries: DataFrame, index: Index, top: int, tables: int, everything: bool) -> DataFrame:
    there = map_arrow(rows, _file_rows(index, tables), CELLS)
    asked = map_arrow(queries, _file_queries(index, tables, everything), CELLS)
    met = there.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "query")
    found = map_arrow(met, _search(index.dim, top), FOUND).distinct()
    order = Window.partitionBy("query_id", "query_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def nearest(spark: SparkSession, rows: DataFrame, queries: DataFrame, top: int = 20, tables: int = 4, recall: float = 0.92, seed: int = 7) -> DataFrame:
    """(query_id, query_rid, rank, vec_id, rid, score): of each query its ``top`` nearest rows.
    ``rows`` and ``queries`` have (vec_id, embedding); a query equal to a row in both is that row."""
    rows, queries = usable(rows), usable(queries)
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, dim, norm = rows.agg(F.count("*"), F.max(F.size("v")), F.sqrt(F.max(length))).first()
    wide = queries.agg(F.max(F.size("v"))).first()[0]
    dim = max(dim or 1, wide or 1)
    drawn = rows.orderBy(F.xxhash64("rid", F.lit(seed)), "vec_id").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    index = fit_index(_matrix(drawn, dim), n, norm or 1.0, top, tables, recall, seed)
    limit = heavy_limit(n, tables)
    heavy = map_arrow(rows, _buckets(index), "bucket long").groupBy("bucket").count().where(F.col("count") > limit).collect()
    index.heavy = {r["bucket"]: (i, math.ceil(r["count"] / CELL)) for i, r in enumerate(sorted(heavy))}
    found = stage(spark, _pass(rows, queries, index, top, tables, False), "nearest")
    # whoever found too few visits every bucket of one table
    few = found.groupBy("query_id", "query_rid").agg(F.count("*").alias("n")).where(F.col("n") >= top)
    lacking = queries.join(few.select(F.col("query_id").alias("vec_id"), F.col("query_rid").alias("rid")), ["vec_id", "rid"], "left_anti")
    lacking = stage(spark, lacking, "nearest-lacking")
    if n > 1 and not lacking.isEmpty():
        more = _pass(rows, lacking, index, top, 1, True)
        kept = found.join(lacking.select(F.col("vec_id").alias("query_id"), F.col("rid").alias("query_rid")).distinct(), ["query_id", "query_rid"], "left_anti")
        found = stage(spark, kept.unionByName(more), "nearest-all")
    return found.select("query_id", "query_rid", "rank", "vec_id", "rid", "score")


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = nearest(spark, rows, rows.where("vec_id % 20 = 0"))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
