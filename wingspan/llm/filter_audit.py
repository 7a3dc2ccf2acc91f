"""Operator 12: filter interaction audit.

Five filters read whole texts; a document's failures are one of 32 sets. The
table is counted down to (part, failure set) cells, and from the cells come the
removal game's values: v(S) is the number of documents that fail at least one
filter of S, for all 32 coalitions S. Method: the game's Hart-Mas-Colell
potential P(S) = (v(S) + sum of P(S without i) for i in S) / |S| is computed
recursively from the empty coalition up, in whole numbers of 1/60 (60 is the
least common multiple of 1 to 5, so nothing is rounded). A filter's Shapley
value is the grand potential minus the potential without that filter, and the
differences v(S with f) - v(S) are the steps of every order.

Filters (words: runs of other characters than space and tab to carriage return):
A under 100 words; B 100 * distinct words < 80 * words; C 100 * [A-Z] characters
> 10 * code points; D holds one of ``#$%&*|``; E equals the text of a smaller
doc_id anywhere in the table.

Scale: texts are read once, in blocks that end at separators, and leave their
task as a digest and four flags. Rows are summed by (digest, id, labels) and
(digest, labels) before they meet by digest, so a text that a third of the rows
share sends a row a task. Nothing but cells of a part meets in one task.

Defined results: NULL text is empty text; NULL lang is the part ``''``; a row
with NULL doc_id is neither a smaller copy nor has one, and no labels; rows that
share their doc_id are copies of each other's text in neither direction, yet
each counts; several label rows of a document count as good or toxic if any of
them says so; an empty table gives no rows; only doc_id, text, lang and the
labels' doc_id, quality and toxic are read, so other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import binary_rows, is_space, map_arrow, table

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
#: Characters that filter D looks for (fixed value).
SYMBOLS = b"#$%&*|"
#: Texts are cut into words in pieces of about so many bytes.
BLOCK = 1 << 20
#: Least common multiple of 1 to 5: potentials are whole numbers of 1 / SCALE.
SCALE = 60
#: Orders of the filters, and so marginal contributions of each.
ORDERS = ["".join(o) for o in permutations(FILTERS)]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _pieces(data: np.ndarray) -> Iterator[bytes]:
    """The bytes in pieces that end behind a separator (or at the end)."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        while end < n and not is_space(data[end - 1 : end])[0]:
            gaps = np.flatnonzero(is_space(data[end : end + BLOCK]))
            end = end + int(gaps[0]) + 1 if len(gaps) else min(n, end + BLOCK)
        yield data[at:end].tobytes()
        at = end


def failures(data: np.ndarray) -> int:
    """The failed filters among A to D as bits, for a text's bytes."""
    words, distinct, upper, chars, symbol = 0, set(), 0, 0, False
    for piece in _pieces(data):
        found = piece.split()  # bytes.split parts at space and tab to carriage return
        words += len(found)
        distinct.update(found)
        b = np.frombuffer(piece, np.uint8)
        upper += int(((b >= 65) & (b <= 90)).sum())
        chars += int(((b & 0xC0) != 0x80).sum())
        symbol = symbol or bool(_SYMBOL[b].any())
    return ((words < 100) | (100 * len(distinct) < 80 * words) << 1 | (100 * upper > 10 * chars) << 2 | symbol << 3)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = list(binary_rows(batch.column(2)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
             pa.array([failures(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])


def audit_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters."""
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    seen = map_arrow(bare, _read, "doc_id long, part string, digest binary, mask int")
    # equal rows first: neither a hot id nor a hot text reaches a join or window whole
    seen = seen.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    says = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    seen = seen.join(says, "doc_id", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    # of each text, part and labels: the rows with the smallest id, which fail E only if a smaller one is elsewhere
    low = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    kinds = seen.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"), low.alias("low"))
    first = F.min("low.doc_id").over(Window.partitionBy("digest"))
    kinds = kinds.withColumn("spared", F.col("nameless") + F.when(F.col("low.doc_id") == first, F.col("low.n")).otherwise(0))
    e = 1 << FILTERS.index("E")
    both = F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("spared").alias("k")),
                             F.struct(F.col("mask").bitwiseOR(F.lit(e)).alias("m"), (F.col("n") - F.col("spared")).alias("k")))).alias("x")
    cells = kinds.select("part", "good", "toxic", both).select("part", "good", "toxic", F.col("x.m").alias("mask"), F.col("x.k").alias("n"))
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                                             F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def coalition_values(counts: dict[int, int]) -> list[int]:
    """v(S) for all coalitions S: documents that fail a filter of S."""
    return [sum(n for mask, n in counts.items() if mask & s) for s in range(ALL + 1)]


def potentials(v: list[int]) -> list[int]:
    """The game's potential of every coalition, times SCALE."""
    p = [0] * len(v)
    for s in range(1, len(v)):  # a coalition's subsets have smaller numbers
        members = [i for i in range(len(FILTERS)) if s >> i & 1]
        p[s] = (SCALE * v[s] + sum(p[s & ~(1 << i)] for i in members)) // len(members)
    return p


def steps_of(cells: dict[int, tuple[int, int, int]]) -> Iterator[tuple]:
    """The rows of one part: (filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley)."""
    v, good, toxic = (coalition_values({m: c[k] for m, c in cells.items()}) for k in range(3))
    total, p = sum(c[0] for c in cells.values()), potentials(v)
    for order in ORDERS:
        before = 0
        for step, name in enumerate(order, 1):
            f = 1 << FILTERS.index(name)
            after = before | f
            removed = v[after] - v[before]
            yield (order, step, total - v[after], removed, v[f] - removed, v[ALL] - v[ALL & ~f], good[after] - good[before],
                   toxic[after] - toxic[before], (p[ALL] - p[ALL & ~f]) * len(ORDERS) // SCALE)
            before = after


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")
_KINDS = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in AUDIT.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            cells = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["cells"]}
            out = [(row["part"], *x) for x in steps_of(cells)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KINDS, strict=True)], names=names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step (see ``steps_of``)."""
    cells = audit_cells(docs, labels)
    # at most 32 cells a part
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return map_arrow(parts, _audit, AUDIT)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, strpos('ABCDE', substr(filter_order, step, 1)) AS k,
                 [strpos('ABCDE', substr(filter_order, i, 1)) FOR i IN range(1, step)] AS earlier
          FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
rows AS (
  SELECT part, filter_order, step, k, n, good, toxic, fails[k] AS hit,
         len([j FOR j IN earlier IF fails[j]]) > 0 AS gone,
         len([x FOR x IN fails IF x]) = 1 AS alone
  FROM cells, steps),
out AS (
  SELECT part, filter_order, step, k, CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE gone AND hit), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (WHERE hit AND alone), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
  FROM rows GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM out
"""
