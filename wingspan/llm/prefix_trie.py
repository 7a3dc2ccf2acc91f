"""Operator 11: conversation prefix trie.

Every distinct sequence of a conversation's first d turns is a node of a trie.
Turns are numbered and digested by rows; a node's key is the digest of its
parent's key and its last turn, so equal keys are equal prefixes; nodes are
sums by key and are then named by (smallest member, depth).

Subtree totals come from parallel tree contraction in join rounds. In a round
every node tells its parent one thing. A leaf is raked: its total is final and
goes to its parent. A node whose only child is not a leaf may be compressed: it
is taken out, its parent gets its sum and its child gets its parent as a new
one. Which unary nodes go is told by one bit of the depth in each of the first
rounds (every second node of a chain of neighbours goes, so a chain halves) and
by a hash of node and round afterwards; a node goes only if its child does not,
so no two neighbours go at once. Rounds thus grow with the logarithm of the
tree's size, not with its depth. Afterwards the rounds are undone, last first:
a compressed node's total is its sum plus the total of the child it was taken
from, and as the tree shrinks by a share each round, so do these joins.

Scale: texts leave their first task as digests. Hot nodes (a first turn that
many conversations share, the root) are only ever keys of sums with partial
aggregation, or the small side's single row of an adaptive join. A list of a
node's conversation ids for its hash is sorted by (node, id) over all tasks and
meets as pieces of joined text, never as a list in memory. The turns of one
conversation pass through one task as a sorted stream.

Defined results: NULL role and text are empty; NULL turns come first; turns
with one number are ordered by the SHA-256 of role and text; repeated rows are
repeated turns; rows with a NULL conv_id belong to no conversation and are left
out; an empty table has no nodes; only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import SPACE, map_arrow, stage, table

#: The root's key; all others are digests.
ROOT = b""
#: Characters of joined conversation ids that a task sends on as one row.
PIECE = 1 << 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): a conversation's turns from 0 on."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.size(F.filter(F.split(text, SPACE + "+"), lambda w: w != "")).cast("long")
    bare = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        # the role's length parts it from the text
        F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)).alias("digest"), words.alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return bare.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "digest", "words")


def with_borrowed_heads(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, part, pos, digest, words) of the rebuilt conversations: conversation c
    takes the first h = crc32(c) % most turns of c - c % group in place of its own.
    A conversation without any turn is one row with NULL digest."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    convs = turns.where("pos = 0").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("source"))
    heads = turns.where((F.col("pos") < most - 1) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "source")
    borrowed = convs.join(heads, "source").where("pos < h").select("conv_id", F.lit(0).alias("part"), "pos", "digest", "words")
    own = turns.where(F.col("pos") >= h).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "words")
    # every conversation is there, with turns or not
    none = convs.select("conv_id", F.lit(2).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return borrowed.unionByName(own).unionByName(none)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, part, pos) to (conv_id, depth, key, parent, words, last)."""
    conv, depth, key = None, 0, ROOT
    for batch in batches:
        out = []
        for c, digest, words in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), batch.column("words").to_pylist(), strict=True):
            if c != conv:
                conv, depth, key = c, 0, ROOT
            if digest is None:  # behind the last turn: where the conversation ends
                out += [(c, 0, ROOT, None, 0, depth == 0)] if depth == 0 else [(c, 0, ROOT, None, 0, False), (c, depth, key, None, 0, True)]
                continue
            before, key, depth = key, hashlib.sha256(key + digest).digest(), depth + 1
            out.append((c, depth, key, before, words, False))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _CHAIN, strict=True)] if out else [pa.array([], t) for t in _CHAIN],
                                         names=["conv_id", "depth", "key", "parent", "words", "last"])


_CHAIN = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, words, last): a row for every prefix of a conversation
    (``last`` NULL-parent rows say where it ends and do not count as prefixes, except the root's)."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return map_arrow(ordered, _chain, "conv_id long, depth long, key binary, parent binary, words long, last boolean")


def trie_nodes(found: DataFrame) -> DataFrame:
    """(key, conv_id, depth, parent, n_convs, words): a row per distinct prefix."""
    real = found.where("parent is not null or depth = 0")
    return real.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
                                   F.count("*").alias("n_convs"), F.max("words").alias("words"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, conv_id) to (key, first, text): runs of ids, comma-joined."""
    key, ids, size = None, [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())],
                                          names=["key", "first", "text"])

    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (k != key or size >= PIECE):
                yield flush()
                ids, size = [], 0
            key = k
            ids.append(c)
            size += 20
    if ids:
        yield flush()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, first) to (key, ends_sha256)."""
    key, h = None, None
    for batch in batches:
        out = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if h is not None and k == key:
                h.update(b",")
            else:
                if h is not None:
                    out.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256()
            h.update(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], names=["key", "ends_sha256"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def ends_hashes(found: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes at which conversations end."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = found.where("last").select("key", "conv_id")
    # by range of both: the ids of a hot node are sorted in many tasks
    pieces = map_arrow(ends.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id"), _pieces, "key binary, first long, text string")
    return map_arrow(pieces.repartition("key").sortWithinPartitions("key", "first"), _hashes, "key binary, ends_sha256 string")


def _coin(depth: Column, round_: int, bits: int) -> Column:
    """Whether a unary node of this depth is to go in this round: every second one of neighbours."""
    if round_ < bits:
        return F.shiftright(depth, round_).bitwiseAND(F.lit(1)) == 1
    return F.xxhash64("conv_id", "depth", F.lit(round_)).bitwiseAND(F.lit(1)) == 1


def _id(conv: str, depth: str) -> Column:
    return F.struct(F.col(conv).alias("conv_id"), F.col(depth).alias("depth"))


def subtree_totals(spark: SparkSession, tree: DataFrame, values: list[str]) -> DataFrame:
    """(conv_id, depth, *values): each value summed over the node's subtree, itself included.
    ``tree`` has (conv_id, depth, up, kids, *values): the node's name, its parent's name as
    struct<conv_id, depth> (NULL for the root), its number of children."""
    zero = F.lit(0).cast("long")
    me = F.struct("conv_id", "depth")
    live = stage(spark, tree.select("conv_id", "depth", "up", "kids", *values), "trie-live")
    bits = int(live.agg(F.max("depth")).first()[0] or 0).bit_length()
    rounds: list[DataFrame] = []
    while True:
        r = len(rounds)
        leaf, coin = F.col("kids") == 0, (F.col("kids") == 1) & F.col("up").isNotNull() & _coin(F.col("depth"), r, bits)
        # one row a node, and one to its parent: what a leaf hands over, else its name and whether it may go
        told = F.struct(F.col("up").alias("to"), F.lit(None).cast(tree.schema["up"].dataType).alias("up"), zero.alias("kids"),
                        *[F.when(leaf, F.col(v)).otherwise(zero).alias(v) for v in values], F.when(leaf, 1).otherwise(0).cast("long").alias("leaves_"),
                        F.when(~leaf, F.struct(me.alias("id"), coin.alias("coin"))).alias("child"))
        own = F.struct(me.alias("to"), F.col("up").alias("up"), F.col("kids").alias("kids"), *[F.col(v).alias(v) for v in values], zero.alias("leaves_"),
                       F.lit(None).cast("struct<id:struct<conv_id:bigint,depth:bigint>,coin:boolean>").alias("child"))
        messages = live.select(F.explode(F.array(own, told)).alias("m")).select("m.*").where("to is not null")
        met = messages.groupBy("to").agg(F.max("up").alias("up"), F.sum("kids").alias("kids"), *[F.sum(v).alias(v) for v in values],
                                         F.sum("leaves_").alias("leaves_"), F.min("child").alias("child"))
        met = met.select("to.conv_id", "to.depth", "up", "kids", *values, "leaves_", "child")
        # the only child is no leaf and stays: this node may go
        goes = coin & F.col("child").isNotNull() & ~F.coalesce(F.col("child.coin"), F.lit(False))
        fate = F.when(leaf | (F.col("up").isNull() & (F.col("kids") == F.col("leaves_"))), "raked").when(goes, "spliced").otherwise("live")
        done = stage(spark, met.withColumn("fate", fate).withColumn("kids", F.col("kids") - F.col("leaves_")).drop("leaves_"), f"trie-round{r}")
        rounds.append(done)
        if done.where("fate = 'live' or fate = 'spliced'").isEmpty():
            break
        # what is taken out hands its sum to its parent and its parent to its child
        gone = done.where("fate = 'spliced'")
        none = F.lit(None).cast(tree.schema["up"].dataType)
        handed = gone.select(F.explode(F.array(
            F.struct(F.col("up").alias("to"), none.alias("up"), *[F.col(v).alias(v) for v in values]),
            F.struct(F.col("child.id").alias("to"), F.col("up").alias("up"), *[zero.alias(v) for v in values]))).alias("m")).select(
                "m.to", F.lit(None).cast(tree.schema["up"].dataType).alias("old"), "m.up", zero.alias("kids"), *[F.col(f"m.{v}").alias(v) for v in values])
        stays = done.where("fate = 'live'").select(me.alias("to"), F.col("up").alias("old"), none.alias("up"), "kids", *values)
        live = stays.unionByName(handed).groupBy("to").agg(F.coalesce(F.max("up"), F.max("old")).alias("up"), F.sum("kids").alias("kids"), *[F.sum(v).alias(v) for v in values])
        live = live.select("to.conv_id", "to.depth", "up", "kids", *values)
    known: DataFrame | None = None
    for r, done in reversed(list(enumerate(rounds))):
        final = done.where("fate = 'raked'").select("conv_id", "depth", *values)
        if known is not None:
            low = known.select(_id("conv_id", "depth").alias("id"), *[F.col(v).alias(f"low_{v}") for v in values])
            back = done.where("fate = 'spliced'").withColumn("id", F.col("child.id")).join(low, "id")
            final = final.unionByName(back.select("conv_id", "depth", *[(F.col(v) + F.col(f"low_{v}")).alias(v) for v in values]))
        final = stage(spark, final, f"trie-total{r}")
        known = final if known is None else known.unionByName(final)
    return known


def conversation_trie(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations in ``rows`` (conv_id, turn, role, text)."""
    found = stage(spark, prefixes(with_borrowed_heads(numbered_turns(rows))), "trie-prefixes")
    nodes = stage(spark, trie_nodes(found), "trie-nodes")
    kids = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("kids")).withColumnRenamed("parent", "key")
    above = nodes.select(F.col("key").alias("parent"), _id("conv_id", "depth").alias("up"))
    tree = nodes.join(kids, "key", "left").join(above, "parent", "left").join(ends_hashes(found), "key", "left")
    kids_or_0 = F.coalesce("kids", F.lit(0)).cast("long")
    tree = stage(spark, tree.select(
        "conv_id", "depth", "up", kids_or_0.alias("kids"), "n_convs", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        F.when(kids_or_0 == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).cast("long").alias("saved_tokens")), "trie-tree")
    totals = subtree_totals(spark, tree, ["n_leaves", "saved_tokens"])
    return tree.drop("n_leaves", "saved_tokens").join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", F.col("up.conv_id").alias("parent_conv_id"), "n_convs", F.col("kids").alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark, table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS pos, key, words FROM (
    SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS source,
         -- crc32 of the decimal digits, bit by bit
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(d) AS BIGINT) FOR d IN string_split(CAST(conv_id AS VARCHAR), '')]),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, zero: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.key, t.words FROM c JOIN t ON t.conv_id = c.source AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.key, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
path AS (
  SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(key, '') OVER w) AS key, words FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
ends AS (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id),
node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM path GROUP BY key, depth),
up AS (SELECT n.*, p.key AS parent FROM node n LEFT JOIN path p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT parent AS key, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY parent),
leaf AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (key)),
total AS (
  SELECT p.key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((leaf.n_convs - 1) * leaf.words) AS saved
  FROM leaf JOIN path p ON p.conv_id = leaf.conv_id AND p.depth <= leaf.depth GROUP BY p.key),
last AS (
  SELECT p.key, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids FROM path p JOIN ends USING (conv_id, depth) GROUP BY p.key)
SELECT leaf.conv_id, CAST(leaf.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, leaf.n_convs, leaf.n_children, total.n_leaves,
       CAST(total.saved AS BIGINT) AS saved_tokens, sha256(coalesce(last.ids, '')) AS ends_sha256
FROM leaf JOIN total USING (key) LEFT JOIN last USING (key) LEFT JOIN node above ON above.key = leaf.parent
"""
