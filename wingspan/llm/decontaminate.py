"""Operator 6: benchmark decontamination [native].

Method: SimHash of item-sized windows. A benchmark item of n words is looked for
in windows of n words of every document. Windows and items get a 64-bit SimHash
over their five-word shingles (every occurrence votes); the fingerprint is cut
into ``BLOCKS`` blocks, and items are filed under every value that differs from
theirs in at most RADIUS // BLOCKS bits of a block, so each pair within the
radius meets in at least one block. Pairs within the radius are then verified by
the exact weighted Jaccard similarity of their shingles (weight: number of
occurrences), which must reach ``t`` percent.

A window can only reach t percent of an item's shingles if at least that share
of its places hold shingles of items of its size. One pass finds the places of
benchmark shingles, and only windows with enough of them get a fingerprint; no
pair that could be verified is lost by that. (Two windows at exactly 80 percent
differ in 9.7 of 64 bits on average, with a deviation of 2.9; the radius of 19
leaves out 3 in 10,000 such borderline pairs and none that is closer.)

Everything is a DataFrame expression, join or aggregation.

Defined results: NULL or empty texts and items have no shingles; items of fewer
than five words are too short to prove a leak and never match; a document
shorter than an item is compared as a whole; items with one id but different texts
are looked for one by one, items without an id too; repeated rows give one result
per (id, item id), the closest; an empty documents or benchmark table gives an empty result; ties
go to the first window; very long texts are scanned whole; words are compared
in lower case; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import SPACE, row_key, stage, table

K, BLOCKS, RADIUS = 5, 5, 19
#: Rows of the benchmark's tables up to which they are broadcast (12 to 24 bytes each).
BROADCAST_ROWS = 2_000_000


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast a small table, after counting it; join a larger one by shuffling."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shingles(text: Column) -> Column:
    """Fingerprints of all five-word shingles, in order, as array<bigint>; to be
    put in a column of its own (it is read element by element)."""
    words = F.split(F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r")), SPACE + "+")
    return F.transform(words, lambda w: F.xxhash64(w))


def _with_shingles(df: DataFrame, text_col: str) -> DataFrame:
    df = df.withColumn("__w", F.when(F.length(F.btrim(text_col, F.lit(" \t\n\x0b\x0c\r"))) > 0, shingles(F.col(text_col))))
    df = df.withColumn("words", F.coalesce(F.size("__w"), F.lit(0)))
    # the first condition always holds, but keeps the optimizer from copying these
    # steps into every expression and filter that uses them
    return df.withColumn("sh", F.when((F.monotonically_increasing_id() >= 0) & (F.size("__w") >= K), F.transform(
        F.sequence(F.lit(0), F.size("__w") - K), lambda i: F.xxhash64(*[F.get("__w", i + j) for j in range(K)])))).drop("__w")


def simhash(rows: DataFrame, keys: list[str], sh: str = "sh") -> DataFrame:
    """(keys, fp): SimHash of each row's shingles. Two counters of 32 bits share a long;
    an array has fewer than 2**31 elements, so none overflows into the other."""
    h = F.col("h")
    bit = lambda i: F.shiftrightunsigned(h, i).bitwiseAND(F.lit(1).cast("long"))
    votes = [bit(i) + F.shiftleft(bit(i + 1), 32) for i in range(0, 64, 2)]
    got = rows.select(*keys, F.explode(sh).alias("h")).groupBy(*keys).agg(
        F.count("*").alias("votes"), *[F.sum(v).alias(f"v{k}") for k, v in enumerate(votes)])
    fp = F.lit(0).cast("long")
    for i in range(64):
        c = F.shiftrightunsigned(F.col(f"v{i // 2}"), 32 * (i % 2)).bitwiseAND(F.lit((1 << 32) - 1))
        fp = fp.bitwiseOR(F.shiftleft(F.when(2 * c > F.col("votes"), 1).otherwise(0).cast("long"), i))
    return got.select(*keys, fp.alias("fp"))


def _blocks() -> list[tuple[int, int]]:
    """(first bit, bits) of the blocks."""
    edge = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
    return [(s, e - s) for s, e in zip(edge, edge[1:], strict=False)]


def _values(fp: Column) -> Column:
    return F.array(*[F.struct(F.lit(b).alias("b"), F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << n) - 1).cast("long")).alias("v"))
                     for b, (s, n) in enumerate(_blocks())])


def _filed(items: DataFrame) -> DataFrame:
    """(b, v, item, ifp): every block value within reach of an item's."""
    x = items.select("item", F.col("fp").alias("ifp"), F.explode(_values(F.col("fp"))).alias("k")).select("item", "ifp", "k.b", "k.v")
    flips = F.filter(F.sequence(F.lit(0).cast("long"), F.lit((1 << max(n for _, n in _blocks())) - 1).cast("long")),
                     lambda m: F.bit_count(m) <= RADIUS // BLOCKS)
    size = F.element_at(F.array(*[F.lit(1 << n).cast("long") for _, n in _blocks()]), F.col("b") + 1)
    x = x.withColumn("flip", F.explode(flips)).where(F.col("flip") < size)
    return x.select("b", F.col("v").bitwiseXOR(F.col("flip")).alias("v"), "item", "ifp")


def _common(a: str, b: str) -> Column:
    """Occurrences that two arrays share (the smaller count of each shingle)."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda arr, x: F.size(arr) - F.size(F.array_remove(arr, x))
    exact = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(count(F.col(a), x), count(F.col(b), x)))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(exact)


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, t: int = 80, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(rid, id, item, start, n_words, similarity): for every document and benchmark
    item that it holds, the closest window (its first word and length)."""
    items = benchmark.select(row_key(item_col, item_text).alias("item"), F.col(item_col).alias("name"), F.col(item_text).alias("__text"))
    items = _with_shingles(items.distinct(), "__text")
    items = stage(spark, items.where(F.size("sh") > 0).select("item", "name", "words", "sh"), "items")
    item_print = stage(spark, simhash(items.select(F.struct("item", "words").alias("key"), "sh"), ["key"]).select("key.item", "fp"), "item-prints")

    known = items.select("words", F.explode("sh").alias("h")).distinct().groupBy("h").agg(F.collect_set("words").alias("sizes"))
    src = docs.select(row_key(id_col, text_col).alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("__text"))
    place = _with_shingles(src.drop("id"), "__text").select("rid", F.posexplode("sh").alias("pos", "h"))
    seeds = place.join(_bounded(stage(spark, known, "known")), "h").select("rid", "pos", "sizes")
    seeds = stage(spark, seeds, "seeds")

    # the same join at every size: texts are dealt by row key (a broadcast would end beyond its limit)
    held = src.join(seeds.select("rid").distinct().hint("merge"), "rid")
    held = stage(spark, _with_shingles(held, "__text").select("rid", "id", "words", "sh"), "held").distinct()
    # windows of n words (of the whole text, if that is shorter) with enough places that hold known shingles
    full = F.least("n", "words")
    at = seeds.select("rid", "pos", F.explode("sizes").alias("n")).join(held.select("rid", "words").distinct(), "rid")
    at = at.select("rid", "n", "words", F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - full + K), F.least("pos", F.col("words") - full))).alias("start"))
    windows = at.groupBy("rid", "n", "words", "start").agg(F.count("*").alias("hits")).where(100 * F.col("hits") >= t * (full - K + 1))
    windows = windows.groupBy("rid").agg(F.collect_list(F.struct("n", "start")).alias("w"))
    windows = held.select("rid", "words", "sh").distinct().join(windows, "rid").select("rid", "words", "sh", F.explode("w").alias("w"))
    windows = windows.select("rid", F.col("w.start").alias("start"), F.least("w.n", "words").alias("n"), "sh").dropDuplicates(["rid", "start", "n"])
    windows = windows.select("rid", "start", "n", F.slice("sh", F.col("start") + 1, F.col("n") - K + 1).alias("sh"))
    windows = stage(spark, windows, "windows")

    prints = simhash(windows, ["rid", "start", "n"]).withColumn("k", F.explode(_values(F.col("fp"))))
    prints = prints.select("rid", "start", "n", "fp", "k.b", "k.v")
    near = prints.join(_bounded(stage(spark, _filed(item_print), "filed")), ["b", "v"])
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS).select("rid", "start", "n", "item").distinct()

    both = windows.join(near, ["rid", "start", "n"]).join(_bounded(items.select("item", "name", F.col("sh").alias("ish"))), "item")
    both = both.withColumn("common", _common("sh", "ish")).withColumn("all", F.size("sh") + F.size("ish") - F.col("common"))
    both = both.where(100 * F.col("common") >= t * F.col("all"))
    best = both.groupBy("rid", F.col("name").alias("item")).agg(F.max(F.struct((F.col("common") / F.col("all")).alias("s"), (-F.col("start")).alias("o"), "n")).alias("m"))
    best = best.select("rid", "item", (-F.col("m.o")).alias("start"), F.col("m.n").alias("n_words"), F.col("m.s").alias("similarity"))
    return best.join(held.select("rid", "id").distinct(), "rid").select("rid", "id", "item", "start", "n_words", "similarity")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").cast("long").alias("start_word"),
                        F.col("n_words").cast("long").alias("n_words"), F.round("similarity", 6).alias("similarity"))
