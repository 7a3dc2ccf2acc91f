"""Operator 10: quality rules [native].

Method: a learned decision list. Statistics of each whole text are DataFrame
expressions. On labelled statistics, sequential covering grows one conjunction
of thresholds after the other on two thirds of the rows (the test with the
largest information gain first), prunes its last tests on the remaining third,
keeps it while it is precise there, and goes on with the rows that it leaves
uncovered. The rules become one ordered Spark conditional expression.

The list is fitted on at most ``sample`` labelled rows, the smallest by a hash
of their id (a bound of the fit only); its statistics reach the driver as a few
numbers a row. All documents are then scored in one pass with no shuffle.

Defined results: a NULL text has no words and so fails the base rule; ties and
repeated rows are scored row by row; an empty table gives an empty result;
without labels the list is empty and the base rule alone decides; NULL labels
are not used; very long texts are scored whole; only ``id_col``, ``text_col`` and
the label column are read from the inputs, and other columns are kept whatever
their names (but for the columns that are added).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import SPACE, aside, table

#: Labelled rows that the list is fitted on at most.
SAMPLE = 8000
#: Characters that count as symbols (fixed value).
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
FEATURES = ("words", "word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share")


def with_statistics(docs: DataFrame, text_col: str = "text", to: str = "stats") -> DataFrame:
    """``docs`` with a struct column ``to`` (in place of one of that name): the counts
    of the contract and the ratios that rules test."""
    docs = docs.drop(to)
    bare, back = aside(docs, text_col)
    d = bare.withColumn("__t", F.coalesce(F.col(text_col), F.lit("")))
    d = d.withColumn("__trim", F.btrim("__t", F.lit(" \t\n\x0b\x0c\r")))
    d = d.withColumn("__w", F.when(F.length("__trim") == 0, F.array().cast("array<string>")).otherwise(
        F.split("__trim", SPACE + "+")))
    d = d.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    # fingerprints of all windows of consecutive words
    d = d.withColumn("__g", F.when(F.size("__h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__h") - WINDOW), lambda i: F.xxhash64(*[F.get("__h", i + j) for j in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>")))
    # only a text with an equal pair goes on: sort (fingerprint, place), keep places whose neighbour is equal
    d = d.withColumn("__p", F.when(F.size(F.array_distinct("__g")) < F.size("__g"), F.sort_array(
        F.transform("__g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<g:bigint,i:int>>")))
    d = d.withColumn("__r", F.sort_array(F.filter(F.transform("__p", lambda p, i: F.when(
        (p["g"] == F.get("__p", i - 1)["g"]) | (p["g"] == F.get("__p", i + 1)["g"]), p["i"])), lambda x: x.isNotNull())))
    repeat = F.aggregate(F.transform("__r", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__r", i + 1) - p, F.lit(WINDOW)))),
                         F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # computed once a row: the condition always holds, but keeps the optimizer from
    # copying these steps into every expression and filter that uses a statistic
    d = d.withColumn("__n", F.when(F.monotonically_increasing_id() >= 0, F.struct(
        F.size("__w").cast("long").alias("n_words"),
        (F.length("__t") - F.regexp_count("__t", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"), F.size("__l").cast("long").alias("n_lines"),
        F.regexp_count("__t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("__t", F.lit(r"[!?]")).cast("long").alias("n_marks"))))
    n, per = F.col("__n"), lambda a, b: F.col(f"__n.{a}") / F.greatest(F.col(f"__n.{b}"), F.lit(1))
    d = d.withColumn("__stats", F.struct(
        *[n[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        n["n_words"].cast("double").alias("words"), per("word_chars", "n_words").alias("word_length"),
        per("n_symbols", "n_words").alias("symbol_share"), per("n_upper", "word_chars").alias("upper_share"),
        per("n_marks", "n_words").alias("mark_share"), per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share")))
    return back(d, to, "__stats")


def base_failed(stats: str = "stats") -> Column:
    return (F.col(f"{stats}.n_words") < 20) | (100 * F.col(f"{stats}.n_repeat_words") > 30 * F.col(f"{stats}.n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self, stats: str) -> Column:
        c = F.col(f"{stats}.{self.feature}")
        return c >= self.threshold if self.above else c < self.threshold


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t.holds(x)
    return out


def _candidates(x: np.ndarray, cuts: int) -> list[Test]:
    out = []
    for j, f in enumerate(FEATURES):
        v = np.unique(x[:, j])
        if len(v) > 1:
            at = np.unique(np.linspace(0, len(v) - 2, min(cuts, len(v) - 1)).astype(int))
            for t in (v[at] + v[at + 1]) / 2:
                out += [Test(f, True, float(t)), Test(f, False, float(t))]
    return out


def _grow(x: np.ndarray, bad: np.ndarray, tests: int, cuts: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < tests and (bad & inside).any() and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        before, best, pick = np.log2(p0 / (p0 + n0)), 1e-9, None
        for t in _candidates(x[inside], cuts):
            h = t.holds(x) & inside
            p, n = (bad & h).sum(), (~bad & h).sum()
            if p and (gain := p * (np.log2(p / (p + n)) - before)) > best:
                best, pick = gain, t
        if pick is None:
            break
        rule, inside = (*rule, pick), inside & pick.holds(x)
    return rule


def learn(x: np.ndarray, bad: np.ndarray, prune: np.ndarray, rules: int = 10, tests: int = 4, cuts: int = 64,
          precision: float = 0.97, least: int = 3) -> list[Rule]:
    """Sequential covering. x: one row of FEATURES a text; bad: its label says
    reject; prune: rows kept for pruning."""
    out: list[Rule] = []
    left = np.ones(len(x), bool)
    for _ in range(rules):
        grow, check = left & ~prune, left & prune
        if (bad & grow).sum() < least:
            break
        rule = _grow(x[grow], bad[grow], tests, cuts)
        if not rule:
            break

        def worth(r: Rule, at: np.ndarray = check) -> float:
            c = _covers(r, x[at])
            p, n = (bad[at] & c).sum(), (~bad[at] & c).sum()
            return (p - n) / max(p + n, 1)

        best = max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k]), -k))
        rule = rule[:best]
        c = _covers(rule, x)
        seen, hits = (left & c).sum(), (bad & left & c).sum()
        seen_check, hits_check = (check & c).sum(), (bad & check & c).sum()
        if hits < least or hits < precision * seen or (seen_check and hits_check < precision * seen_check):
            break
        out.append(rule)
        left &= ~c
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> list[Rule]:
    """A decision list that rejects what ``label_col`` = 0 says, from at most
    ``sample`` labelled rows."""
    picked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y")).where(
        F.col("__y").isNotNull() & F.col("__id").isNotNull())
    picked = picked.withColumn("__o", F.xxhash64("__id")).orderBy("__o", "__id").limit(sample)
    rows = docs.select(F.col(id_col).alias("__id"), text_col).join(F.broadcast(picked), "__id")  # sample rows at most
    rows = with_statistics(rows, text_col).where(~base_failed()).select(
        "__o", "__y", *[F.col(f"stats.{f}").alias(f"f{j}") for j, f in enumerate(FEATURES)])
    got = sorted(tuple(r) for r in rows.collect())
    if not got:
        return []
    x = np.array([r[2:] for r in got], float)
    return learn(x, np.array([r[1] == 0 for r in got]), np.array([r[0] % 3 == 0 for r in got]))


def decide(rules: list[Rule], stats: str = "stats") -> Column:
    """Number of the first rule that rejects (0: the base rule), NULL if none does."""
    out = F.when(base_failed(stats), F.lit(0))
    for k, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for t in rule:
            hit = hit & t.column(stats)
        out = out.when(hit, F.lit(k))
    return out


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{t.feature} {'>=' if t.above else '<'} {t.threshold:g}" for t in r) for r in rules]


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``docs`` with ``stats`` and ``rule`` (the rule that rejects, or NULL), in place of columns of these names."""
    bare, back = aside(docs, text_col)
    judged = with_statistics(bare, text_col, "__judged").withColumn("__rule", decide(rules, "__judged"))
    return back(judged, "stats", "__judged", "rule", "__rule")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", *[F.col(f"stats.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], base_failed().alias("base_failed"),
        F.col("rule").isNull().alias("kept"), "rule")
