"""Operator 9: secret scans [native].

Method: sliding-window Shannon entropy per character class over candidate
strings, computed by incremental counts, with allow-list suppression. A
candidate is a run of at least ``window`` key characters with a letter and a
digit in it. A fold over its characters keeps the count of every character in
the current window and the sum of c*log2(c), both changed only by the character
that enters and the one that leaves; a window is suspicious where its entropy
reaches the limit of the candidate's class (hex digits, letters and digits, or
the base64 set). The longest parts of a run that hold only hex digits, or only
letters and digits, are candidates of their own class, so a key joined to a name
is found like a bare one. The span runs from the first suspicious window's start
to the last one's end; spans of one run that meet are one. A window
that holds a match of an allow-list pattern adds nothing, nor does one that lies
in matches and what stands between them, if that is allowed too; the rest of the
run is scanned. The base findings are three fixed patterns. Base findings are cut
out of a run and what is left is scanned; a part of one class that goes on beyond
a base finding is scanned whole, and adds nothing if its span lies in the finding.

Everything is a DataFrame expression on one row, so the scan is one pass with no
shuffle; texts without a match of the first, cheap test skip the rest.

Defined results: a NULL text counts as empty (no findings); ties and repeated
rows are scanned row by row; an empty table gives an empty result; very long
texts are scanned whole (linear in the text, and quadratic in the number of its
candidates and assignments); only ``text_col`` is read, and other columns are
kept whatever their names. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import aside, table

#: Base kinds in their order: pattern, group that is measured, least length (fixed values).
BASE = (
    ("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
               r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    # bounded here: a run that is too short holds no other match, so shorter ones need no place in a list
    ("access", r"(AKIA[A-Z0-9]{16,})", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
)
#: A text without a match of these has no base finding (a run that is too short is no match).
QUICK = (r"(?:[wW][oO][rR][dD]|[sS][wW][dD]|[cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|_?[kK][eE][yY])[\"']?\x20*[:=]", r"AKIA[A-Z0-9]{16}", r"[0-9a-f]{24}")


@dataclass(frozen=True)
class Entropy:
    """Window length, entropy limits in bits by class, and the allow-list."""

    window: int = 20
    hex_bits: float = 3.2
    alnum_bits: float = 3.7
    base64_bits: float = 3.9
    #: Well-known harmless shapes: UUIDs, dates and times, placeholders, plain counting, words with numbers at the end.
    allow: tuple[str, ...] = (
        r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
        r"\d{4}-\d{2}-\d{2}", r"(?i)example|placeholder|changeme|x{6}", r"(?i)0123456789|abcdefghij",
        r"^[A-Za-z]+[-_]?[0-9]{1,4}$", r"^[A-Za-z]+([/_-][A-Za-z]+)*[/_-]?[0-9]{0,4}$")


#: Scale of the whole numbers that stand for c*log2(c), so that sums are exact.
SCALE = 1 << 20
KEY_RUN = "[A-Za-z0-9+/_=-]"
#: Classes whose parts of a run are candidates too.
PURE = ("[A-Za-z0-9]", "[0-9a-fA-F]")


def _matches(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start, end, value>>: the leftmost non-overlapping matches, by
    the lengths of the parts between them and of the matches themselves."""
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1))
    gaps = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))
    steps = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(whole)), F.length).alias("gap"), whole.alias("whole"), value.alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["whole"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    return F.aggregate(steps, zero, step, lambda acc: acc["out"])


def _spans(text: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    found = F.filter(_matches(text, pattern, group), lambda m: F.length(m["value"]) >= least)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"),
                                                 m["end"].alias("end"), F.lit(kind).alias("kind")))


_EMPTY = "array<struct<start:int,order:int,end:int,kind:string>>"


def _hot(m: Column, e: Entropy) -> Column:
    """struct<first, last>: starts of the first and last suspicious window of a
    candidate that its allowed matches leave; first is -1 if there is none."""
    value = m["value"]
    table_ = [round(c * math.log2(c) * SCALE) if c else 0 for c in range(e.window + 1)]
    weigh = F.array(*[F.lit(v).cast("long") for v in table_])
    chars = F.split(value, "")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    bits = (F.when(value.rlike("^[0-9a-fA-F]+$"), F.lit(e.hex_bits)).when(value.rlike("^[A-Za-z0-9]+$"), F.lit(e.alnum_bits))
            .otherwise(F.lit(e.base64_bits)))
    # entropy >= bits  <=>  sum(c log c) <= window * (log2(window) - bits)
    most = F.floor((F.lit(math.log2(e.window)) - bits) * e.window * SCALE)
    codes = F.transform(chars, lambda c: F.instr(F.lit(letters), c))
    zero = F.struct(F.array_repeat(F.lit(0), len(letters)).alias("count"), F.lit(0).cast("long").alias("sum"),
                    F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    steps = F.transform(codes, lambda c, i: F.struct(i.alias("i"), c.alias("enter"), F.coalesce(F.get(codes, i - e.window), F.lit(0)).alias("leave")))

    def step(acc: Column, x: Column) -> Column:
        gone = F.coalesce(F.get(acc["count"], x["leave"] - 1), F.lit(0))
        less = acc["sum"] - F.when(x["leave"] > 0, F.get(weigh, gone) - F.get(weigh, gone - 1)).otherwise(0)
        here = F.get(acc["count"], x["enter"] - 1) - F.when(x["leave"] == x["enter"], 1).otherwise(0)
        total = less + F.get(weigh, here + 1) - F.get(weigh, here)
        start = x["i"] - (e.window - 1)
        at = m["start"] + start
        quiet = F.exists(m["hold"], lambda a: (a["start"] >= at) & (a["end"] <= at + e.window)) | F.exists(
            m["inside"], lambda a: (a["start"] <= at) & (a["end"] >= at + e.window))
        hot = (start >= 0) & (total <= most) & ~quiet
        count = F.transform(acc["count"], lambda n, j: n + F.when(j == x["enter"] - 1, 1).otherwise(0)
                            - F.when(j == x["leave"] - 1, 1).otherwise(0))
        return F.struct(count.alias("count"), total.cast("long").alias("sum"),
                        F.when(hot & (acc["first"] < 0), start).otherwise(acc["first"]).alias("first"),
                        F.when(hot, start).otherwise(acc["last"]).alias("last"))

    return F.aggregate(steps, zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _joined(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch as one."""
    zero = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        one = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(last["end"] >= s["start"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), one)).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), zero, step)


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"))


def _part(start: Column, end: Column, value: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), value.alias("value"))


def _outside(m: Column, base: Column) -> Column:
    """array<struct<start, end, value>>: what the base findings leave of a run."""
    over = F.filter(base, lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"]))
    zero = F.struct(m["start"].alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))
    cut = lambda s, e: F.array(_part(s, e, m["value"].substr(s - m["start"] + 1, e - s)))

    def step(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.when(b["start"] > acc["at"], F.concat(
            acc["out"], cut(acc["at"], b["start"]))).otherwise(acc["out"]).alias("out"))

    left = F.aggregate(over, zero, step, lambda acc: F.when(acc["at"] < m["end"], F.concat(
        acc["out"], cut(acc["at"], m["end"]))).otherwise(acc["out"]))
    return F.when(F.size(over) > 0, left).otherwise(F.array(_part(m["start"], m["end"], m["value"])))


def _allowed(m: Column, pattern: str) -> tuple[Column, Column]:
    """The allowed matches of a candidate, and the spans that they cover together with
    what stands between them, if that (without signs at its ends) is allowed too."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    if not pattern:
        return none, none
    some = m["value"].rlike(pattern)
    hits = F.transform(_matches(m["value"], pattern, 0), lambda x: _span(m["start"] + x["start"], m["start"] + x["end"]))
    gaps = F.transform(F.split(m["value"], pattern, -1), lambda g, i: F.struct(
        F.coalesce(F.get(hits, i - 1)["end"], m["start"]).alias("start"), F.coalesce(F.get(hits, i)["start"], m["end"]).alias("end"),
        F.btrim(g, F.lit("+/_=-")).alias("value")))
    gaps = F.filter(gaps, lambda g: (g["value"] == "") | g["value"].rlike(pattern))
    inside = _joined(F.concat(hits, F.transform(gaps, lambda g: _span(g["start"], g["end"]))))
    return F.when(some, hits).otherwise(none), F.when(some, inside).otherwise(none)


def _candidates(m: Column, base: Column, e: Entropy) -> Column:
    """array<struct<start, end, value, hold, inside>>: what the base findings leave of a
    run, and its longest parts of one class, with the allowed matches of both."""
    pattern = "|".join(f"(?:{p})" for p in e.allow)
    pure = [F.transform(_matches(m["value"], f"{c}{{{e.window},}}", 0), lambda x: _part(
        m["start"] + x["start"], m["start"] + x["end"], x["value"])) for c in PURE]
    parts = F.filter(F.array_distinct(F.concat(_outside(m, base), *pure)), lambda x: (
        F.length(x["value"]) >= e.window) & x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
    run_hold, run_inside = _allowed(m, pattern)

    def add(x: Column) -> Column:
        hold, inside = _allowed(x, pattern)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                        F.concat(run_hold, hold).alias("hold"), F.concat(run_inside, inside).alias("inside"))

    return F.filter(F.transform(parts, add), lambda x: ~F.exists(x["inside"], lambda a: (a["start"] <= x["start"]) & (a["end"] >= x["end"])))


def _added(text: Column, base: Column, e: Entropy) -> Column:
    found = _matches(text, f"({KEY_RUN}{{{e.window},}})", 1)
    keep = F.filter(found, lambda m: m["value"].rlike("[0-9]") & m["value"].rlike("[A-Za-z]"))
    keep = F.flatten(F.transform(keep, lambda m: _candidates(m, base, e)))
    hot = F.transform(keep, lambda m: F.struct(m["start"].alias("at"), _hot(m, e).alias("w")))
    hot = F.filter(hot, lambda h: h["w"]["first"] >= 0)
    hot = F.transform(hot, lambda h: _span(h["at"] + h["w"]["first"], h["at"] + h["w"]["last"] + e.window))
    hot = F.filter(hot, lambda h: ~F.exists(base, lambda b: (b["start"] <= h["start"]) & (b["end"] >= h["end"])))
    return F.transform(_joined(hot), lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(BASE)).alias("order"), s["end"].alias("end"), F.lit("entropy").alias("kind")))


def scan(docs: DataFrame, entropy: Entropy = Entropy(), text_col: str = "text", to: str = "secrets") -> DataFrame:
    """``docs`` with a struct column ``to`` (in place of one of that name): base and all, each an
    array<struct<start, order, end, kind>> sorted by start, then kind as listed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(_EMPTY)
    base = [F.when(text.rlike(quick), _spans(text, k, i, p, g, n)).otherwise(none)
            for (i, (k, p, g, n)), quick in zip(enumerate(BASE), QUICK, strict=True)]
    out = docs.withColumn(to, F.array_sort(F.concat(*base)))
    added = F.when(text.rlike(f"{KEY_RUN}{{{entropy.window}}}") & text.rlike("[0-9]"), _added(text, F.col(to), entropy)).otherwise(none)
    return out.withColumn(to, F.struct(F.col(to).alias("base"), F.array_sort(F.concat(F.col(to), added)).alias("all")))


def listing(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, entropy: Entropy = Entropy(), text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of the text replaced (overlaps as one)."""
    bare, back = aside(docs, text_col)
    found = scan(bare, entropy, text_col, to := f"{text_col}_found")
    spans = F.col(f"`{to}`")["all"]
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        cut = F.when(s["start"] >= acc["at"], F.array(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(by))).otherwise(
            F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], cut).alias("out"))

    clean = F.aggregate(spans, zero, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.length(text))))
    return back(found.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(text)))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("secrets.base", lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k, *_ in BASE]
    return found.select("doc_id", *count, F.sha2(listing(F.col("secrets.base")), 256).alias("base_sha256"),
                        listing(F.col("secrets.all")).alias("spans"))
