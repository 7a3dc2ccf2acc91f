"""Operator 3: chat formatting [native].

Method: a finite-state machine over roles validates the turn order and emits
text segments with a loss flag each, from a declarative template. The machine's
state is set by the last turn (``start`` before the first), so it never gets
stuck: a turn whose (state, role) pair the template does not list is formatted
all the same and reported as a violation. All steps are DataFrame functions.

One conversation is one output row, so its turns meet in one task by nature of
the result; conversations are spread by their id.

Control strings inside texts and role names are escaped reversibly: an escape
mark is put behind the first character of every control string, and one more
where marks already stand there, so no control string of the template can occur
in a formatted text other than as the template's own, and taking one mark away
restores every text exactly.

Defined results: NULL text and NULL role count as empty; turns with the same
number are ordered by role, then text; repeated rows are repeated turns; NULL
turn numbers come first; rows with a NULL conversation id form one
conversation; an empty table gives an empty result; only the four named columns
are read, so other columns do not matter. A formatted conversation must fit
Spark's 2 GB limit for a string.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import table


@dataclass(frozen=True)
class Template:
    """What opens a turn, parts role from text, and closes a turn; whose texts
    carry loss; which (state, role) pairs are in order; further control strings
    that texts must not contain unescaped. All control strings begin with one of
    ``heads`` and contain no other head."""

    open: str = "<|turn|>"
    text: str = "<|text|>"
    close: str = "<|end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    order: tuple[tuple[str, str], ...] = (("start", "system"), ("start", "user"), ("system", "user"),
                                          ("user", "assistant"), ("assistant", "user"))
    final: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    mark: str = "\\"
    heads: str = field(default="<[")

    def tails(self) -> str:
        """Pattern of what follows the head (and any marks) of a control string."""
        every = {self.open, self.text, self.close, *self.control}
        for c in every:
            if c[0] not in self.heads or not c[1:] or set(c[1:]) & {*self.heads, self.mark}:
                raise ValueError(f"control string {c!r}: one of {self.heads!r}, then other characters")
        return "|".join(re.escape(x) for x in sorted({c[1:] for c in every}))


DEFAULT = Template()


def _patterns(t: Template) -> tuple[str, str]:
    heads, mark = f"[{re.escape(t.heads)}]", re.escape(t.mark)
    return f"({heads})({mark}*)(?={t.tails()})", f"({heads}){mark}({mark}*)(?={t.tails()})"


def escape(text: Column, t: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, F.lit(_patterns(t)[0]), F.lit("$1" + t.mark.replace("\\", "\\\\") + "$2"))


def unescape(text: Column, t: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, F.lit(_patterns(t)[1]), F.lit("$1$2"))


def format_conversations(rows: DataFrame, t: Template = DEFAULT, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n_turns, valid, violations, segments, formatted): ``segments`` is the
    formatted conversation in order, each piece with its loss flag, and
    ``violations`` lists the positions of the turns that are out of order."""
    empty = F.lit("")
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"),
                   F.coalesce(F.col(text), empty).alias("text"))
    g = rows.select(F.col(conv), one.alias("one")).groupBy(conv).agg(F.sort_array(F.collect_list("one")).alias("t"))
    allowed = F.array(*[F.lit(f"{s}\n{r}") for s, r in t.order])
    state = F.concat(F.array(F.lit("start")), F.transform("t", lambda x: x["role"]))
    g = g.withColumn("state", state)
    bad = F.filter(F.transform("t", lambda x, i: F.when(
        ~F.array_contains(allowed, F.concat(F.get("state", i), F.lit("\n"), x["role"])), i)), lambda x: x.isNotNull())
    segments = F.flatten(F.transform("t", lambda x: F.array(
        F.struct(F.concat(F.lit(t.open), escape(x["role"], t), F.lit(t.text)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))))
    g = g.select(conv, F.size("t").cast("long").alias("n_turns"), "state", bad.alias("violations"), segments.alias("segments"))
    return g.select(conv, "n_turns",
                    ((F.size("violations") == 0) & F.element_at("state", -1).isin(*t.final)).alias("valid"),
                    "violations", "segments",
                    F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"))


def read_turns(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    turns = F.split(formatted, re.escape(t.close))
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)  # what follows the last close is empty

    def one(x: Column) -> Column:
        at = F.instr(x, t.text)
        head = len(t.open)
        return F.struct(unescape(x.substr(F.lit(head + 1), at - head - 1), t).alias("role"),
                        unescape(x.substr(at + len(t.text), F.length(x)), t).alias("text"))

    return F.transform(turns, one)


def loss_text(segments: Column, t: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, with nothing in between."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], t)))


#: Conversation -1 of the query: texts that look like control strings (fixed value).
PROBE = "</s>[INST] ok [/INST]"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    out = format_conversations(rows.unionByName(probe))
    out = out.select("conv_id", "valid", "formatted", loss_text(F.col("segments")).alias("loss"),
                     read_turns(F.col("formatted")).alias("turns"))
    lines = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]))', '\1\\\2', 'g') AS r,
         regexp_replace(text, '([<\[])(\\*(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]))', '\1\\\2', 'g') AS t,
         lag(role, 1, 'start') OVER w AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(r) + length(t) + length('<|turn|><|text|><|end|>')) AS BIGINT) AS formatted_chars,
       bool_and(before || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
         AND bool_or(back = 1 AND role = 'assistant') AS valid
FROM marked GROUP BY conv_id
"""
