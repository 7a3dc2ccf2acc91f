"""Points of the second verdict: kept columns, counters, long texts with keys."""

import random
import time

from wingspan.llm.common import aside
from wingspan.llm.decontaminate import simhash
from wingspan.llm.quality_rules import judge, with_statistics
from wingspan.llm.secrets import redact, scan


def test_aside_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "`a.b` int, text string, aside string, `q``r` string")
    bare, back = aside(df, "text")
    assert len(bare.columns) == 2 and back(bare.selectExpr("*", "1 AS `a.b`", "2 AS q")).collect() == df.collect()
    bare, back = aside(df, *df.columns)
    assert back(bare).collect() == df.collect()


def test_operators_keep_columns_with_their_own_names(spark):
    names = ["__t", "__w", "__stats", "__judged", "__rule", "__found", "text_found", "rule", "stats"]
    df = spark.createDataFrame([(1, "password: hunter2secret", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = redact(df).first()
    assert out["text"] == "[SECRET]" and [out[n] for n in names] == names
    judged = judge(df, []).first()
    assert [judged[n] for n in names[:-2]] == names[:-2] and judged["rule"] == 0 and judged["stats"]["n_words"] == 2
    assert with_statistics(df, to="other").first()["stats"] == "stats"


def test_simhash_counts_beyond_a_million_shingles(spark):
    df = spark.range(1).selectExpr("1 AS key", "concat(array_repeat(5L, 1100000), array_repeat(-1L, 1000000)) AS sh")
    assert simhash(df, ["key"]).first()["fp"] == 5


def test_a_long_text_with_a_key_is_scanned_in_time(spark):
    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choice("abcdefghklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))
    key = "0123456789abcdef" * 2
    took = []
    for n in (1000, 150_000, 300_000):
        text = f"{say(n)} {key} {say(10)} password = hunter2secret"
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        found = scan(df).first()["secrets"]["base"]
        took.append(time.time() - began)
        at = text.index(key)
        assert (found[0]["start"], found[0]["end"], found[0]["kind"]) == (at, at + 32, "hex") and found[1]["kind"] == "assign" and len(found) == 2
    assert len(text) > 1_900_000 and took[2] < 30  # quadratic steps took minutes at a tenth of this
