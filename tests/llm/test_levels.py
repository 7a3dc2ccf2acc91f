"""Operator 8's levels and the word fingerprints: hostile words, passages that
many documents hold, blocks, windows of any length, a text of over 1 MB."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from wingspan.llm import common, substring_dedup
from wingspan.llm.jaccard_join import join_documents
from wingspan.llm.substring_dedup import lengths, remove_repeats, repeated_windows
from wingspan.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(x or "") for _, x in rows]
    first = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = Counter()
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_lengths_double():
    assert lengths(13) == [4, 8, 13] and lengths(50) == [4, 8, 16, 32, 50] and lengths(3) == [3] and lengths(1) == [1]


@pytest.mark.parametrize("family", [0, 1])
def test_words_like_thue_morse_differ(family):
    swap = str.maketrans("ab", "ba")
    words = [thue_morse(1 << k) for k in range(2, 18)]
    words += [w.translate(swap) for w in words]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    assert len(set(common.word_hashes(data, False, family=family).tolist())) == len(words)
    blocks = common.word_hashes(data, False, block=512, family=family)
    assert (blocks == common.word_hashes(data, False, family=family)).all()


def test_hashes_know_case_and_place():
    h = lambda s, lower: common.word_hashes(np.frombuffer(s.encode(), np.uint8), lower).tolist()
    assert h("Ab aB ab", True) == [h("ab", False)[0]] * 3
    assert len(set(h("ab ba a b aab aba É é", False))) == 8 and h(" \t\n", False) == []


def test_hostile_words_lose_nothing(spark):
    a = thue_morse(2048)
    b = a.translate(str.maketrans("ab", "ba"))
    tail = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([a, *tail])), (2, " ".join([b, *tail])), (3, " ".join([a, *tail]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(spark, docs).collect()}
    assert got == {1: 0, 2: 0, 3: 13}
    links = {r["doc_id"]: r["component_id"] for r in join_documents(spark, docs).collect()}
    assert links == {1: 1, 2: 1, 3: 1} or links == {1: 1, 2: 2, 3: 1}
    alone = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in join_documents(spark, alone).collect()} == {1: 1, 2: 2}


@pytest.mark.parametrize("window,block", [(13, 1 << 20), (13, 64), (3, 64), (1, 64), (30, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, window, block):
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    rng = random.Random(window + block)
    say = lambda n, v=400: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    passage, copy = say(40), say(90)
    rows = [(i, say(rng.randint(0, 60)) + " " + passage + " " + say(rng.randint(0, 20)) if i % 3 == 0 else copy if i % 7 == 0 else say(rng.randint(0, 80), 9))
            for i in range(120)]
    rows += [(200, None), (201, ""), (7, copy), (7, say(30)), (202, " ".join([passage] * 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(spark, docs, window).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == brute(rows, window)


def test_text_of_over_a_megabyte(spark):
    rng = random.Random(5)
    words = [f"term{rng.randrange(10**6)}" for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, "start " + " ".join(words[100_000:100_050]) + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(rows[0][1]) > common.word_hashes.__defaults__[0]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(spark, docs).collect()}
    assert got[2] == (52, 50, "start end") and got[1][:2] == (150_000, 0)


def test_levels_leave_one_folder(spark):
    """The levels' folders are removed; the runs' stays for the frame that reads it."""
    import os
    from urllib.parse import urlparse

    folder = urlparse(checkpoint_dir(spark)).path
    before = set(os.listdir(folder))
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(30))) for i in range(4)], "doc_id long, text string")
    assert repeated_windows(spark, docs).groupBy().sum("start").collect()
    assert len(set(os.listdir(folder)) - before) == 1


def test_stage_removes_the_shuffles_of_its_write(spark):
    from pyspark.sql import functions as F

    before = spark.conf.get(common.CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") / 7).cast("int").alias("k")).count()
    out = common.stage(spark, df, "shuffled")
    assert spark.conf.get(common.CLEANUP, None) == before
    # the frame itself can still be used, before and after the folder goes
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    common.drop_stage(spark, out)
    assert df.count() == 143
