"""Operators 11 to 13 against brute force: NULLs, repeated and empty rows, ties,
clashing extra columns, empty tables, deep and wide shapes."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from wingspan.llm import filter_audit, nearest
from wingspan.llm.filter_audit import audit
from wingspan.llm.prefix_trie import conversation_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- operator 11 ---------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, key string, up string, kids string, pos string, to string"


def turns():
    """Shared first turns, whole copies, a deep chain, ties, NULLs, missing sources."""
    rng = random.Random(11)
    say = lambda: " ".join(rng.choice("abcd") * rng.randint(1, 3) for _ in range(rng.randint(0, 4)))
    out = []
    for c in [*range(0, 45), 60, 61, 62, 100, 107, 119, -1, -20, -25]:
        for t in range(rng.randint(1, 5)):
            out.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hello", "hello there", say()])))
    out += [(c, t, "user", "same") for c in range(200, 215) for t in range(4)]
    out += [(300, t, "user", f"deep {t // 2}") for t in range(150)] + [(301, t, "user", f"deep {t // 2}") for t in range(90)]
    out += [(310, None, None, None), (310, None, "user", "x"), (310, 0, "user", None), (310, 0, "user", ""), (310, 0, "user", ""), (311, 5, "", "a b")]
    out += [(None, 0, "user", "nobody"), (None, 1, None, None)]
    rng.shuffle(out)
    return out


def trie(rows):
    per = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            per[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest(), role, text))
    per = {c: [x[3:] for x in sorted(v)] for c, v in per.items()}
    built = {}
    for c in per:
        h, source = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        built[c] = tuple(per.get(source, [])[:h] + per[c][h:])
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in built.items():
        ends[v].append(c)
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
            if d:
                kids[v[: d - 1]].add(v[:d])
    leaves, saved = Counter(), Counter()
    for node, some in members.items():
        own = (len(some) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += own
    return [(min(some), len(n), min(members[n[:-1]]) if n else None, len(some), len(kids[n]), leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, some in members.items()]


def test_trie(spark):
    rows = turns()
    df = spark.createDataFrame([(*r, "k", "u", "x", "p", "t") for r in rows], TURNS).repartition(3)
    got = Counter(map(tuple, conversation_trie(spark, df).collect()))
    assert got == Counter(trie(rows))
    assert max(r[1] for r in got) > 140


def test_trie_of_nothing_and_of_one(spark):
    assert conversation_trie(spark, spark.createDataFrame([], TURNS)).collect() == []
    one = [(7, None, None, None)]
    df = spark.createDataFrame([(*one[0], *"abcde")], TURNS)
    assert Counter(map(tuple, conversation_trie(spark, df).collect())) == Counter(trie(one))


# --- operator 12 ---------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, mask string, n string, part string, digest string, good string"


def papers():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(150)]
    say = lambda n, some=words: " ".join(rng.choice(some) for _ in range(n))
    full = " ".join(words)
    texts = [None, "", "  \n\t", full, full, full, say(120), say(300), say(120, ["A", "BC"]), "AB " * 50, full + " $", "É " * 120, full.upper(), say(99) + " x|y", "W" * 30]
    out = [(i, rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(220)]
    out += [(5, full, "en"), (5, full, "en"), (5, full, "de"), (None, full, "en"), (None, None, None), (3, "a b", "fr"), (900, full, "en"), (-4, full, None)]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 220, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (5, 1, 1), (-4, 1, None)]
    return out, marks


def audited(docs, marks):
    first, good, toxic = {}, set(), set()
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    for d, q, x in marks:
        good |= {d} if d is not None and q == 1 else set()
        toxic |= {d} if d is not None and x == 1 else set()
    parts = defaultdict(list)
    for d, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = ("A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
                 + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (d is not None and d > first[t]))
        parts[lang or ""].append((set(fails), d in good, d in toxic))
    out = []
    for part, rows in parts.items():
        share = Counter()
        some = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                alive = [r for r in rows if not r[0] & set(order[:k])]
                cut = [r for r in alive if f in r[0]]
                share[f] += len(cut)
                some.append((part, "".join(order), k + 1, len(alive) - len(cut), len(cut), sum(f in r[0] for r in rows) - len(cut),
                             sum(r[0] == {f} for r in rows), sum(r[1] for r in cut), sum(r[2] for r in cut)))
        out += [(*r, share[r[1][r[2] - 1]]) for r in some]
    return out


def test_audit(spark, monkeypatch):
    docs, marks = papers()
    df = spark.createDataFrame([(*r, "m", "n", "p", "d", "g") for r in docs], DOCS).repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert Counter(map(tuple, audit(df, labels).collect())) == Counter(audited(docs, marks))
    assert audit(df.limit(0), labels).collect() == []
    assert Counter(map(tuple, audit(df, labels.limit(0)).collect())) == Counter(audited(docs, []))


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(1)
    for block in (1, 3, 17, 1 << 20):
        monkeypatch.setattr(filter_audit, "BLOCK", block)
        for _ in range(30):
            text = "".join(rng.choice("ABcdé \n\t #") for _ in range(rng.randint(0, 400)))
            w = WORD.findall(text)
            want = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "#" in text]
            got = int(filter_audit.failures(np.frombuffer(text.encode(), np.uint8)))
            assert [bool(got >> i & 1) for i in range(4)] == want


def test_potentials_give_shapley_values():
    rng = random.Random(2)
    counts = {m: rng.randint(0, 50) for m in range(32)}
    v = filter_audit.coalition_values(counts)
    p = filter_audit.potentials(v)
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert (p[31] - p[31 & ~(1 << i)]) * 120 == total * filter_audit.SCALE


# --- operator 13 ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, cell string, rid string, v string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "r", "v", "s") for r in rows], VECTORS).repartition(3)


def exact(rows, queries, top):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    seen, some = set(), []
    for i, v in fine:
        if (i, v.tobytes()) not in seen:
            seen.add((i, v.tobytes()))
            some.append((i, v))
    d = max(len(v) for _, v in some)
    x = np.array([np.pad(v, (0, d - len(v))) for _, v in some])
    ids = np.array([i for i, _ in some])
    out = {}
    for j, (i, _) in enumerate(some):
        if queries(i):
            s = x @ x[j]
            order = [k for k in np.lexsort((ids, -s)) if k != j][:top]
            out.setdefault(i, []).append([(int(ids[k]), s[k]) for k in order])
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["query_rid"], r["rank"])):
        out[r["query_id"], r["query_rid"]].append(r)
    for rows in out.values():
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
    return out


def search(spark, rows, top=20, **more):
    df = frame(spark, rows)
    return found(nearest.nearest(spark, df, df.where("vec_id % 20 = 0"), top=top, **more))


def recall(got, want):
    hit = [len({r["vec_id"] for r in rows} & {i for i, _ in want[q][0]}) / max(1, len(want[q][0])) for (q, _), rows in got.items()]
    return sum(hit) / len(hit)


def test_all_candidates_if_fewer_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 2.0, 7.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [1.0, None]),
            (9, [inf, 1.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (0, [0.0, 3.0]), (20, [0.0, 0.0]), (40, [nan, 0.0]), (60, [9.0]), (-20, [0.25, -4.0])]
    got, want = search(spark, rows), exact(rows, lambda i: i % 20 == 0, 20)
    assert sorted([(r["vec_id"], r["score"]) for r in g] for (_, _), g in got.items()) == sorted(w for ws in want.values() for w in ws)
    assert Counter(q for q, _ in got) == Counter({q: len(ws) for q, ws in want.items()}) == Counter({0: 2, 60: 1, -20: 1})
    assert search(spark, []) == {} and search(spark, [(0, [1.0])]) == {} and search(spark, [(1, [1.0]), (2, [2.0])]) == {}


@pytest.mark.parametrize("scaled", [False, True])
def test_recall(spark, scaled):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 24))
    x[1000:1600] = x[7] + 0.05 * rng.standard_normal((600, 24))  # a fifth of the rows lies close together
    x /= np.sqrt((x * x).sum(1))[:, None]
    if scaled:
        x *= rng.lognormal(0, 0.5, 3000)[:, None]
    rows = list(enumerate(x.astype(np.float32).astype(float).tolist()))
    got, want = search(spark, rows), exact(rows, lambda i: i % 20 == 0, 20)
    assert set(q for q, _ in got) == set(want) and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    score = {q: dict(exact_scores) for q, exact_scores in ((q, [(i, float(x[i].astype(np.float32).astype(float) @ x[q].astype(np.float32).astype(float))) for i in range(3000)]) for q in want)}
    assert all(abs(r["score"] - score[q][r["vec_id"]]) < 1e-9 for (q, _), g in got.items() for r in g)


def test_a_hot_bucket_is_sliced_and_ties_go_to_small_ids(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 100)
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(900)] + [(i, rng.standard_normal(4).tolist()) for i in range(900, 1500)]
    rng.shuffle(rows)
    rows = [(int(i), v) for i, v in rows]
    for (q, _), g in (got := search(spark, rows)).items():
        if q < 900:
            top = [r["vec_id"] for r in g if abs(r["score"] - 30) < 1e-9]
            assert top == [i for i in range(900) if i != q][: len(top)] and len(top) <= 20
    assert len(got) == 75 and recall(got, exact(rows, lambda i: i % 20 == 0, 20)) >= 0.9


def test_whoever_finds_too_few_visits_all_buckets(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.tile([[5.0, 0, 0, 0, 0, 0]], (1500, 1)) + 0.01 * rng.standard_normal((1500, 6)), 5 * np.eye(6)[1:4]])
    rows = [(20 * i if i >= 1500 else 20 * i + 1, v) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]
    got, want = search(spark, rows, recall=0.3), exact(rows, lambda i: i % 20 == 0, 20)
    assert len(got) == 3 and all(len(g) == 20 for g in got.values()) and recall(got, want) >= 0.9


def test_found_buckets_come_in_order_of_success_and_reach_the_chances():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((2000, 16))
    index = nearest.fit_index(x, 200_000, float(np.sqrt((x * x).sum(1)).max()), 20, 4, 0.9, 1)
    for q in index.aim(x[:5]):
        for t in range(4):
            p = nearest.chances(index, q, t, 0.6)
            assert np.allclose(p.sum(1), 1)
            numbers = nearest.probes(index, q, t, 0.6)
            place = np.arange(p.shape[0])
            chance = p[place, numbers].prod(1)
            lift = chance / index.share[t][place, numbers].prod(1)
            assert len(np.unique(numbers, axis=0)) == len(numbers) and (np.diff(lift) <= 1e-9 * lift[0]).all()
            assert chance.sum() >= index.success > chance[:-1].sum()
