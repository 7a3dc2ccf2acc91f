"""Operator 4: quality classifier on graded ratings.

Method: ordinal cumulative-link regression. A document is a sparse vector of
hashed text features; all grades share one weight vector, and ordered thresholds
turn the score into cumulative probabilities P(grade <= g) = logistic(c_g - w.x).
The fitted model gives every document its expected grade and the probability of
the upper tail P(grade >= keep), which selects.

Features: lower-cased words and the shape of each word (letters, capitals,
digits and marks by class, runs shortened), hashed to ``BITS`` bits, with weight
log(1 + count). The fit screens them first: a feature stays if its presence and
the grade depend on each other (chi-square of at least ``SCREEN``).

The model is fitted on at most ``sample`` labelled rows, the smallest by a hash of
their id (a bound of the fit only): their sparse vectors are built by Spark and
fitted on the driver by batch gradient steps with fixed seeds. All documents are
then scored whole, in one pass with no shuffle.

Grades of the labels table: 0 toxic, 1 low quality, 2 good.

Defined results: NULL and empty texts have no features and get the score of the
thresholds alone; ties and repeated rows are scored row by row; rows with a NULL
label are not used; without labels every grade is equally likely and all are
kept; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import map_arrow, table

#: Hashed feature space, and labelled rows the model is fitted on at most.
BITS, SAMPLE = 20, 8000
#: Least chi-square, with number of rows, of a feature that the model uses.
SCREEN, LEAST = 25.0, 4
MEMORY = 150_000
_SHAPE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "A" * 26 + "0" * 10)
_LETTERS = re.compile(r"[^\W\d_A]+")
_RUNS = re.compile(r"(.)\1+")


def word_features(word: str) -> tuple[int, int]:
    """Hashed places of a word and of its shape."""
    size = (1 << BITS) - 1
    bare = word.lower().strip(".,;:!?\"'()")
    shape = _RUNS.sub(r"\1", _LETTERS.sub("a", word.translate(_SHAPE)))
    return crc32(b"w" + bare.encode()) & size, crc32(b"s" + shape[:12].encode()) & size


_KNOWN: dict[str, tuple[int, int]] = {}


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights) of a text's sparse vector."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    known = _KNOWN
    if len(known) > MEMORY:
        known.clear()
    for w in set(words):
        if w not in known:
            known[w] = word_features(w)
    flat = np.array([known[w] for w in words], np.int64).ravel()
    places, counts = np.unique(flat, return_counts=True)
    return places, 0.3 * np.log1p(counts)


@dataclass(frozen=True)
class Model:
    """Shared weights and ordered thresholds (one fewer than the grades)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = g), one row a score."""
        z = np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)
        below = np.concatenate([np.zeros((len(scores), 1)), 1 / (1 + np.exp(-z)), np.ones((len(scores), 1))], axis=1)
        return np.diff(below, axis=1)


def screen(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows with only the features whose presence tells something of the grade."""
    total = np.bincount(grades, minlength=n_grades).astype(float)
    seen = np.zeros((n_grades, 1 << BITS))
    for (p, _), g in zip(rows, grades, strict=True):
        seen[g, p] += 1
    share = (total / max(total.sum(), 1))[:, None]
    held = seen.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        inside = (seen - held * share) ** 2 / (held * share)
        outside = (seen - held * share) ** 2 / ((total.sum() - held) * share)
    good = (np.nan_to_num(inside + outside).sum(axis=0) >= SCREEN) & (held >= LEAST)
    return [(p[good[p]], w[good[p]]) for p, w in rows]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, steps: int = 250, rate: float = 0.3,
        decay: float = 1e-5, balance: float = 0.5) -> Model:
    """Maximum likelihood of the cumulative-link model by Adam steps over all rows; a
    row weighs as its grade's frequency to the power -balance. The gaps between thresholds are exponentials, so
    they stay ordered."""
    rows = screen(rows, grades, n_grades)
    size = np.array([len(p) for p, _ in rows], np.int64)
    who = np.repeat(np.arange(len(rows)), size)
    place, weight = (np.concatenate([r[k] for r in rows]) if size.sum() else np.empty(0, np.int64 if k == 0 else float) for k in (0, 1))
    dim = 1 << BITS
    per = np.bincount(grades, minlength=n_grades)
    importance = (1 / np.maximum(per, 1) ** balance)[grades]
    importance = importance / importance.sum()
    # parameters: weights, first threshold, log gaps
    x = np.zeros(dim + n_grades - 1)
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        cut = np.cumsum(np.concatenate([[x[dim]], np.exp(x[dim + 1 :])]))
        score = np.bincount(who, weights=weight * x[place], minlength=len(rows))
        edge = np.concatenate([[-np.inf], cut, [np.inf]])
        with np.errstate(over="ignore"):
            hi, lo = 1 / (1 + np.exp(-(edge[grades + 1] - score))), 1 / (1 + np.exp(-(edge[grades] - score)))
        p = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
        g_score = importance * (d_hi - d_lo) / p
        g_cut = -np.bincount(grades, weights=importance * d_hi / p, minlength=n_grades)[: n_grades - 1]
        g_cut = g_cut + np.bincount(grades, weights=importance * d_lo / p, minlength=n_grades)[1:]
        tail = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(place, weights=weight * g_score[who], minlength=dim) + decay * x[:dim],
                               [tail[0]], tail[1:] * np.exp(x[dim + 1 :])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(x[:dim].astype(np.float32), np.cumsum(np.concatenate([[x[dim]], np.exp(x[dim + 1 :])])))


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 toxic, 1 low quality, 2 good; NULL where the labels do not tell."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when((F.col(quality) == 1) & (F.col(toxic) == 0), 2)


def train(docs: DataFrame, grades: DataFrame, n_grades: int = 3, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          grade_col: str = "grade") -> Model:
    """Fit on the graded documents, at most ``sample`` of them."""
    picked = grades.select(F.col(id_col).alias("__id"), F.col(grade_col).cast("int").alias("__g")).where("__g is not null and __id is not null")
    picked = picked.orderBy(F.xxhash64("__id"), "__id", "__g").limit(sample)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(F.broadcast(picked), "__id")  # sample rows at most

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([p for p, _ in got], pa.list_(pa.int32())), pa.array([w for _, w in got], pa.list_(pa.float32()))],
                names=["id", "g", "p", "w"])

    got = map_arrow(rows.select(F.xxhash64("__id"), "__g", "__t"), vectors, "id long, g int, p array<int>, w array<float>").toArrow()
    if not got.num_rows:
        return Model(np.zeros(1 << BITS, np.float32), np.log(np.arange(1, n_grades) / np.arange(n_grades - 1, 0, -1)))
    order = np.argsort(np.asarray(got["id"]), kind="stable")
    p, w = got["p"].to_pylist(), got["w"].to_pylist()
    return fit([(np.array(p[i], np.int64), np.array(w[i], float)) for i in order], np.asarray(got["g"])[order].astype(np.int64), n_grades)


def score(docs: DataFrame, model: Model, keep: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, expected_grade, tail_probability): the tail is P(grade >= keep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.empty(b.num_rows)
            for i in range(b.num_rows):
                p, w = features(b.column(1)[i].as_py())
                s[i] = (model.weights[p] * w).sum()
            prob = model.probabilities(s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prob @ np.arange(prob.shape[1])), pa.array(prob[:, keep:].sum(axis=1))],
                                             names=[id_col, "expected_grade", "tail_probability"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, expected_grade double, tail_probability double")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grades = table(spark, sf_dir, "labels").select("doc_id", grade_of().alias("grade"))
    out = score(docs, train(docs, grades), keep=2)
    return out.select("doc_id", F.round("expected_grade", 6).alias("expected_grade"), F.round("tail_probability", 6).alias("tail_probability"),
                      (F.col("tail_probability") >= 0.5).alias("kept"))
