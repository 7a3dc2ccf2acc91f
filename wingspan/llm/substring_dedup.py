"""Operator 8: substring dedup over words.

Method: level-wise doubling. Windows repeated at one length alone are extended
to twice that length, until none survives or the final length is reached (4, 8
and then 13 words for the contract's window). Below the final length a window is
represented by the smallest fingerprint of the shorter windows in it, so a
fraction of the positions is enough to meet every repetition: a window that
repeats has the same representative in both places, at every level. The last
level fingerprints the surviving windows whole, and a word is removed if it lies
in a window whose word sequence also starts in a document with a smaller id.
Copies of whole documents take the same way as any other passage.

Spark's part: a task first settles what repeats within a block of its own
documents and sends one representative of each fingerprint, so a passage that
stands in a third of all documents reaches the shuffle once a block, not once a
document; a window function over the fingerprint settles the rest. Each level is
written once to the shared folder, and removed when the next one is written.

The last level compares windows by 96 bits from two unlike families of word
fingerprints (each sums a value of the byte times a coefficient of its place, so
that no arrangement of the same letters is favoured): over 1e13 windows the
expected number of false repeats is below one in a thousand.

Defined results: a NULL text has no words; repeated rows and rows that share an
id are not earlier than each other; a NULL id comes after all others; texts of
fewer than ``window`` words lose nothing; an empty table gives an empty result;
very long texts are treated whole, in blocks; only ``id_col`` and ``text_col``
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import U, binary_rows, drop_stage, grams, map_arrow, mix, row_key, sliding_min, stage, table, word_hashes

_LAST = 2**63 - 1
#: Words of the shortest windows, and how many fingerprints a task settles at a time.
FIRST = 4
BLOCK = 1 << 20


def lengths(window: int, first: int = FIRST) -> list[int]:
    """The lengths of the levels: each twice the one before, the last the window's."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a, pa.int64())


def _alive(words: np.ndarray, window: int, before: int, known: np.ndarray) -> np.ndarray:
    """Starts of the windows whose representative at the length ``before`` is among
    the repeated ones; all of them where there was no level before."""
    n = len(words) - window + 1
    if n <= 0 or not before:
        return np.arange(max(n, 0))
    return np.flatnonzero(np.isin(sliding_min(grams(words, before), window - before + 1), known))


def _groups(*h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by value and the start of each group of equal values in it."""
    order = np.lexsort(h)
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in h], axis=0)
    return order, np.flatnonzero(new)


def _blocks(b: pa.RecordBatch, prints) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """For blocks of consecutive rows of a batch: the row of each fingerprint and the
    arrays that ``prints(text, known)`` gives, joined; a text is never divided."""
    off = np.asarray(b.column(3).offsets)
    known = np.asarray(b.column(3).values).view(np.uint64)
    rows: list[np.ndarray] = []
    got: list[tuple[np.ndarray, ...]] = []
    size = 0
    for i, data in enumerate(binary_rows(b.column(2))):
        found = prints(data, known[off[i] : off[i + 1]])
        if len(found[0]):
            rows.append(np.full(len(found[0]), i, np.int32))
            got.append(found)
            size += len(found[0])
        if size >= BLOCK or (size and i == b.num_rows - 1):
            yield np.concatenate(rows), [np.concatenate(c) for c in zip(*got, strict=True)]
            rows, got, size = [], [], 0
    if size:
        yield np.concatenate(rows), [np.concatenate(c) for c in zip(*got, strict=True)]


def _level(window: int, length: int, before: int):
    """Rows (key, rid, value, settled): the representatives, at this length, of the
    surviving windows, with the fingerprint as key and the document as value. What two
    documents of a block share is settled for them (another key for each row, the
    fingerprint as value) and sent on as its smallest and largest document (rid NULL)."""

    def prints(data: np.ndarray, known: np.ndarray) -> tuple[np.ndarray]:
        words = word_hashes(data, lower=False)
        p = _alive(words, window, before, known)
        if not len(p):
            return (np.empty(0, np.uint64),)
        return (np.unique(sliding_min(grams(words, length), window - length + 1)[p]),)

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid, doc = np.asarray(b.column(0)), np.asarray(b.column(1))
            for at, (h,) in _blocks(b, prints):
                order, start = _groups(h)
                h, d, r = h[order], doc[at[order]], rid[at[order]]
                low, high = np.minimum.reduceat(d, start), np.maximum.reduceat(d, start)
                size = np.diff(np.append(start, len(h)))
                shared = low < high
                every = np.repeat(shared, size)
                n = int(every.sum())
                key = np.concatenate([mix(h[every] ^ r[every].view(np.uint64)), h[start[shared]], h[start[shared]], h[~every]])
                value = np.concatenate([h[every].view(np.int64), low[shared], high[shared], d[~every]])
                out_r = np.concatenate([r[every], np.zeros(2 * shared.sum(), np.int64), r[~every]])
                settled = np.arange(len(key)) < n
                null = ~settled & (np.arange(len(key)) < n + 2 * shared.sum())
                yield pa.RecordBatch.from_arrays([_long(key), pa.array(out_r, pa.int64(), mask=null), pa.array(value), pa.array(settled)],
                                                 names=["key", "rid", "value", "settled"])

    return level


def _last_level(window: int, before: int):
    """Rows (h, check, rid, doc, start, stop): the surviving windows at full length. Where
    two documents of a block share one, all but the earliest are settled (h NULL), as
    runs of window starts; the others are sent on, without ``stop``."""

    def prints(data: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        words = word_hashes(data, lower=False)
        p = _alive(words, window, before, known)
        if not len(p):
            return np.empty(0, np.uint64), np.empty(0, np.int32), p
        other = grams(word_hashes(data, lower=False, family=1), window)[p]
        return grams(words, window)[p], (other >> U(32)).astype(np.uint32).view(np.int32), p

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "check", "rid", "doc", "start", "stop"]
        for b in batches:
            rid, doc = np.asarray(b.column(0)), np.asarray(b.column(1))
            for at, (h, check, pos) in _blocks(b, prints):
                order, start = _groups(check, h)
                d = doc[at[order]]
                low = np.repeat(np.minimum.reduceat(d, start), np.diff(np.append(start, len(h))))
                late = np.zeros(len(h), bool)
                late[order] = d > low
                la, lp = at[late], pos[late]  # in order of document, then place
                if len(la):
                    first = np.concatenate([[True], (la[1:] != la[:-1]) | (lp[1:] != lp[:-1] + 1)])
                    last = np.append(first[1:], True)
                    n = int(first.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), _long(rid[la[first]]), _long(doc[la[first]]),
                         pa.array(lp[first], pa.int64()), pa.array(lp[last] + 1, pa.int64())], names=names)
                ea, ep = at[~late], pos[~late]
                yield pa.RecordBatch.from_arrays([_long(h[~late]), pa.array(check[~late]), _long(rid[ea]), _long(doc[ea]),
                                                  pa.array(ep, pa.int64()), pa.nulls(len(ep), pa.int64())], names=names)

    return level


LEVEL = "key long, rid long, value long, settled boolean"


def _repeated(rows: DataFrame) -> DataFrame:
    """(rid, h) from a level's rows: the fingerprints that two documents hold."""
    w = Window.partitionBy("key")
    seen = rows.select("*", *[f(F.when(~F.col("settled"), F.col("value"))).over(w).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))])
    seen = seen.where("rid is not null and (settled or low < high)")
    return seen.select("rid", F.when(F.col("settled"), F.col("value")).otherwise(F.col("key")).alias("h"))


def repeated_windows(spark: SparkSession, docs: DataFrame, window: int = 13, id_col: str = "doc_id",
                     text_col: str = "text", first: int = FIRST) -> DataFrame:
    """(rid, start, stop): for every row key, the runs of window starts that also start
    in a document with a smaller id."""
    src = docs.select(row_key(id_col, text_col).alias("rid"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                      F.col(text_col).cast("binary").alias("text"))
    known, before = None, 0

    def texts() -> DataFrame:
        """The documents that still have candidates, each with its repeated fingerprints."""
        if known is None:
            return src.withColumn("known", F.array().cast("array<long>"))
        return src.join(known.groupBy("rid").agg(F.collect_set("h").alias("known")), "rid").select("rid", "doc", "text", "known")

    for length in lengths(window, first)[:-1]:
        # frames of a level are not named here: a name would keep its shuffle files through the next one
        found = stage(spark, _repeated(map_arrow(texts(), _level(window, length, before), LEVEL)), f"repeated-{length}")
        drop_stage(spark, known)
        known, before = found, length
        if known.isEmpty():  # no candidate survives: nothing longer can repeat
            break

    full = stage(spark, map_arrow(texts(), _last_level(window, before), "h long, check int, rid long, doc long, start long, stop long"), "windows")
    drop_stage(spark, known)
    settled = full.where("h is null").select("rid", "start", "stop")
    rest = full.where("h is not null").select("h", "check", "rid", "doc", "start")
    rest = rest.select("rid", "doc", "start", (F.col("start") + 1).alias("stop"), F.min("doc").over(Window.partitionBy("h", "check")).alias("low"))
    runs = stage(spark, settled.unionByName(rest.where("doc > low").select("rid", "start", "stop")), "runs")
    drop_stage(spark, full)
    return runs


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = 13, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, spans, kept): ``spans`` are the removed runs of
    words [start, stop), ``kept`` the remaining words joined by one space."""
    runs = repeated_windows(spark, docs, window, id_col, text_col)
    per = runs.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    per = per.select("rid", F.transform("runs", lambda r: r["start"]).alias("start"), F.transform("runs", lambda r: r["stop"]).alias("stop"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, stop = b.column(2), b.column(3)
            out: list[tuple] = []
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                words = t.split() if t else []
                n = len(words)
                gone = np.zeros(n + 1, np.int32)
                if start[i].is_valid and len(start[i]):
                    np.add.at(gone, np.asarray(start[i].values), 1)
                    np.add.at(gone, np.minimum(np.asarray(stop[i].values) + window - 1, n), -1)
                    gone = np.cumsum(gone)
                mask = gone[:n] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                if mask.any():
                    words = [w for w, g in zip(words, mask.tolist(), strict=True) if not g]
                out.append((n, int(mask.sum()), [{"start": int(x), "stop": int(y)} for x, y in edge.reshape(-1, 2)],
                            b" ".join(words).decode("utf-8", "replace")))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(cols[3], pa.string())],
                names=[id_col, "n_words", "n_removed", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(row_key(id_col, text_col).alias("rid"), id_col, F.col(text_col).cast("binary").alias("__text"))
    src = src.join(per, "rid", "left").select(id_col, "__text", "start", "stop")
    return map_arrow(
        src, cut, f"`{id_col}` {kind}, n_words long, n_removed long, spans array<struct<start:bigint,stop:bigint>>, kept string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
