"""Operator 2: packing token pieces into as few sequences as possible.

Method: pattern packing by non-negative least squares. The lengths of all pieces
form a histogram of at most ``max_tokens`` bins, whatever the number of
documents. On a grid of length classes, all patterns of up to four pieces that
fill a sequence are enumerated; non-negative least squares fits repeat counts to
the histogram; the counts are rounded down and carried out on the exact lengths
(the last place of a pattern takes the longest piece that fits), and what is left
over fills the free room of these sequences, and new ones, best fit first, whole
runs of equal lengths at a time. The plan says "the r-th piece of length l goes to
sequence s at offset o" and is as large as the histogram, not as the corpus.

Spark does the rest: a first pass encodes and cuts the documents, numbers the
pieces of each length within its task and is written once to the shared folder;
per (task, length) counts give every piece its number among all pieces of its
length without gathering a length in one task; a last narrow pass looks the place
up in the plan.

Defined results: a NULL text is empty, so it has just the end token; ties and
repeated rows are packed row by row; an empty table gives an empty result; very
long texts are cut into pieces of ``max_tokens``; only ``id_col`` and ``text_col``
are read, so other columns do not matter.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import map_arrow, stage, table, trimmed

#: Length classes of the pattern grid, and pieces in a pattern at most.
CLASSES = 256
#: Stretches whose ids a worker remembers.
MEMORY = 300_000
#: Bytes of text encoded at a time, in whole rows.
BLOCK = 1 << 23
#: Letters that the vocabulary's normalizer and splitter leave as they are.
_PLAIN = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
#: Characters of texts (in Arrow's notation) whose lower case is not taken here: beyond
#: Latin, or not one letter for one letter.
_FOREIGN = r"[^\x{0}-\x{12f}\x{131}-\x{24f}]"
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,!?;:#$%&*")] = True
_LETTER[97:123] = True


def stretches(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The stretches of all texts to encode, in order, and each text's first one's
    number (and the end). They lie between spaces and line feeds, and are cut where
    a letter meets a mark; the vocabulary never joins across either. It lowers case,
    so that is done here first, and fewer differ."""
    text = pc.fill_null(column, "").cast(pa.large_string())
    special = pc.match_substring(text, "<|")  # special tokens stay as they are
    text = pc.if_else(pc.or_(special, pc.match_substring_regex(text, _FOREIGN)), text, pc.utf8_lower(text))
    buf = text.buffers()
    offset = np.frombuffer(buf[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(buf[2] or b"", np.uint8)[offset[0] : offset[-1]]
    offset = offset - offset[0]
    at = np.flatnonzero(_MARK[data])
    at = at[at > 0]
    before = data[at - 1]  # a letter of one byte, or the second of one of U+00E0 to U+00FF but the division sign
    at = at[_LETTER[before] | (before >= 0xA0) & (before != 0xB7) & (data[at - 2] == 0xC3)]
    if (raw := np.asarray(special)).any():
        at = at[~raw[np.searchsorted(offset, at, side="right") - 1]]
    keep = (data != 32) & (data != 10)
    first = np.zeros(len(data) + 1, bool)
    first[1:] = ~keep
    first[offset] = True
    first[at] = True
    first = first[:-1]
    cut = np.append(np.flatnonzero(first[keep]), np.count_nonzero(keep))
    words = pa.LargeStringArray.from_buffers(len(cut) - 1, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(data[keep]))
    return words, np.searchsorted(np.flatnonzero(first & keep), offset)


class Encoder:
    """Token ids of whole texts by the tokenizers library, as packed little-endian
    32-bit numbers. Each distinct stretch is encoded once and remembered; Arrow finds
    the distinct ones of a block and puts their ids in place."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task slot
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        # the same model without the steps that leave plain letters as they are
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ids = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for token, i in ids.items() if token.endswith("</w>")]] = True

    def _learn(self, new: list[str]) -> None:
        """Encode stretches not seen yet. A word of letters only ends with its one
        end-of-word token, so many of them are encoded as one line and cut there."""
        plain, letters, other = [], [], []
        for w in new:
            (plain if _PLAIN.fullmatch(w) else letters if w.isalpha() else other).append(w)
        for tokenizer, words in ((self.plain, plain), (self.tokenizer, letters)):
            for at in range(0, len(words), 200):
                part = words[at : at + 200]
                ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
                end = 4 * (np.flatnonzero(self.ends[ids]) + 1)
                if len(end) == len(part) and end[-1] == 4 * len(ids):
                    raw = ids.tobytes()
                    self.known.update(zip(part, [raw[s:e] for s, e in pairwise([0, *end.tolist()])], strict=True))
                else:
                    other += part
        for at in range(0, len(other), 2000):
            part = other[at : at + 2000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, "<u4").tobytes()

    def texts(self, column: pa.Array) -> list[bytes]:
        words, first = stretches(column)
        coded = words.dictionary_encode()
        used = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > MEMORY:  # keep what is in use
            self.known = {w: self.known[w] for w in used if w in self.known}
        known = self.known
        self._learn([w for w in used if w not in known])
        ids = pa.array(list(map(known.__getitem__, used)), pa.large_binary()).take(coded.indices)
        buf = ids.buffers()
        if not len(ids) or buf[2] is None:
            return [b""] * len(column)
        at = np.frombuffer(buf[1], np.int64)[first + ids.offset].tolist()
        raw = memoryview(buf[2])
        return [bytes(raw[s:e]) for s, e in pairwise(at)]


def blocks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``BLOCK`` bytes of text (second column)."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(1)), 0)), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(size // BLOCK)) + 1
    for s, e in pairwise([0, *cuts.tolist(), b.num_rows]):
        if e > s:
            yield b.slice(s, e - s)


_ENCODERS: dict[str, Encoder] = {}


def encode_pieces(docs: DataFrame, vocab_path: str, max_tokens: int = 4096, end_id: int = 1,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth): the pieces of every
    document; ``nth`` numbers the pieces of one length within a task."""
    tail = np.array([end_id], "<u4").tobytes()
    width = 4 * max_tokens

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocab_path not in _ENCODERS:
            _ENCODERS[vocab_path] = Encoder(vocab_path)
        encoder, task = _ENCODERS[vocab_path], TaskContext.get().partitionId()
        seen = [0] * (max_tokens + 1)
        for b in batches:
            for part in blocks(b):
                rows: list[tuple[int, int, int, int, int, int]] = []
                for i, ids in enumerate(encoder.texts(part.column(1))):
                    ids += tail
                    for k, s in enumerate(range(0, len(ids), width)):
                        piece = ids[s : s + width]
                        n = len(piece) // 4
                        rows.append((i, k, s // 4, n, zlib.crc32(piece), seen[n]))
                        seen[n] += 1
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()),
                     pa.array([task] * len(rows), pa.int32()), pa.array(cols[5], pa.int64())],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "task", "nth"])
        encoder.known = trimmed(encoder.known)

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(
        docs.select(id_col, text_col), encode, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")


def patterns(classes: int, present: np.ndarray) -> np.ndarray:
    """All multisets of 1 to 4 present classes that sum to ``classes``, one a
    row, largest first, 0 for no piece."""
    rows = []
    for a in range(classes // 4 + 1):
        for b in range(a, (classes - a) // 3 + 1):
            c = np.arange(b, (classes - a - b) // 2 + 1)
            rows.append(np.stack([classes - a - b - c, c, np.full_like(c, b), np.full_like(c, a)], axis=1))
    p = np.concatenate(rows)
    usable = present.copy()
    usable[0] = True
    return p[usable[p].all(axis=1)]


def nnls(pats: np.ndarray, b: np.ndarray, rounds: int = 600) -> dict[int, float]:
    """min ||A x - b|| with x >= 0 by the active-set method; column j of A holds
    the class counts of pattern j. Longer classes weigh more: short pieces find
    room later. Returns the patterns with a positive count."""
    size = len(b)
    weight = np.sqrt(np.arange(size) / size)
    scale = max(float(b.max()), 1.0)
    target = weight * b / scale

    def column(j: int) -> np.ndarray:
        col = np.zeros(size)
        np.add.at(col, pats[j], 1.0)
        col[0] = 0
        return col * weight

    used: list[int] = []
    a, x = np.zeros((size, 0)), np.zeros(0)
    refused: set[int] = set()
    for _ in range(rounds):
        r = (target - a @ x) * weight
        r[0] = 0
        gain = r[pats].sum(axis=1)
        gain[used + list(refused)] = -1
        j = int(gain.argmax())
        if gain[j] <= 1e-9:
            break
        trial, trial_a, start = [*used, j], np.column_stack([a, column(j)]), np.append(x, 0.0)
        while True:
            s = np.linalg.lstsq(trial_a, target, rcond=None)[0]
            if s.min(initial=1.0) > 0:
                break
            low = s <= 0
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.nanmin(np.where(low, start / (start - s), np.inf))
            start = start + max(step, 0.0) * (s - start)
            keep = ~(low & (start <= 1e-12))
            if keep.all():
                keep[np.argmin(s)] = False
            trial, trial_a, start = [t for t, k in zip(trial, keep, strict=True) if k], trial_a[:, keep], start[keep]
        if j not in trial:
            refused.add(j)
        else:
            refused.clear()
        used, a, x = trial, trial_a, s
    return {j: float(v) * scale for j, v in zip(used, x, strict=True)}


@dataclass
class Plan:
    """Places of the pieces, as runs: the pieces number ``first`` and on of one
    length go to ``bins`` sequences from ``sequence`` on, round by round, at
    ``offset`` and then behind each other."""

    key: np.ndarray
    first: np.ndarray
    bins: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int = 0

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << 45 | number, side="right") - 1
        r = number - self.first[at]
        return self.sequence[at] + r % self.bins[at], self.offset[at] + r // self.bins[at] * length


@dataclass
class _Packer:
    """Bins in groups: equal fillings with their number."""

    room: int
    left: np.ndarray
    closed: list = field(default_factory=list)
    open: dict = field(default_factory=dict)
    rooms: list = field(default_factory=list)

    def add(self, filling: tuple, bins: int, room: int) -> None:
        if bins and room:
            if room not in self.open:
                self.open[room] = []
                insort(self.rooms, room)
            self.open[room].append((filling, bins))
        elif bins:
            self.closed.append((filling, bins))

    def pattern(self, classes: list[int], repeats: int, width: int) -> None:
        """Carry out one pattern on exact lengths, as long as they last."""
        while repeats > 0:
            room, picked = self.room, {}
            for k, c in enumerate(classes):
                last = k == len(classes) - 1
                top = room if last else min(room, c * width)
                low = (c - 1) * width + 1
                free = self.left[low : top + 1].copy() if top >= low else np.empty(0, np.int64)
                for n, q in picked.items():
                    if low <= n <= top:
                        free[n - low] -= q
                at = np.flatnonzero(free > 0)
                if not len(at):
                    return
                n = int(at[-1]) + low
                picked[n] = picked.get(n, 0) + 1
                room -= n
            m = min([repeats, *(int(self.left[n]) // q for n, q in picked.items())])
            for n, q in picked.items():
                self.left[n] -= m * q
            self.add(tuple(picked.items()), m, room)
            repeats -= m

    def rest(self) -> None:
        """Best fit, longest first, a whole run of equal lengths at a time."""
        for n in range(self.room, 0, -1):
            c = int(self.left[n])
            while c:
                at = bisect_left(self.rooms, n)
                room = self.rooms[at] if at < len(self.rooms) else self.room
                q = room // n
                filling, bins = self.open[room].pop() if at < len(self.rooms) else ((), -(-c // q))
                if at < len(self.rooms) and not self.open[room]:
                    del self.open[room], self.rooms[at]
                full = min(bins, c // q)
                self.add((*filling, (n, q)), full, room - q * n)
                c -= full * q
                bins -= full
                if bins and c:  # fewer than q are left
                    self.add((*filling, (n, c)), 1, room - c * n)
                    c, bins = 0, bins - 1
                self.add(filling, bins if filling else 0, room)
            self.left[n] = 0

    def plan(self) -> Plan:
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        groups = self.closed + [g for r in self.rooms for g in self.open[r]]
        for filling, bins in groups:
            offset = 0
            for n, q in filling:
                first = taken.get(n, 0)
                rows.append((n << 45 | first, first, bins, sequence, offset))
                taken[n] = first + bins * q
                offset += n * q
            sequence += bins
        cols = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        return Plan(*cols, sequences=sequence)


def plan_packing(histogram: dict[int, int], max_tokens: int = 4096) -> Plan:
    """The plan for a histogram {length: number of pieces}."""
    left = np.zeros(max_tokens + 1, np.int64)
    for n, c in histogram.items():
        left[n] = c
    classes = min(CLASSES, max_tokens)
    width = -(-max_tokens // classes)
    classes = -(-max_tokens // width)
    by_class = np.bincount(-(-np.arange(max_tokens + 1) // width), weights=left, minlength=classes + 1)
    packer = _Packer(max_tokens, left)
    pats = patterns(classes, by_class > 0)
    if len(pats):
        fitted = nnls(pats, by_class)
        for j, v in sorted(fitted.items(), key=lambda x: -x[1]):
            packer.pattern([int(c) for c in pats[j] if c], int(v + 1e-9), width)
    packer.rest()
    return packer.plan()


def pack(spark: SparkSession, pieces: DataFrame, max_tokens: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to the pieces of ``encode_pieces``."""
    pieces = stage(spark, pieces, "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= max_tokens rows
    plan = plan_packing(histogram, max_tokens)
    before = per_task.select("task", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("before"))
    numbered = pieces.join(before, ["task", "length"]).withColumn("nth", F.col("nth") + F.col("before"))
    keep = [c for c in pieces.columns if c not in ("task", "nth")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns - 1
            seq, off = plan.place(np.asarray(b.column(keep.index("length"))), np.asarray(b.column(n)))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             names=[*keep, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(numbered.select(*keep, "nth"), place, kinds + ", sequence_id long, offset long")


def pack_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Encode, cut and pack with the production parameters (4096 tokens, end id 1)."""
    import public_tokenizers

    return pack(spark, encode_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))
