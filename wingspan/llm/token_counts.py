"""Operator 1: token counts of a byte-level BPE vocabulary.

Method: rank-synchronous array merging. The pre-tokens of a batch that have
not been counted yet are held as one ragged numpy array of symbols; in every
round each pre-token applies all occurrences of its own lowest-rank pair at
once (left to right where occurrences overlap), until no pair has a rank; the
surviving symbols are the tokens. A merge's product can only take part in
merges of higher rank, so this equals merging one pair at a time.

The work is one pass over the documents with no shuffle. A worker remembers the
counts of at most ``MEMORY`` pre-tokens and starts anew beyond that.

Defined results: a NULL text counts as empty (0 bytes, 0 tokens); ties and
repeated rows are counted row by row; an empty table gives an empty result; a
special token's own string inside a text is one token, as the library's default
has it; only ``id_col`` and ``text_col`` are read, so other columns, whatever
their names, do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import map_arrow, table, trimmed

NONE = np.int32(2**31 - 1)
#: Pre-tokens whose counts a worker remembers.
MEMORY = 300_000
#: Bytes of pre-tokens merged in one ragged array.
RAGGED_BYTES = 1 << 21
#: Pre-token pattern of the vocabulary's byte-level splitter (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merge ranks as a sorted array of pair keys."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int32)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PRE_TOKEN)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols each pre-token ends with."""
        out = np.zeros(len(tokens), np.int64)
        length = np.array([len(t) for t in tokens], np.int64)
        who = np.flatnonzero(length)
        sym = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        length = length[who]
        last = np.cumsum(length) - 1
        rank = np.full(len(sym), NONE, np.int32)
        if len(sym) > 1:
            rank[:-1] = self.rank(sym[:-1], sym[1:])
        rank[last] = NONE
        while len(who):
            start = np.cumsum(length) - length
            lowest = np.minimum.reduceat(rank, start)
            live = lowest != NONE
            out[who[~live]] = length[~live]
            if not live.all():
                keep = np.repeat(live, length)
                sym, rank = sym[keep], rank[keep]
                who, length, lowest = who[live], length[live], lowest[live]
                if not len(who):
                    break
            seq = np.repeat(np.arange(len(who)), length)
            hit = rank == lowest[seq]
            run = hit & np.concatenate([[False], hit[:-1]])
            if run.any():  # overlapping occurrences: every second one of a run
                at = np.arange(len(hit))
                first = np.maximum.accumulate(np.where(hit & ~run, at, 0))
                hit &= (at - first) % 2 == 0
            keep = ~np.concatenate([[False], hit[:-1]])
            sym[hit] = self.product[rank[hit]]
            length = length - np.bincount(seq[hit], minlength=len(who))
            sym, rank, merged = sym[keep], rank[keep], hit[keep]
            redo = merged.copy()  # pairs that begin or end with a merged symbol
            redo[:-1] |= merged[1:]
            last = np.cumsum(length) - 1
            rank[last], redo[last] = NONE, False
            redo = np.flatnonzero(redo)
            rank[redo] = self.rank(sym[redo], sym[redo + 1])
        return out


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


class Counter:
    """Token counts of texts, remembering the counts of pre-tokens seen."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab, self.known = vocab, {}

    def learn(self, new: list[str]) -> None:
        at = 0
        while at < len(new):
            part, size = [], 0
            while at < len(new) and (not part or size < RAGGED_BYTES):
                part.append(new[at].encode("utf-8", "surrogatepass"))
                size += len(part[-1])
                at += 1
            self.known.update(zip(new[at - len(part) : at], self.vocab.count(part).tolist(), strict=True))

    def texts(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        group, size, first = [], 0, 0
        for i, t in enumerate(texts):
            group.append(t or "")
            size += len(group[-1])
            if size >= RAGGED_BYTES or i == len(texts) - 1:
                out[first : i + 1] = self._group(group)
                group, size, first = [], 0, i + 1
        return out

    def _group(self, texts: list[str]) -> list[int]:
        find, special = self.vocab.pattern.findall, self.vocab.special
        split, extra = [], []
        for t in texts:
            if special is not None and "<" in t and (n := len(special.findall(t))):
                split.append([x for part in special.split(t) for x in find(part)])
                extra.append(n)
            else:
                split.append(find(t))
                extra.append(0)
        if len(self.known) > MEMORY:
            self.known = {}
        known = self.known
        new = set()
        for s in split:
            new.update(s)
        if new := [x for x in new if x not in known]:
            self.learn(new)
        return [sum(map(known.__getitem__, s)) + n for s, n in zip(split, extra, strict=True)]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``docs``."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.setdefault(vocab_path, Counter(_vocabulary(vocab_path)))
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(counter.texts(b.column(2).to_pylist()), pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"])
        counter.known = trimmed(counter.known)

    src = docs.select(F.col(id_col), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                      F.col(text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(src, counts, f"`{id_col}` {kind}, n_bytes long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)
