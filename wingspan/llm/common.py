"""Helpers shared by the operators of this subpackage: reading a table,
writing a stage to the shared folder, and byte / word fingerprints computed
with numpy over Arrow buffers inside Spark tasks."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import wingspan
from wingspan.session import checkpoint_dir, drop_paths

#: Word separators of the contracts: space and the controls tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Spark's setting that removes a query's shuffle files as soon as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

U = np.uint64
_SEED = U(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    lineage, survives lost executors, and lets Spark drop the shuffle files of
    the steps before it. The write's own shuffles serve nothing else, so Spark
    is told to remove their files when it ends, not when the frame is collected."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    schema = df.schema
    del df
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    out._staged = path  # noqa: SLF001
    return out


def drop_stage(spark: SparkSession, df: DataFrame | None) -> None:
    """Remove the folder of a frame that ``stage`` gave, once nothing reads it any more."""
    if df is not None:
        drop_paths(spark, [df._staged])  # noqa: SLF001


def aside(df: DataFrame, *keep: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` as the columns ``keep`` and one struct of all others, and the way back. What
    is done in between may add columns of any name without touching a column of ``df``."""
    others = [c for c in df.columns if c not in keep]
    name = "aside" + "_" * max((len(c) for c in keep), default=0)  # longer than all of them
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    rest = F.struct(*[quoted(c) for c in others]) if others else F.struct(F.lit(0).alias("none"))

    def back(out: DataFrame, *added: str) -> DataFrame:
        """The columns of ``df``, and those of ``out`` given as pairs (new name, name in ``out``)."""
        new = dict(zip(added[::2], added[1::2], strict=True))
        return out.select(*[quoted(c) if c in keep else F.col(name).getField(c).alias(c) for c in df.columns if c not in new],
                          *[quoted(c).alias(to) for to, c in new.items()])

    return df.select(*[quoted(c) for c in keep], rest.alias(name)), back


def map_arrow(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package sent to the executors first. A worker that
    has finished a partition gives its free memory back, since it stays alive."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
                trim(0)

    return df.mapInArrow(run, schema)


def trimmed(known: dict, most: int = 50_000) -> dict:
    """The entries of a worker's memory that came first (the most frequent ones)."""
    return known if len(known) <= most else dict(islice(known.items(), most))


def ship(spark: SparkSession) -> None:
    """Add this package to the session's Python files, once."""
    sc = spark.sparkContext
    if getattr(sc, "_wingspan_shipped", False):
        return
    root = Path(wingspan.__file__).parent
    path = f"{tempfile.mkdtemp(prefix='wingspan-py-')}/wingspan_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"wingspan/{p.relative_to(root)}")
    sc.addPyFile(path)
    sc._wingspan_shipped = True  # noqa: SLF001


def release(spark: SparkSession) -> None:
    """Let the driver notice that earlier frames are gone, so that the context
    cleaner removes their shuffle files now, not at the next full collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # noqa: SLF001


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A row's identity for joins inside an operator: rows with one id but
    different texts stay apart, NULL ids get a key too, and equal rows share
    one (their results are equal)."""
    return F.xxhash64(F.lit("row"), F.col(id_col), F.col(text_col))


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, in place on a uint64 array."""
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


BYTES = mix(np.arange(1, 257, dtype=U) * _SEED)
BASE = U(0xD1342543DE82EF95)  # odd, hence invertible modulo 2**64
BASE_INV = U(pow(int(BASE), -1, 1 << 64))


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate([np.ones(1, U), np.full(m - 1, BASE, U)]))
            self.down = np.cumprod(np.concatenate([np.ones(1, U), np.full(m - 1, BASE_INV, U)]))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def prefix(data: np.ndarray, values: np.ndarray = BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(P, inverse powers): the fingerprint of data[s:e] is (P[e]-P[s])*inv[s]."""
    up, down = _POWERS.upto(len(data) + 1)
    p = np.empty(len(data) + 1, U)
    p[0] = 0
    np.cumsum(values[data] * up[: len(data)], out=p[1:])
    return p, down


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words in a byte array."""
    gap = np.ones(len(data) + 2, np.int8)
    gap[1:-1] = is_space(data)
    edge = np.diff(gap)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _family(k: int) -> tuple[np.ndarray, np.ndarray]:
    """A value for each byte and a coefficient for each of a word's first places."""
    salt = mix(np.array([k + 1], U) * U(0x8CB92BA72F3D8DD7))[0]
    return mix(np.arange(1, 257, dtype=U) * _SEED ^ salt), mix(np.arange(1, PLACES + 1, dtype=U) * U(0xE7037ED1A0B428DB) ^ salt) | U(1)


#: Places of a word with a coefficient of their own; further ones take a product of two.
PLACES = 1 << 16
_FAMILIES = [_family(0), _family(1)]


def _hash_words(data: np.ndarray, lower: bool, family: int) -> np.ndarray:
    """Each word as the sum of its bytes' values times their places' coefficients."""
    s, e = word_spans(data)
    if not len(s):
        return np.empty(0, U)
    values, places = _FAMILIES[family]
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    n = e - s
    first = np.cumsum(n) - n
    letters = data[~is_space(data)]
    at = np.arange(len(letters)) - np.repeat(first, n)
    v = values[letters]
    if n.max() <= PLACES:
        v *= places[at]
    else:
        v *= places[at & (PLACES - 1)]
        v *= mix((at // PLACES).astype(U) * _SEED) | U(1)
    return mix(np.add.reduceat(v, first) + n.astype(U) * _SEED)


def word_hashes(data: np.ndarray, lower: bool, block: int = 1 << 20, family: int = 0) -> np.ndarray:
    """A 64-bit fingerprint of each word, working in blocks that end at a
    separator so that temporary arrays stay small for very long texts. The two
    families differ in every value and coefficient. Not powers of one base:
    those collide on words like the Thue-Morse sequence and its complement."""
    out, at, n = [], 0, len(data)
    while at < n:
        end = min(n, at + block)
        if end < n:
            cut = np.flatnonzero(is_space(data[at:end]))
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # one giant word: go on to where it ends
                step = end
                while step < n and not (cut := np.flatnonzero(is_space(data[step : step + block]))).size:
                    step += block
                end = min(n, step + int(cut[0]) + 1) if step < n else n
        out.append(_hash_words(data[at:end], lower, family))
        at = end
    return np.concatenate(out) if out else np.empty(0, U)


def _coefficients(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=U) * U(0xA0761D6478BD642F)) | U(1)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of all runs of k consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U)
    h = np.full(n, k, U)
    for j, c in enumerate(_coefficients(k)):
        h += words[j : j + n] * c
    return mix(h)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w values, by doubling."""
    done, cur = 1, h
    while done < w:
        step = min(done, w - done)
        cur = np.minimum(cur[: len(cur) - step], cur[step:])
        done += step
    return cur


def binary_rows(col: pa.Array) -> Iterator[np.ndarray]:
    """Each value of an Arrow string / binary column as a byte array (NULL: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    buf = col.buffers()
    off = np.frombuffer(buf[1], np.int64 if big else np.int32)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(buf[2], np.uint8) if len(col) and buf[2] is not None else np.empty(0, np.uint8)
    ok = np.ones(len(col), bool) if col.null_count == 0 else ~np.asarray(col.is_null())
    for i in range(len(col)):
        yield data[off[i] : off[i + 1]] if ok[i] else data[:0]
