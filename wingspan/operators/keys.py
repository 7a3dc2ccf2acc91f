"""Surrogate keys (W3) and batch numbers.

A sequence hands out ids in insertion order, and the source inserts in a
sorted order. Dense ids in a total order are computed without moving all rows
to one task:

1. range-partition on the order (sampled boundaries; a total order splits even
   a hot key across partitions) and sort within each partition;
2. tag each row with ``monotonically_increasing_id`` (partition index in the
   high bits, position in the low 33 bits) and write the result once to the
   shared checkpoint folder, which fixes the placement and cuts the lineage
   (a lost executor re-reads files instead of re-sampling the boundaries);
3. count rows per partition (one row per partition reaches the driver) and
   turn the counts into offsets;
4. id = start + offset(partition) + position + 1; the offsets are a literal
   map in the expression for up to 512 partitions, beyond that a broadcast
   table whose size is the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wingspan.operators.relational import asc_last
from wingspan.session import scratch_path

ColumnOrName = Column | str
_LOW_BITS = (1 << 33) - 1
_INLINE_OFFSETS = 512  # above this many partitions the offsets are broadcast instead of inlined


def _orderable(dt: T.DataType) -> bool:
    """Maps and variants cannot be sorted; every other column can break ties."""
    return not isinstance(dt, (T.MapType, T.VariantType))


def total_order(df: DataFrame, order: Sequence[ColumnOrName]) -> list[Column]:
    """``order`` made total by appending every other orderable column.

    Rows equal on all columns are interchangeable, so the ids they receive do
    not change the content of the result.
    """
    named = {c for c in order if isinstance(c, str)}
    rest = [f.name for f in df.schema.fields if f.name not in named and _orderable(f.dataType)]
    return asc_last(list(order) + rest)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """K4: write an intermediate to the shared checkpoint folder and read it back.

    Columnar, lineage-free, and safe when executors are lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def assign_ids(df: DataFrame, order: Sequence[ColumnOrName], id_col: str, start: int | Column = 0,
               make_total: bool = True, num_partitions: int | None = None) -> DataFrame:
    """``id_col`` = start + 1, start + 2, ... in ``order`` (NULLs last).

    ``start`` is the sequence's high-water mark (0 for a new sequence). With
    ``make_total`` the order is completed with every other column.

    AQE merges small range partitions but never splits one, so the initial
    count must keep each range task-sized: ``num_partitions``, else the
    session's ``spark.wingspan.rangePartitions``, else the shuffle default
    (``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` /
    ``spark.sql.shuffle.partitions``). Aim at input bytes / 256 MB.
    """
    spark = df.sparkSession
    sort = total_order(df, order) if make_total else asc_last(order)
    n = num_partitions or int(spark.conf.get("spark.wingspan.rangePartitions", "0") or 0)
    ranged = (
        (df.repartitionByRange(n, *sort) if n else df.repartitionByRange(*sort))
        .sortWithinPartitions(*sort)
        .withColumn("__pos", F.monotonically_increasing_id())
    )
    staged = materialize(ranged, "ids")
    pid = F.shiftright(F.col("__pos"), 33)
    counts = staged.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, acc = [], 0
    for row in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((row["__pid"], acc))
        acc += row["n"]
    base = start if isinstance(start, Column) else F.lit(start).cast("long")
    if len(offsets) <= _INLINE_OFFSETS:
        # few partitions: a literal map in the expression, no broadcast job
        lookup = F.create_map(*[F.lit(x).cast("long") for po in offsets for x in po]) if offsets \
            else F.create_map().cast("map<bigint,bigint>")
        out = staged.withColumn("__off", F.element_at(lookup, pid))
    else:
        # many partitions: one broadcast of (partition, offset), bounded by the partition count
        off_df = spark.createDataFrame(offsets, "__pid long, __off long")
        out = staged.withColumn("__pid", pid).join(F.broadcast(off_df), "__pid")
    ident = base + F.col("__off") + F.col("__pos").bitwiseAND(F.lit(_LOW_BITS)) + F.lit(1)
    cols = [ident.cast("long").alias(id_col)] + [F.col(c) for c in df.columns if c != id_col]
    return out.select(*cols)


def batch_number(df: DataFrame, id_col: str, n: int, start: int = 0, name: str = "batch") -> DataFrame:
    """Batch of ``n`` rows by position: ``floor((id - start - 1) / n)``."""
    return df.withColumn(name, F.floor((F.col(id_col) - F.lit(start) - 1) / F.lit(n)).cast("long"))
