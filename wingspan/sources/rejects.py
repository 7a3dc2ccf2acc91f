"""Values that a load cannot read, kept beside its rows.

The source system stops a load at the first value that it cannot cast. Here the
scan that reads a staging row also tries its casts and keeps what fails in one
array column of that row. One write keeps both; the list of rejects then reads
that column alone, and the load reads the others (column pruning), so that a raw
file is scanned once however many builders use it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wingspan.functions.scalars import assign_int, clock_to_minute, parse_bool, parse_date
from wingspan.plans.model import NUMERIC

#: The array column of unreadable values; NULL in rows without any.
REJECTS = "__rejects"
CORRUPT = "_corrupt_record"

Rule = Callable[[str], Column]


def readable_as(dtype: str | T.DataType) -> Rule:
    """The rule of a plain cast."""
    return lambda c: F.col(c).try_cast(dtype)


#: How each staging column is read by the load; a value is rejected if that gives NULL.
#: Visits are cleaned (C3) before, whose clock rule has NULL for text that is no time.
RULES: dict[str, dict[str, Rule]] = {
    "sites": {
        "bms_site_id": assign_int, "site_info_quality": assign_int, "transect_length": readable_as(NUMERIC),
        "section_length": readable_as(NUMERIC), "section_transect_length_equal": readable_as("boolean"),
        "longitude": readable_as("double"), "latitude": readable_as("double"),
    },
    "visits": {
        "bms_visit_id": assign_int, "visit_date": parse_date, "start_time": clock_to_minute, "end_time": clock_to_minute,
        "visit_cloud": assign_int, "visit_wind": assign_int, "completed": parse_bool,
    },
    "counts": {
        "bms_visit_id": readable_as("int"), "bms_site_id": readable_as("int"), "species_id": readable_as("int"), "count": assign_int,
    },
}


def with_rejects(df: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """``df`` with the column ``REJECTS``: (col, value) of every non-NULL value whose rule
    gives NULL, in the order of the rules, and of a malformed record its text (the reader's
    ``_corrupt_record``, which is dropped). NULL where all is well. Rules of absent columns
    are skipped; other columns stay as they are. A column ``REJECTS`` in the input is an error."""
    if REJECTS in df.columns:
        raise ValueError(f"column {REJECTS} is taken")
    tried = [F.when(F.col(c).isNotNull() & rule(c).isNull(), F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")))
             for c, rule in rules.items() if c in df.columns]
    if CORRUPT in df.columns:
        tried.append(F.when(F.col(CORRUPT).isNotNull(), F.struct(F.lit(CORRUPT).alias("col"), F.col(CORRUPT).alias("value"))))
    if not tried:
        return df.withColumn(REJECTS, F.lit(None).cast("array<struct<col:string,value:string>>"))
    bad = F.array_compact(F.array(*tried))
    return df.withColumn(REJECTS, F.when(F.size(bad) > 0, bad)).drop(CORRUPT)


def split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write a frame of ``with_rejects`` once and give its rows and its rejects, both
    read from ``path``; the second reads ``REJECTS`` and the scheme only."""
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.drop(REJECTS), back.select(*[c for c in ("bms_id",) if c in df.columns], REJECTS)


def listed(rejects: DataFrame, table: str) -> DataFrame:
    """The rejects of one staging table as ``(tbl, bms_id, col, value, n)``; partial counts
    are made before the shuffle, so that one value in a third of all rows is cheap."""
    scheme = F.col("bms_id").cast("string") if "bms_id" in rejects.columns else F.lit(None).cast("string")
    each = rejects.where(F.col(REJECTS).isNotNull()).select(F.lit(table).alias("tbl"), scheme.alias("bms_id"), F.explode(REJECTS).alias("r"))
    return each.groupBy("tbl", "bms_id", F.col("r.col").alias("col"), F.col("r.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))
