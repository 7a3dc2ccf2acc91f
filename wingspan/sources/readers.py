"""Sources (S1-S5): raw CSV tables, the species checklist, the scheme
parameter row, staging tables and scheme-filtered published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wingspan.functions.scalars import parse_bool
from wingspan.operators.relational import with_ordinal
from wingspan.plans.model import CHECKLIST_COLUMNS, MODEL
from wingspan.sources.rejects import REJECTS, readable_as, with_rejects


def read_raw(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             ordinal: str | None = None) -> DataFrame:
    """A raw CSV table with a header.

    Pass ``schema`` in production (inference reads the data twice and guesses);
    malformed rows then land in ``_corrupt_record`` instead of failing the job.
    ``ordinal`` captures file order for first-wins rules.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is not None:
        if isinstance(schema, str):
            schema = f"{schema}, _corrupt_record string"  # DDL text, read by the reader itself
        else:
            schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
        reader = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord",
                                                                           "_corrupt_record")
    else:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return with_ordinal(df, ordinal) if ordinal else df


def read_checklist(spark: SparkSession, path: str, ordinal: str | None = "_ordinal", rejects: bool = False) -> DataFrame:
    """The checklist CSV into its fixed 31-column schema, by position.

    Header skipped, comma separated, ``"`` quoted, FAILFAST on a malformed
    row. Booleans are read as text and parsed by the boolean rule (a ``1``
    in a boolean column is legal in the source system); empty text is NULL.
    A number or boolean that cannot be read is NULL; ``rejects`` lists it in the
    row's ``REJECTS`` column, by which ``load_reference`` reports or refuses it.
    """
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n, _ in CHECKLIST_COLUMNS])
    raw = (spark.read.schema(text_schema).option("header", True).option("enforceSchema", True)
           .option("quote", '"').option("escape", '"').option("mode", "FAILFAST").csv(path))
    if ordinal:
        raw = with_ordinal(raw, ordinal)
    if rejects:
        given = raw.select(*[F.nullif(F.col(n), F.lit("")).alias(n) for n, _ in CHECKLIST_COLUMNS], *([ordinal] if ordinal else []))
        raw = with_rejects(given, {n: parse_bool if t == "boolean" else readable_as("int") for n, t in CHECKLIST_COLUMNS if t in ("boolean", "int")})
    cols = []
    for name, dtype in CHECKLIST_COLUMNS:
        c = F.nullif(F.col(name), F.lit(""))
        if dtype == "boolean":
            cols.append(parse_bool(c).alias(name))
        elif dtype == "int":
            cols.append(c.try_cast("int").alias(name))
        else:
            cols.append(c.alias(name))
    if ordinal:
        cols.append(F.col(ordinal))
    return raw.select(*cols, *([REJECTS] if rejects else []))


@dataclass(frozen=True)
class Scheme:
    """The data parameters of one scheme load."""

    bms_id: str
    country_iso3: str
    country_name: str
    contact_name: str
    contact_email: str


def scheme_detail(spark: SparkSession, schemes: list[Scheme] | Scheme) -> DataFrame:
    """S3: the scheme parameter rows as a DataFrame of ``bms_detail``'s schema.

    Built from typed values, so an apostrophe in a name needs no quoting.
    """
    rows = [schemes] if isinstance(schemes, Scheme) else list(schemes)
    data = [(s.bms_id, s.country_iso3, s.country_name, s.contact_name, s.contact_email) for s in rows]
    return spark.createDataFrame(data, MODEL["bms_detail"].schema)


def staged(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A staging table written by ``stage``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def for_scheme(df: DataFrame, scheme_id: str) -> DataFrame:
    """A published table restricted to one scheme; on a table
    partitioned by ``bms_id`` this prunes to one directory."""
    return df.where(F.col("bms_id") == F.lit(scheme_id))
