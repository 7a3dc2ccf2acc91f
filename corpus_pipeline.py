"""The training-data pipeline over ``documents``: quality rules, n-gram Jaccard
join, benchmark decontamination, secret scans, best-fit packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
as Parquet to the shared folder and rereads it as the next one's documents. All
but the last return the columns of ``documents``. Rows with the same id are told
apart by their text; rows that are equal in both share every decision, except
that the join keeps one of them if they have words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wingspan.llm.common import aside, row_key, stage, table
from wingspan.llm.decontaminate import leaks
from wingspan.llm.jaccard_join import join_documents
from wingspan.llm.packing import pack_documents
from wingspan.llm.quality_rules import fit, judge
from wingspan.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the decision list rejects go."""
    rules = fit(docs, table(spark, sf_dir, "labels"))
    bare, back = aside(docs, "text")
    return back(judge(bare, rules).where(F.col("rule").isNull()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, one row with the smallest id stays (NULL counts
    as larger than all ids); documents without words stay as they are. Of rows that are
    equal in id and text, the one whose other columns come first as JSON stays."""
    groups = join_documents(spark, docs.select("doc_id", "text"), keys_too=True)
    keep = groups.groupBy("node", F.when(F.col("node").isNull(), F.col("rid"))).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("m"))
    keep = keep.select(F.col("m.rid").alias("key"), F.col("node").isNotNull().alias("one"))
    bare, back = aside(docs, "doc_id", "text")
    out = bare.withColumn("key", row_key()).join(keep, "key")
    # a row that stays as it is is a group of its own, so that one condition serves all and is met before the shuffle
    group = ["key", F.when(~F.col("one"), F.monotonically_increasing_id())]
    first = Window.partitionBy(*group).orderBy(F.to_json(bare.columns[-1]))
    return back(out.withColumn("nth", F.row_number().over(first)).where("nth = 1"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = leaks(spark, docs, table(spark, sf_dir, "benchmark")).select("rid").distinct()
    bare, back = aside(docs, "doc_id", "text")
    return back(bare.withColumn("rid", row_key()).join(found, "rid", "left_anti"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; no document goes. ``n_chars``, if there, is counted anew."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces packed into sequences."""
    return pack_documents(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secrets),
    ("best_fit_packing", packing),
]

#: The learned rules, the join and the tokenizer cannot be expressed in SQL; tests/llm
#: compares every stage and ``run`` with a plain-Python pipeline (given the learned rules).
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
