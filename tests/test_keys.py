"""Dense surrogate keys (W3) and batch numbers."""

import random

from pyspark.sql import functions as F

from conftest import rows
from wingspan.operators.keys import assign_ids, batch_number, materialize


def test_assign_ids_dense_in_order_with_start(spark):
    data = [(random.Random(7).randint(0, 50) if i % 5 else None, i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, v int").repartition(7)
    out = assign_ids(df, ["k", "v"], "id", start=1000)
    got = sorted(rows(out, "id", "k", "v"))
    exp = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [g[0] for g in got] == list(range(1001, 1301))
    assert [(g[1], g[2]) for g in got] == exp


def test_assign_ids_independent_of_partitioning(spark):
    data = [(i % 13, f"s{i % 7}", i) for i in range(500)]
    a = assign_ids(spark.createDataFrame(data, "a int, b string, c int").repartition(1), ["a", "b"], "id")
    b = assign_ids(spark.createDataFrame(data, "a int, b string, c int").repartition(11), ["a", "b"], "id")
    assert sorted(rows(a)) == sorted(rows(b))


def test_assign_ids_hot_key_spreads(spark):
    # one key holds most rows: a total order still splits it over partitions
    data = [(0, i) for i in range(3000)] + [(i, i) for i in range(1, 100)]
    df = spark.createDataFrame(data, "k int, v int")
    out = assign_ids(df, ["k"], "id")
    assert out.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 3099, 3099)


def test_assign_ids_empty(spark):
    df = spark.createDataFrame([], "k int")
    assert assign_ids(df, ["k"], "id").count() == 0


def test_batch_number(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 251)], "id long")
    out = batch_number(df, "id", 100).groupBy("batch").count()
    assert sorted(rows(out)) == [(0, 100), (1, 100), (2, 50)]


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    m = materialize(df)
    assert "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(m)) == sorted(rows(df))


def test_assign_ids_broadcast_offsets_path(spark, monkeypatch):
    import wingspan.operators.keys as K
    monkeypatch.setattr(K, "_INLINE_OFFSETS", 0)
    df = spark.createDataFrame([(i % 17, i) for i in range(400)], "k int, v int").repartition(6)
    out = sorted(rows(K.assign_ids(df, ["k", "v"], "id", start=10)))
    assert [r[0] for r in out] == list(range(11, 411))
    assert [r[1:] for r in out] == sorted((i % 17, i) for i in range(400))


def test_assign_ids_explicit_partitions(spark):
    df = spark.createDataFrame([(i % 9, i) for i in range(300)], "k int, v int")
    out = assign_ids(df, ["k", "v"], "id", num_partitions=7)
    assert sorted(r[0] for r in rows(out, "id")) == list(range(1, 301))
