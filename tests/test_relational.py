"""Operator tests on small frames: NULL keys, ties, duplicates, empty input."""

from pyspark.sql import functions as F

from conftest import rows
from wingspan.operators import relational as R


def test_distinct_on_first_by_order_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "7", "b"), (2, "9", "c"), (2, "3", "d"), (None, "1", "e"),
                                (None, "2", "f")], "k int, obs string, x string")
    out = R.distinct_on(df, ["k"], ["obs"], tiebreak=["x"])
    assert sorted(rows(out, "k", "x"), key=str) == sorted([(1, "b"), (2, "d"), (None, "e")], key=str)


def test_distinct_on_ties_broken_deterministically(spark):
    df = spark.createDataFrame([(1, "7", "z"), (1, "7", "a")], "k int, obs string, x string")
    assert rows(R.distinct_on(df, ["k"], ["obs"], tiebreak=["x"]), "x") == [("a",)]


def test_distinct_on_empty(spark):
    df = spark.createDataFrame([], "k int, obs string")
    assert R.distinct_on(df, ["k"], ["obs"]).count() == 0


def test_keep_first_by_file_order(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("Search_Name,Systematic_Order\nA,5\nB,1\nA,2\n")
    df = R.with_ordinal(spark.read.option("header", True).csv(str(p)))
    out = R.keep_first(df, "Search_Name", "_ordinal")
    assert sorted(rows(out, "Search_Name", "Systematic_Order")) == [("A", "5"), ("B", "1")]


def test_merge_left_null_matches_null(spark):
    x = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id int, nm string")
    k = spark.createDataFrame([("a", 10), (None, 20)], "Search_Name string, sid int")
    out = R.merge_left(x, k, [("nm", "Search_Name")])
    assert sorted(rows(out, "id", "sid")) == [(1, 10), (2, 20), (3, None)]
    assert "Search_Name" not in out.columns


def test_attach_scheme_missing_row_gives_empty(spark):
    s = spark.createDataFrame([("t1",), ("t2",)], "transect_id string")
    d = spark.createDataFrame([("X",)], "bms_id string")
    assert R.attach_scheme(s, d, "X").count() == 2
    assert R.attach_scheme(s, d, "Y").count() == 0


def test_delete_using_and_in_keep_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    gone = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(rows(R.delete_in(t, gone, ["k"]), "v")) == [("b",), ("c",)]
    assert sorted(rows(R.delete_using(t, gone, [("k", "k")]), "v")) == [("b",), ("c",)]


def test_update_from_unmatched_keep_and_smallest_wins(spark):
    t = spark.createDataFrame([(1, None), (2, None), (3, 99)], "bms_site_id int, site_id long")
    s = spark.createDataFrame([(1, 20), (1, 10), (3, 5)], "bms_site_id int, site_id long")
    out = R.update_from(t, s, ["bms_site_id"], {"site_id": "site_id"})
    assert sorted(rows(out, "bms_site_id", "site_id"), key=str) == sorted([(1, 10), (2, None), (3, 5)], key=str)


def test_add_drop_update_where(spark):
    df = spark.createDataFrame([(1, "section_centroid"), (2, "x")], "i int, g string")
    df = R.add_column_if_absent(df, "site_id", "int")
    assert R.add_column_if_absent(df, "site_id", "string").schema["site_id"].dataType.typeName() == "integer"
    df = R.update_where(df, "site_id", F.lit(7), F.col("g") == "x")
    assert sorted(rows(df, "i", "site_id"), key=str) == sorted([(1, None), (2, 7)], key=str)
    assert "g" not in R.drop_if_present(df, "g").columns
    assert R.drop_if_present(df, "absent").columns == df.columns


def test_page_nulls_last(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 3) for i in range(20)], "id int, k int")
    got = rows(R.page(df, ["k", "id"], 14, 10), "id", "k")
    full = sorted([(i, None if i % 4 == 0 else i % 3) for i in range(20)],
                  key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[0]))
    assert got == full[14:24]


def test_first_per_key_plans_partial_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = R.distinct_on(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_deep_page_uses_numbering(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(200)], "id int, k int")
    shallow = rows(R.page(df, ["k", "id"], 120, 30), "id")
    deep = rows(R.page(df, ["k", "id"], 120, 30, max_take=10), "id")
    assert shallow == deep and len(deep) == 30
