"""Cascading delete and key rename over the reference graph."""

from conftest import rows
from wingspan.operators import graph


def test_cascade_delete(spark):
    t = {
        "site": spark.createDataFrame([(1,), (2,)], "site_id int"),
        "visit": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "visit_id int, site_id int"),
        "count": spark.createDataFrame([(100, 10), (101, 11), (102, 12)], "count_id int, visit_id int"),
    }
    edges = [("visit", ["site_id"], "site", ["site_id"]), ("count", ["visit_id"], "visit", ["visit_id"])]
    gone = spark.createDataFrame([(1,)], "site_id int")
    out = graph.cascade_delete(t, edges, {"site": "site_id", "visit": "visit_id", "count": "count_id"},
                               {"site": gone})
    assert rows(out["site"]) == [(2,)]
    assert sorted(rows(out["visit"]), key=str) == sorted([(11, 2), (12, None)], key=str)
    assert sorted(rows(out["count"])) == [(101, 11), (102, 12)]


def test_rekey(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    m = spark.createDataFrame([("a", "A")], "old string, new string")
    assert sorted(rows(graph.rekey(child, "k", m)), key=str) == sorted([(1, "A"), (2, "b"), (3, None)], key=str)


def test_rekey_tables(spark):
    t = {"p": spark.createDataFrame([("a",), ("b",)], "k string"),
         "c": spark.createDataFrame([(1, "a")], "id int, pk string")}
    m = spark.createDataFrame([("a", "A")], "old string, new string")
    out = graph.rekey_tables(t, [("c", ["pk"], "p", ["k"])], "p", m)
    assert sorted(rows(out["p"])) == [("A",), ("b",)]
    assert rows(out["c"]) == [(1, "A")]
