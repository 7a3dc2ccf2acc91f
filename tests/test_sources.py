"""CSV sources, checklist bulk load, scheme parameters, model declarations."""

from pyspark.sql import functions as F

from conftest import rows
from wingspan.plans.model import CHECKLIST_COLUMNS, MODEL, foreign_key_edges, topological_order
from wingspan.sources import readers as S


def test_read_raw_with_schema_keeps_bad_rows(spark, tmp_path):
    p = tmp_path / "visit.csv"
    p.write_text("bms_visit_id,visit_date\n1,2023-1-5\nx,2023-1-6\n")
    df = S.read_raw(spark, str(p), "bms_visit_id int, visit_date string")
    got = sorted(rows(df, "bms_visit_id", "_corrupt_record"), key=str)
    assert got == sorted([(1, None), (None, "x,2023-1-6")], key=str)


def test_read_raw_inferred(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("a,b\n1,x\n2,y\n")
    df = S.read_raw(spark, str(p), ordinal="_ordinal")
    assert dict(df.dtypes)["a"] == "int" and "_ordinal" in df.columns


def test_read_checklist_by_position(spark, tmp_path):
    header = ",".join(f"h{i}" for i in range(len(CHECKLIST_COLUMNS)))  # names ignored: position counts
    vals = ["G", "e", "Pieris rapae", "Pieris rapae", "10", "Pieridae", "", "", "", "", "", "", "1758", "",
            "1", "0", '""', "t", "123", "", "", "", "", "", "", "", "", "97", "false", "", ""]
    p = tmp_path / "check.csv"
    p.write_text(header + "\n" + ",".join(vals) + "\n")
    df = S.read_checklist(spark, str(p))
    r = df.first()
    assert r["Search_Name"] == "Pieris rapae" and r["Systematic_Order"] == 10 and r["Year"] == 1758
    assert r["Aggregate"] is True and r["Synonym_Search_Name"] is False and r["Species_Search_Name"] is True
    assert r["Synonym_Source"] is None and r["Subfamily"] is None and r["GBIFsynonym"] is False


def test_scheme_detail_apostrophe(spark):
    d = S.scheme_detail(spark, S.Scheme("X", "XXX", "Côte d'Ivoire", "O'Brien", "o@x"))
    assert rows(d, "country_name", "contact_name") == [("Côte d'Ivoire", "O'Brien")]
    assert d.schema == MODEL["bms_detail"].schema


def test_staged_and_for_scheme(spark, tmp_path):
    spark.createDataFrame([("A", 1), ("B", 2)], "bms_id string, v int").write.partitionBy("bms_id").parquet(
        str(tmp_path / "t"))
    df = S.for_scheme(S.staged(spark, str(tmp_path), "t"), "A")
    assert rows(df, "v") == [(1,)]
    assert "PartitionFilters: [isnotnull(bms_id" in df._jdf.queryExecution().executedPlan().toString()


def test_model_graph():
    order = topological_order()
    for child, fk in foreign_key_edges():
        assert order.index(fk.parent) < order.index(child)
    assert MODEL["b_count"].serial == "count_id"
    assert len(CHECKLIST_COLUMNS) == 31
    assert MODEL["m_visit"].schema["visit_id"].metadata["comment"]
