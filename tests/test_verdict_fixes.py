"""Store and scalar faults that once gave wrong tables."""

import decimal

import pytest
from pyspark.sql import functions as F

from wingspan.functions.scalars import assign_int
from wingspan.operators.relational import sort_nulls_last
from wingspan.plans.model import MODEL
from fixture_schemes import SCHEMES, frames
from test_run import SCHEMAS, _csv
from wingspan.plans.model import CHECKLIST, CHECKLIST_COLUMNS
from wingspan.plans.publish import PublishError, Store
from wingspan.plans.run import load_reference, load_schemes


def _global_table():
    return next(n for n, s in MODEL.items() if not s.scheme_scoped)


def test_global_table_is_replaced_not_added(spark, tmp_path):
    name = _global_table()
    store = Store(spark, str(tmp_path / "s"))
    frame = spark.createDataFrame([], MODEL[name].schema)
    one = frame.unionByName(spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in MODEL[name].schema.fields]))
    for _ in range(2):
        store.replace_schemes(["A"], {name: one}, check=False)
    assert store.table(name).count() == 1


def test_rows_of_other_schemes_refuse_the_load(spark, tmp_path):
    name = next(n for n, s in MODEL.items() if s.scheme_scoped and "bms_id" in s.schema.names)
    cells = [F.lit("B" if f.name == "bms_id" else None).cast(f.dataType).alias(f.name) for f in MODEL[name].schema.fields]
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(PublishError, match="other schemes"):
        store.replace_schemes(["A"], {name: spark.range(1).select(*cells)}, check=False)
    assert store.manifest(refresh=True) == []


def test_other_read_errors_are_raised(spark, tmp_path, monkeypatch):
    name = _global_table()
    store = Store(spark, str(tmp_path / "s"))

    def broken(*_):
        raise TimeoutError("storage")

    monkeypatch.setattr(store, "_read_loads", broken)
    with pytest.raises(TimeoutError):
        store.replace_schemes(["A"], {name: spark.createDataFrame([], MODEL[name].schema)}, check=False)


def test_assign_int_follows_the_type(spark):
    df = spark.createDataFrame([(decimal.Decimal("2.5"), 2.5, "2.5"), (decimal.Decimal("-2.5"), 3.5, "abc")], "d decimal(10,2), f double, t string")
    assert [tuple(r) for r in df.select(assign_int("d"), assign_int("f"), assign_int("t")).collect()] == [(3, 2, 3), (-3, 4, None)]


def test_sort_puts_nulls_last_for_columns_too(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "a int")
    assert [r[0] for r in sort_nulls_last(df, [F.col("a")]).collect()] == [1, 2, None]
    assert [r[0] for r in sort_nulls_last(df, [F.col("a").desc_nulls_first()]).collect()] == [None, 2, 1]


def _checklist(spark):
    c = frames(spark)["checklist"]
    return c.select(*[(F.col(n) if n in c.columns else F.lit(None)).cast(t).alias(n) for n, t in CHECKLIST_COLUMNS], "_ordinal")


def test_an_unpublished_parent_is_empty(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    cells = [F.lit({"butterfly_count": 1, "species_id": 424242, "count_id": 1}.get(f.name)).cast(f.dataType).alias(f.name)
             for f in MODEL["b_count"].schema.fields]
    with pytest.raises(PublishError, match="fk_species_id=1"):
        store.replace_schemes(["A"], {"b_count": spark.range(1).select(*cells, F.lit("A").alias("bms_id"))})


def test_reference_report_and_orphans(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    checklist = _checklist(spark)
    load_reference(store, checklist)
    assert store.table(CHECKLIST).count() == 4 and len(MODEL) == 11
    f = frames(spark)
    f["visits"] = f["visits"].withColumn("visit_date", F.when(F.col("bms_visit_id") == 9, "2023-13-45").otherwise(F.col("visit_date")))
    files = _csv(f, tmp_path)
    with open(f"{files[SCHEMES[0]].visits}/more.csv", "w") as out:
        out.write(",".join(n.split()[0] for n in SCHEMAS["visits"].split(", ")) + "\nBAD,5,1,2023-6-1,10:00,11:00,1.0,1.0,1\n")
    with pytest.raises(PublishError, match="rejected"):
        load_schemes(spark, store, files, checklist, SCHEMAS, strict=True)
    rep = load_schemes(spark, store, files, checklist, SCHEMAS)
    assert [tuple(r) for r in rep.unknown_species.collect()] == [("AA", "Unknown one", 1)]
    got = {(r["col"], r["value"]): r["n"] for r in rep.rejects.collect()}
    assert got[("visit_date", "2023-13-45")] == 1 and ("completed", "of") not in got  # a prefix of "off"
    assert any(c == "_corrupt_record" and v.startswith("BAD") for c, v in got)
    before = store.table("b_count").count()
    with pytest.raises(PublishError, match="orphan_species_id"):  # species 10 has counts
        load_reference(store, checklist.where("Systematic_Order <> 10"))
    load_reference(store, checklist.where("Systematic_Order <> 11"))
    assert store.table("b_count").count() == before and store.table("b_species_id").count() == 3
