"""Wide CSV with broken lines: inferred types, routed lines, reasons."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendscope.sources import ingest

HEADER = "id,name,amount,note"
GOOD = ['1,ann,2.5,"a, b"', "2,,3.5,", " 3 , bob ,1e3,x", "4,\"q\\\"r\",7,", "5,cy,,y"]
CUT, EXTRA, WORD, BOTH = "6,dan", "7,eve,1.0,z,9", "8,fay,lots,z", "nine,gus,few,z"


@pytest.fixture
def csv(spark, tmp_path):
    def make(lines, parts=3):
        df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(parts)
        return ingest.write_lines(df, HEADER, f"{tmp_path}/csv")
    return make


def test_good_rows_and_rejected_lines_are_told_apart(spark, csv, tmp_path):
    path = csv(GOOD + [CUT, EXTRA, WORD, BOTH])
    got = ingest.ingest_csv(spark, path, f"{tmp_path}/out", schema_path=f"{tmp_path}/schema", tolerance=0.3)
    assert got.schema == StructType.fromDDL("id int, name string, amount double, note string")
    rows = sorted(tuple(r) for r in got.rows.collect())
    assert rows == [(1, "ann", 2.5, "a, b"), (2, None, 3.5, None), (3, "bob", 1000.0, "x"), (4, 'q"r', 7.0, None),
                    (5, "cy", None, "y")]
    assert sorted(r.line for r in got.rejected.collect()) == sorted([CUT, EXTRA, WORD, BOTH])
    why = {r.line: (r.n_fields, r.reason, r["columns"]) for r in ingest.rejections(got.rejected, got.schema).collect()}
    assert why == {CUT: (2, "fields", ""), EXTRA: (5, "fields", ""), WORD: (4, "value", "amount"),
                   BOTH: (4, "value", "id,amount")}
    # a pruned read doesn't bring the broken lines back
    assert got.rows.select("id").count() == 5 and got.rows.select("note").where("note = 'z'").count() == 0


def test_a_kept_schema_spares_the_inference(spark, csv, tmp_path):
    path = csv(GOOD)
    schema = ingest.infer_schema(ingest.read_text_cells(spark, path))
    ingest.save_schema(spark, schema, f"{tmp_path}/schema")
    assert ingest.load_schema(spark, f"{tmp_path}/schema") == schema
    spark.sparkContext.setJobGroup("kept", "ingest with a kept schema")
    try:
        ingest.ingest_csv(spark, path, f"{tmp_path}/out", schema)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("kept"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1  # the one write


@pytest.mark.parametrize("values,tolerance,kind", [
    (["1", "2", "-3"], 0, "int"), (["1", "4000000000"], 0, "bigint"), (["1", "2.5"], 0, "double"),
    (["1", "x"], 0, "string"), (["1"] * 99 + ["x"], 0.01, "int"), (["1"] * 98 + ["x", "y"], 0.01, "string"),
    ([None, ""], 0, "string"), (["1", None, " 2 "], 0, "int"), (["12345678901234567890"], 0, "double"),
    (["1.0"] * 3, 0, "double"), (["NaN", "1"], 0, "double")])
def test_inferred_types(spark, values, tolerance, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a b` string").select(F.nullif("`a b`", F.lit("")).alias("a b"))
    assert ingest.infer_schema(df, tolerance) == StructType.fromDDL(f"`a b` {kind}")


def test_no_rows(spark, csv, tmp_path):
    path = csv([], parts=1)
    got = ingest.ingest_csv(spark, path, f"{tmp_path}/out")
    assert got.rows.count() == 0 and got.rejected.count() == 0
    assert [f.name for f in got.schema.fields] in ([], HEADER.split(","))  # no file, no header
