import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(i, t, *rest, *[None] * (2 - len(rest)), None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def save(tmp_path):
    """Write tables as a data directory."""
    def put(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return put


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "Wörter und ÉTÉ 漢字"), (5, "a"), (6, "a"), (6, "a"),
           (None, "no id here"), (8, "long " * 300_000), (9, "x" * 1_500_000), (10, "!!! 12345 ???")]


@pytest.fixture
def awkward(docs_of):
    """Nulls, empty, very long, tied and repeated rows, with extra columns of clashing names."""
    from pyspark.sql import functions as F
    return (docs_of(AWKWARD).withColumn("score", F.lit("clash")).withColumn("kept", F.lit(0))
            .withColumn("keep_id", F.lit(None).cast("string")).withColumn("part", F.lit("x"))
            .withColumn("class_id", F.lit("y")).withColumn("tokens", F.lit(1)).withColumn("topic", F.lit("z"))
            .withColumn("spans", F.lit("s")).withColumn("toxic", F.lit(5)).withColumn("component", F.lit(3)))
