"""Reading a wide CSV whose lines may be broken.

The flow's first step infers the types of a large hand-kept CSV. Done plainly
that costs a pass on every read, one stray cell turns a number column into text,
and a line with too few or too many fields is padded or cut without a word.
Here:

1. ``infer_schema`` finds each column's type in one aggregation over the text
   cells, and a share of cells up to ``tolerance`` may disagree (they are the
   broken ones); the result is kept as JSON beside the data.
2. ``ingest_csv`` reads with that schema and keeps what doesn't fit: each line is
   parsed once, and lines with a wrong number of fields or a cell of the wrong
   type go, untouched, to a folder of their own in the same write.
3. ``rejections`` says for each rejected line what is wrong with it.

Scale: two scans of the CSV in all (inference, parse), no shuffle but one row a
task for the inference; later reads of either folder are pruned Parquet scans.
The pass of the inference is spared by passing a kept schema.

Cases: an empty cell is NULL and fits any type, outer blanks don't count; a column without values is text;
a number column keeps its type if at most ``tolerance`` of its values are no
numbers; a line with fewer or more fields than the header is rejected whatever its
cells hold; an empty file gives the header's columns as text and no rows. Quoted
fields may hold separators but no line breaks (the writer replaces them).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lendscope.functions.text import text_to_double

CORRUPT = "_corrupt_record"
#: Share of a column's values that may not fit its type.
TOLERANCE = 0.01
_INTEGER = r"^[+-]?\d{1,18}$"
_INT_MAX = (1 << 31) - 1
_TRIM = {"ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}


@dataclass(frozen=True)
class Ingested:
    """Where the rows of one read went."""
    schema: StructType
    rows: DataFrame
    rejected: DataFrame  # one column, ``line``


def _fits(c: Column) -> dict[str, Column]:
    """Whether a text cell is a whole number (small or large) or a number."""
    whole = c.rlike(_INTEGER)
    small = whole & F.coalesce(F.abs(c.try_cast("bigint")) <= _INT_MAX, F.lit(False))
    return {"int": small, "bigint": whole, "double": whole | text_to_double(c).isNotNull()}


def infer_schema(cells: DataFrame, tolerance: float = TOLERANCE) -> StructType:
    """The narrowest of int, bigint, double and string that fits all but
    ``tolerance`` of a column's values, for each column of text ``cells``."""
    counts = []
    for i, name in enumerate(cells.columns):
        c = F.btrim(F.col(f"`{name}`"))
        counts.append(F.count(c).alias(f"n_{i}"))
        counts += [F.count_if(ok).alias(f"{t}_{i}") for t, ok in _fits(c).items()]
    found = cells.agg(*counts).first()
    fields = []
    for i, name in enumerate(cells.columns):
        n = found[f"n_{i}"]
        least = n - int(n * tolerance)
        kind = next((t for t in ("int", "bigint", "double") if n and found[f"{t}_{i}"] >= least), "string")
        fields.append(f"`{name}` {kind}")
    return StructType.fromDDL(", ".join(fields))


def save_schema(spark: SparkSession, schema: StructType, path: str) -> str:
    """Keep ``schema`` as one line of JSON under ``path``."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(path).first().value))


def read_text_cells(spark: SparkSession, path: str) -> DataFrame:
    """Every cell as text without outer blanks, by the header's names."""
    return spark.read.options(header=True, mode="PERMISSIVE", **_TRIM).csv(path)


def ingest_csv(spark: SparkSession, path: str, out: str, schema: StructType | None = None,
               schema_path: str | None = None, tolerance: float = TOLERANCE) -> Ingested:
    """Read the CSV at ``path``; good rows and rejected lines go to ``out``.

    ``schema`` (or the one kept at ``schema_path``) spares the inference; else
    the inferred one is kept at ``schema_path``, where given."""
    if schema is None:
        schema = infer_schema(read_text_cells(spark, path), tolerance)
        if schema_path:
            save_schema(spark, schema, schema_path)
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    # a parser that skips unread columns would not see their broken cells
    parsed = (spark.read.options(header=True, mode="PERMISSIVE", columnPruning=False, columnNameOfCorruptRecord=CORRUPT,
                                 **_TRIM).schema(whole).csv(path))
    parsed.withColumn("rejected", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(out)
    kept = spark.read.schema(StructType([*whole.fields, StructField("rejected", StringType())])).parquet(out)
    return Ingested(schema, kept.where("rejected = 'false'").select(*[f"`{f.name}`" for f in schema.fields]),
                    kept.where("rejected = 'true'").select(F.col(CORRUPT).alias("line")))


def rejections(rejected: DataFrame, schema: StructType) -> DataFrame:
    """What is wrong with each rejected line: line, n_fields, reason ('fields' or
    'value') and the columns whose cells don't fit. A line is split as the reader
    does, into one field more than it should have at most."""
    names = [f.name for f in schema.fields]
    text = StructType([StructField(f"c{i}", StringType()) for i in range(len(names) + 1)])
    # fields: separators outside quotes
    outside = F.regexp_replace("line", r'"([^"\\]|\\.)*"', "")
    n_fields = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    cells = F.from_csv(F.col("line"), text.simpleString()[7:-1].replace(":", " "))
    bad = []
    for i, f in enumerate(schema.fields):
        c = F.nullif(F.btrim(F.col("cells")[f"c{i}"]), F.lit(""))
        if f.dataType != StringType():
            bad.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.lit(f.name)))
    wrong = F.col("n_fields") != len(names)
    return (rejected.select("line", n_fields.alias("n_fields"), cells.alias("cells"))
            .select("line", "n_fields", F.when(wrong, "fields").otherwise("value").alias("reason"),
                    F.when(wrong, F.lit("")).otherwise(F.concat_ws(",", *bad)).alias("columns")))


def write_lines(lines: DataFrame, header: str, path: str) -> str:
    """Write text ``lines`` (one column) as they are, below ``header`` in each file."""
    (lines.toDF(header).write.mode("overwrite").option("header", True).option("quote", "").option("sep", "\x01")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
