"""CSV and Parquet scans and sinks.

* ``read_csv_inferred`` costs an extra pass over the data to infer types;
  use it only for small inputs (the duplicate-id report) or exploration.
* ``read_csv_schema`` binds a fixed DDL by position (the header row is
  skipped, not matched), so differently named source columns take the DDL's
  names; malformed cells read as NULL (permissive mode).
* CSV writes keep Spark's defaults, which trim leading and trailing white
  space of string values (' 36 months' is stored as '36 months').
* Writes are full overwrites of a path. ``single_file`` adds a shuffle to one
  partition (keeping the upstream plan parallel) and is meant only for small
  human-facing reports; entity tables stay partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_wide_loans(spark: SparkSession, path: str, schema=None, repartition: int | None = None) -> DataFrame:
    """The wide loan CSV (one loan per row, source column names) with a header.

    Without ``schema`` the types are inferred, as the flow's first step does;
    inference is a full extra pass over the input, so at scale pass the schema
    (DDL string or StructType, columns in file order) to read it once.
    ``repartition`` (default: none) deals the rows over that many partitions.
    """
    if schema is None:
        df = read_csv_inferred(spark, path)
    else:
        df = spark.read.option("header", True).schema(schema).csv(path)
    return df.repartition(repartition) if repartition else df


def read_csv_schema(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return (spark.read.option("header", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").schema(ddl).csv(path))


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header names, every column a string."""
    return spark.read.option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, line_breaks: str | None = None) -> str:
    """CSV with a header. A line break inside a value would end its row for the
    line-wise readers above; with ``line_breaks`` (e.g. a space) each is replaced."""
    out = df.repartition(1) if single_file else df
    if line_breaks is not None:
        out = out.select(*[F.regexp_replace(c, r"\r\n|\r|\n", line_breaks).alias(c) if t == "string" else F.col(c)
                           for c, t in out.dtypes])
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, compression: str | None = None) -> str:
    df.write.mode("overwrite").parquet(path, compression=compression)
    return path


def write_parquet_counted(df: DataFrame, path: str, metrics: dict[str, Column]) -> dict:
    """Write ``df`` and take the aggregate ``metrics`` of its rows in the same pass
    (an observation on the write): no job of their own, no second read."""
    seen = Observation()
    df.observe(seen, *[c.alias(name) for name, c in metrics.items()]).write.mode("overwrite").parquet(path)
    return seen.get


def write_lookup_table(df: DataFrame, path: str, key: str) -> str:
    """Parquet files for lookups by ``key``: range-sorted, so that a file's least and
    greatest key exclude most files, with a Bloom filter per row group, which
    excludes the rest for an equality."""
    (df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
