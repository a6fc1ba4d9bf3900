"""Incremental refresh of the consolidated snapshot.

The snapshot is stored by member bucket (a hash of the member id, ``buckets`` of
them, as partition folders). Beside it lie fingerprints of its inputs: for each
bucket and input the number of rows and two order-free sums of row hashes. A
refresh computes the fingerprints of the present inputs, one map-side combined
aggregation, and compares them with the kept ones; the view is then rebuilt from
the rows of the changed buckets alone and written with dynamic partition
overwrite, so the files of the other buckets are not touched. Buckets that have
lost all their customers are removed.

The fingerprints are written after the rows. A refresh that dies before that
leaves old fingerprints (or none), and the next one rebuilds the same buckets
again; rows are never left behind their fingerprints.

Scale: an unchanged bucket costs the scan of its input rows and nothing else: no
shuffle, join or write. Rows of one bucket are spread over as many tasks as their
size asks for (a rebalance that adaptive execution may split), so a member with
very many rows is no single task's work. Only bucket numbers reach the driver.

Cases: a repeated input row changes count and sums; a NULL member id has a bucket
like any other; a first refresh, or one with another bucket count, writes
everything; empty inputs give an empty snapshot.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType

from lendscope.operators.consolidate import REPAYMENT_COLS, VIEW_COLUMNS, consolidated_view
from lendscope.sources import catalog
from lendscope.sources.ingest import load_schema, save_schema

BUCKETS = 128
_BUCKET = "member_bucket"


@dataclass(frozen=True)
class ViewInputs:
    """The five cleaned tables of the consolidated view."""
    customers: DataFrame
    loans: DataFrame
    repayments: DataFrame
    delinq: DataFrame
    details: DataFrame
    partitioned: bool = False  # the tables with a member id are read from buckets of it

    def view(self) -> DataFrame:
        return consolidated_view(self.customers, self.loans, self.repayments, self.delinq, self.details,
                                 self.partitioned)


def bucket_of(member_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(member_id), F.lit(buckets)).cast("int")


def fingerprints(inputs: ViewInputs, buckets: int) -> DataFrame:
    """(member_bucket, input, n, h1, h2): rows and sums of row hashes. Loans carry
    their repayments, so that a changed repayment counts for its loan's member."""
    def hashes(df: DataFrame, names: tuple[str, str] = ("h1", "h2")) -> list[Column]:
        cols = [c for c in df.columns if c != "ingest_date"]  # a later load of equal rows is no change
        return [F.xxhash64(*cols).alias(names[0]), F.xxhash64(F.lit(1), *cols).alias(names[1])]

    def hashed(name: str, df: DataFrame) -> DataFrame:
        return df.select(bucket_of(F.col("member_id"), buckets).alias(_BUCKET), F.lit(name).alias("input"), *hashes(df))

    # loans meet their repayments as hashes, not as rows
    paid = inputs.repayments.select("loan_id", *REPAYMENT_COLS)
    paid = paid.select("loan_id", *hashes(paid, ("p1", "p2")))
    lent = inputs.loans.select("loan_id", bucket_of(F.col("member_id"), buckets).alias(_BUCKET),
                               *hashes(inputs.loans)).join(paid, "loan_id", "left")
    lent = lent.select(_BUCKET, F.lit("loans").alias("input"), F.xxhash64("h1", "p1").alias("h1"),
                       F.xxhash64("h2", "p2").alias("h2"))
    tables = {"customers": inputs.customers, "delinq": inputs.delinq, "details": inputs.details}
    rows = reduce(lambda a, b: a.unionByName(b), [hashed(n, df) for n, df in tables.items()], lent)
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)").alias(c)
    return rows.groupBy(_BUCKET, "input").agg(F.count(F.lit(1)).alias("n"), total("h1"), total("h2"))


def changed_buckets(new: DataFrame, old: DataFrame) -> DataFrame:
    """Buckets in which some input differs, is new or is gone."""
    tagged = new.withColumn("side", F.lit(1)).unionByName(old.withColumn("side", F.lit(-1)))
    same = tagged.groupBy(_BUCKET, "input", "n", "h1", "h2").agg(F.sum("side").alias("side"))
    return same.where("side <> 0").select(_BUCKET).distinct()


def _restricted(inputs: ViewInputs, buckets: int, wanted: list[int]) -> ViewInputs:
    """The rows of the wanted buckets."""
    def of(df: DataFrame) -> DataFrame:
        return df.where(bucket_of(F.col("member_id"), buckets).isin(wanted))
    # the view looks repayments up by loan: those of other loans meet nothing
    return ViewInputs(of(inputs.customers), of(inputs.loans), inputs.repayments, of(inputs.delinq), of(inputs.details),
                      inputs.partitioned)


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


class Snapshot:
    """The consolidated view's rows below ``path``, by member bucket."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows-{self.buckets}"

    @property
    def _state(self) -> str:
        return f"{self.path}/fingerprints-{self.buckets}"

    def _files(self) -> DataFrame:
        schema = load_schema(self.spark, f"{self.path}/schema")
        return self.spark.read.schema(schema.add(_BUCKET, IntegerType())).parquet(self._rows)

    def read(self) -> DataFrame:
        return self._files().select(*VIEW_COLUMNS)

    def declare(self, db: str, table: str) -> str:
        """(Re)declare the snapshot as a partitioned table over its files."""
        name = f"{db}.{table}"
        ddl = ", ".join(f"`{c}` {t}" for c, t in self._files().dtypes)
        self.spark.sql(f"DROP TABLE IF EXISTS {catalog.quoted(name)}")
        self.spark.sql(f"CREATE TABLE {catalog.quoted(name)} ({ddl}) USING parquet PARTITIONED BY ({_BUCKET}) "
                       f"LOCATION {catalog.literal(self._rows)}")
        self.spark.sql(f"ALTER TABLE {catalog.quoted(name)} RECOVER PARTITIONS")
        return name

    def _write(self, view: DataFrame) -> None:
        rows = view.withColumn(_BUCKET, bucket_of(F.col("member_id"), self.buckets)).hint("rebalance", _BUCKET)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET)
         .parquet(self._rows))

    def refresh(self, inputs: ViewInputs) -> list[int]:
        """Bring the snapshot up to the inputs; the numbers of the buckets rewritten."""
        spark = self.spark
        now = f"{self.path}/fingerprints-next"
        fingerprints(inputs, self.buckets).write.mode("overwrite").parquet(now)
        new = spark.read.parquet(now)
        first = not _exists(spark, f"{self._state}/_SUCCESS")
        if first:
            save_schema(spark, inputs.view().schema, f"{self.path}/schema")
            self._write(inputs.view())
            changed = list(range(self.buckets))
        else:
            old = spark.read.schema(new.schema).parquet(self._state)
            changed = sorted(r[0] for r in changed_buckets(new, old).collect())  # at most ``buckets`` numbers
            if changed:
                self._write(_restricted(inputs, self.buckets, changed).view())
                alive = {r[0] for r in new.where("input = 'customers'").select(_BUCKET).collect()}
                for b in set(changed) - alive:
                    fs, hpath = _fs(spark, f"{self._rows}/{_BUCKET}={b}")
                    fs.delete(hpath, True)
        if changed:
            new.write.mode("overwrite").parquet(self._state)
        return changed
