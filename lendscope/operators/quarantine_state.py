"""Quarantine as kept state: loads are merged, ids enter and leave.

A member id is quarantined while some table has more than one row of it. Counts
add up, so each load leaves its own counts behind, a folder per load, and the
state is their sum; a load that takes rows back counts them negative. Merging a
load reads only the counts of the ids it touches and says which ids enter the
quarantine and which leave it; the tables themselves are not read again.

Tables whose cleaning drops repeated rows count distinct rows: their counts are
kept by row (two 64-bit hashes), and a row that comes again in a later load is
still one.

Scale: one map-side combined aggregation per load; the earlier counts of the
touched ids come by a semi join, which adaptive execution broadcasts when the
load's ids are few. ``compact`` rewrites the loads as one. A hot id is one row
per map task and load. Given a database, each load's counts are a table bucketed
by member id: every later step groups and joins by that id (or by it and more),
so it reads the buckets in place and shuffles nothing; an id's counts then lie
in one bucket. Without one they are plain files.

Recovery: a load is written whole or not at all under its own name, and merging
the same name again replaces it, so a retried load never counts twice.

Cases: a NULL id is counted like any other (the flow's keys are never NULL);
counts at or below zero count as no row; a load without rows changes nothing.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope.sources import catalog

_ROW = ["source", "member_id", "h1", "h2"]
_SCHEMA = "source string, member_id string, h1 bigint, h2 bigint, n bigint"


def row_counts(tables: dict[str, DataFrame], distinct: Collection[str] = (), sign: int = 1,
               key: str = "member_id") -> DataFrame:
    """(source, member_id, h1, h2, n) of one load; the hashes tell rows apart only
    for the ``distinct`` tables."""
    def tagged(name: str, df: DataFrame) -> DataFrame:
        h1 = F.xxhash64(*df.columns) if name in distinct else F.lit(0).cast("bigint")
        h2 = F.xxhash64(F.lit(1), *df.columns) if name in distinct else F.lit(0).cast("bigint")
        return df.select(F.lit(name).alias("source"), F.col(key).alias("member_id"), h1.alias("h1"), h2.alias("h2"))

    rows = reduce(lambda a, b: a.unionByName(b), [tagged(n, df) for n, df in tables.items()])
    return rows.groupBy(*_ROW).agg((F.count(F.lit(1)) * sign).alias("n"))


def _union(*frames: DataFrame) -> DataFrame:
    """Counts under each other. A union keeps its parts' partitioning by columns that
    are the parts' own, so the id takes a name of its own meanwhile."""
    own = [df.withColumnRenamed("member_id", "__by") for df in frames]
    return reduce(lambda a, b: a.unionByName(b), own).withColumnRenamed("__by", "member_id")


def _rows_of(n: str, distinct: Collection[str]):
    """Rows that one (source, id, hashes) group stands for."""
    return F.when(F.col("source").isin(list(distinct)), (F.col(n) > 0).cast("bigint")).otherwise(F.col(n))


class QuarantineState:
    """The counts below ``path``. ``distinct`` names the tables that count rows once.
    With ``db`` they are tables of that database in ``buckets`` buckets of the member
    id; ``dealt``: the loads' tables are read from such buckets of as many."""

    def __init__(self, spark: SparkSession, path: str, distinct: Collection[str] = (), db: str | None = None,
                 buckets: int | None = None, dealt: bool = False):
        self.spark, self.path, self.distinct = spark, path.rstrip("/"), tuple(distinct)
        self.db, self.buckets, self.dealt = db, buckets, dealt
        if db is not None and buckets is None:
            raise ValueError("a state kept in a database needs a number of buckets")
        self._loads: list[str] = []

    @staticmethod
    def _table(load: str) -> str:
        """A table's name for any load's name."""
        return f"load_{load.encode().hex()}"

    def _write(self, load: str, counts: DataFrame, dealt: bool) -> None:
        path = f"{self.path}/{load}"
        if self.db is None:
            counts.write.mode("overwrite").option("compression", "zstd").parquet(path)
        else:
            catalog.save_bucketed_table(counts, self.db, self._table(load), path, "member_id", self.buckets, dealt)

    def counts(self, loads: Collection[str] | None = None) -> DataFrame:
        names = self._loads if loads is None else list(loads)
        if not names:
            return self.spark.createDataFrame([], _SCHEMA)
        if self.db is None:
            return self.spark.read.schema(_SCHEMA).parquet(*[f"{self.path}/{n}" for n in names])
        return _union(*[catalog.scan_table(self.spark, f"{self.db}.{self._table(n)}") for n in names])

    def merge(self, load: str, tables: dict[str, DataFrame], sign: int = 1) -> DataFrame:
        """Add the load's rows (``sign=-1``: take them back) under the name
        ``load``; (member_id, change) of the ids that 'enter' or 'leave'."""
        self._write(load, row_counts(tables, self.distinct, sign), self.dealt)
        earlier = [n for n in self._loads if n != load]
        self._loads = [*earlier, load]
        new = self.counts([load])
        parts = [new.withColumn("was", F.lit(0).cast("bigint"))]
        if earlier:
            touched = new.select(F.col("member_id").alias("__touched")).distinct()
            old = self.counts(earlier).join(touched, F.col("member_id") == F.col("__touched"), "left_semi")
            parts.insert(0, old.withColumn("was", F.col("n")))
        both = (_union(*parts)
                .groupBy(*_ROW).agg(F.sum("n").alias("n"), F.sum("was").alias("was")))
        per_table = both.groupBy("member_id", "source").agg(F.sum(_rows_of("n", self.distinct)).alias("n"),
                                                            F.sum(_rows_of("was", self.distinct)).alias("was"))
        flags = per_table.groupBy("member_id").agg((F.max("n") > 1).alias("now"), (F.max("was") > 1).alias("before"))
        return flags.where(F.col("now") != F.col("before")).select(
            "member_id", F.when(F.col("now"), "enter").otherwise("leave").alias("change"))

    def quarantined(self) -> DataFrame:
        """The ids quarantined now."""
        rows = self.counts().groupBy(*_ROW).agg(F.sum("n").alias("n"))
        per = rows.groupBy("member_id", "source").agg(F.sum(_rows_of("n", self.distinct)).alias("n"))
        return per.groupBy("member_id").agg(F.max("n").alias("n")).where("n > 1").select("member_id")

    def compact(self, name: str) -> None:
        """Replace the loads by their sum, under a new name."""
        if name in self._loads:
            raise ValueError(f"{name!r} is the name of a load")
        # read from the buckets of the loads, the sums lie by them already
        self._write(name, self.counts().groupBy(*_ROW).agg(F.sum("n").alias("n")).where("n <> 0"), True)
        self._loads = [name]
