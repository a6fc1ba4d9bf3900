"""Catalog objects: database, external Parquet tables, persistent view, snapshot.

All DDL is idempotent: tables are dropped and re-declared over their
location, the view is ``CREATE OR REPLACE``, and the snapshot is an
overwrite of a managed table (a plain CTAS would fail on the second run).
The database gets an explicit location so nothing lands in the working
directory's default warehouse.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lendscope.operators.consolidate import (
    CUSTOMER_COLS, DELINQ_COLS, DETAIL_COLS, LOAN_COLS, REPAYMENT_COLS,
)


def quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, db: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(db)} LOCATION {literal(location)}")


def create_external_table(spark: SparkSession, db: str, table: str, ddl: str, location: str,
                          key: str | None = None, buckets: int = 0) -> str:
    """(Re)declare ``db.table`` with explicit columns over Parquet files at ``location``.

    Columns bind to the files by name; a declared column absent from the
    files reads as NULL. ``key`` and ``buckets`` are those of files that
    :func:`save_bucketed_table` wrote.
    """
    name = f"{db}.{table}"
    dealt = f" CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(key)}) INTO {buckets} BUCKETS" if key else ""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.sql(f"CREATE TABLE {quoted(name)} ({ddl}) USING parquet{dealt} LOCATION {literal(location)}")
    return name


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_temp_view(spark: SparkSession, df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` under ``view`` (session scoped) and run ``sql`` against it."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql)


def consolidated_view_sql(db: str, customers="customers", loans="loans", repayments="loans_repayments",
                          delinq="loans_defaulters_delinq", details="loans_defaulters_details",
                          partitioned: bool = False) -> str:
    """The view's SELECT. Customers meet loans as in
    :func:`lendscope.operators.consolidate.left_join_splittable`: an inner join,
    which adaptive execution can split where one member has very many loans,
    plus the customers without a loan. Loans meet their repayments before that,
    customers their delinquency and details: nothing is joined by member after
    the loans, since that would need a split join's rows shuffled once more, and
    adaptive execution then leaves the join whole. For the same reason the
    customers' side gets a shuffle of its own, by an expression for the member id.
    With ``partitioned`` it does not, for tables of members and loans in equal
    buckets of the member id (then nothing can be split)."""
    t = lambda n: quoted(f"{db}.{n}")
    of = lambda table, columns: [f"{table}.{x}" for x in columns]
    rest = of("d", DELINQ_COLS) + of("e", DETAIL_COLS)
    joined = f"LEFT JOIN {t(delinq)} d ON c.member_id = d.member_id LEFT JOIN {t(details)} e ON c.member_id = e.member_id"
    # the same value: a delinquency row is joined by an equal id or is all NULL
    member = "c.member_id" if partitioned else "coalesce(c.member_id, d.member_id) AS member_id"
    borrower = ", ".join([member] + of("c", CUSTOMER_COLS[1:]) + rest)
    lent = ", ".join(["l.loan_id", "l.member_id"] + of("l", LOAN_COLS) + of("r", REPAYMENT_COLS))
    matched = ", ".join(["l.loan_id"] + of("m", CUSTOMER_COLS) + of("l", LOAN_COLS + REPAYMENT_COLS)
                        + of("m", DELINQ_COLS + DETAIL_COLS))
    unmatched = ", ".join(["NULL AS loan_id"] + of("c", CUSTOMER_COLS)
                          + [f"NULL AS {x}" for x in LOAN_COLS + REPAYMENT_COLS] + rest)
    return (
        f"SELECT {matched} FROM (SELECT {borrower} FROM {t(customers)} c {joined}) m "
        f"JOIN (SELECT {lent} FROM {t(loans)} l LEFT JOIN {t(repayments)} r ON l.loan_id = r.loan_id) l "
        f"ON m.member_id = l.member_id "
        f"UNION ALL SELECT {unmatched} FROM {t(customers)} c "
        f"LEFT ANTI JOIN (SELECT DISTINCT member_id FROM {t(loans)}) k ON c.member_id = k.member_id {joined}"
    )


def create_or_replace_view(spark: SparkSession, db: str, view: str, select_sql: str) -> str:
    """Persistent (lazy) view: always reads the current table contents."""
    name = f"{db}.{view}"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {select_sql}")
    return name


def snapshot_table(df: DataFrame, db: str, table: str, location: str) -> str:
    """Materialised copy of ``df`` as a table over ``location``; repeatable.

    The files are overwritten in place and the table re-declared, so a rerun
    (even from a new session whose catalog forgot the table) replaces the
    snapshot instead of failing like a plain CTAS. Files are packed with zstd:
    member keys are hex digits, which only an entropy coder makes smaller.
    """
    name = f"{db}.{table}"
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    df.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", location).saveAsTable(name)
    return name


def save_bucketed_table(df: DataFrame, db: str, table: str, location: str, key: str,
                        buckets: int, dealt: bool = False) -> str:
    """Write ``df`` as a table over ``location`` bucketed and sorted by ``key``.

    Later joins and aggregations on ``key`` with the same number of
    partitions read the buckets in place instead of shuffling. The rows are
    first hash-partitioned on ``key`` into ``buckets`` partitions (the same
    hash bucketing uses), so each bucket is written as one file rather than
    one file per task and bucket; with ``dealt`` the caller has done that.
    Files are packed with zstd, as in :func:`snapshot_table`.
    """
    name = f"{db}.{table}"
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    rows = df if dealt else df.repartition(buckets, key)
    (rows.write.mode("overwrite").format("parquet")
     .option("compression", "zstd")
     .bucketBy(buckets, key).sortBy(key).option("path", location).saveAsTable(name))
    return name


def publish_version(df: DataFrame, db: str, table: str, ddl: str, base: str) -> str:
    """Write ``df`` as a new version of ``db.table`` below ``base`` and then switch.

    The files go to a folder of their own; only when they are whole, and hold
    every declared column, does the table's location change, which is one catalog
    operation. A write that fails leaves the table as it was, and DataFrames that
    were made before the switch go on reading the old files (see
    :func:`drop_old_versions`). Returns the new location."""
    spark, name = df.sparkSession, f"{db}.{table}"
    location = f"{base.rstrip('/')}/{table}/version-{uuid.uuid4().hex[:12]}"
    df.write.parquet(location)
    declared = [f.name for f in StructType.fromDDL(ddl).fields]
    missing = set(declared) - set(spark.read.parquet(location).columns)
    if missing:
        raise ValueError(f"{name}: the new version lacks {sorted(missing)}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION {literal(location)}")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {quoted(name)} ({ddl}) USING parquet LOCATION {literal(location)}")
    return location


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0]


def drop_old_versions(spark: SparkSession, db: str, table: str, base: str) -> int:
    """Delete every version of the table but the one it points at; the number deleted."""
    now = table_location(spark, f"{db}.{table}").rstrip("/").rpartition("/")[2]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{table}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() != now]
    for path in old:
        fs.delete(path, True)
    return len(old)


@dataclass(frozen=True)
class ColumnStats:
    column: str
    type: str
    nulls: int
    distinct: int  # an estimate


def column_statistics(spark: SparkSession, name: str) -> list[ColumnStats]:
    """The table's columns with the catalog's statistics, computed first (one
    aggregation over the table) and then read back by DESCRIBE, column by column."""
    spark.sql(f"ANALYZE TABLE {quoted(name)} COMPUTE STATISTICS FOR ALL COLUMNS")
    found = []
    for field in spark.table(name).schema.fields:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)} {quoted(field.name)}").collect()  # a few lines each
        info = {r.info_name: r.info_value for r in rows}
        found.append(ColumnStats(info["col_name"], info["data_type"], int(info["num_nulls"]), int(info["distinct_count"])))
    return found


def show_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def describe_database(spark: SparkSession, db: str) -> DataFrame:
    """Name, location and properties of ``db`` (info_name, info_value rows)."""
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {quoted(db)}")


def show_tables(spark: SparkSession, db: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quoted(db)}")
