"""Source/sink and catalog round trips as registered queries.

Each writes a frame derived from the given tables to a new folder under the
shared one (and a new database), removed when the application ends, reads it
back through the operator under test, and returns the read-back DataFrame.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lendscope import schemas
from lendscope.operators import clean
from lendscope.operators.split import split_loans_source
from lendscope.plans.frames import FIXED_INGEST_TS, FrameStore, LendingFrames
from lendscope.session import scratch_path
from lendscope.sources import catalog
from lendscope.sources.files import (
    read_csv_inferred, read_csv_schema, read_csv_strings, read_parquet, write_csv, write_parquet,
)

def _path(spark: SparkSession, name: str) -> str:
    """A folder of its own for every call: DataFrames of earlier calls, of other
    directories and of other applications stay readable."""
    return scratch_path(spark, "io", name)


def _db(spark: SparkSession, prefix: str = "lendscope_io") -> str:
    """A database of its own for every call."""
    db = f"{prefix}_{uuid.uuid4().hex[:12]}"
    catalog.create_database(spark, db, _path(spark, f"{db}.db"))
    return db


def scan_csv_inferred(f: LendingFrames) -> DataFrame:
    """Duplicate-id report written as CSV, read back with schema inference."""
    return read_csv_inferred(f.spark, write_csv(f.dup_ids, _path(f.spark, "duplicate_member_ids_csv")))


def sink_csv_single_file(f: LendingFrames) -> DataFrame:
    """The duplicate-id report, every id, as one CSV file, read back with schema
    inference. The ids are found by all tasks; one task writes them."""
    path = write_csv(f.dup_ids, _path(f.spark, "duplicate_member_ids_report"), single_file=True, line_breaks=" ")
    return read_csv_inferred(f.spark, path)


def scan_csv_schema(f: LendingFrames) -> DataFrame:
    """Loans split with source header names, read back with the typed DDL (positional)."""
    path = write_csv(split_loans_source(f.narrow.keyed), _path(f.spark, "loans_data_csv"))
    return read_csv_schema(f.spark, path, schemas.LOANS_RAW_DDL)


def scan_csv_strings(f: LendingFrames) -> DataFrame:
    """Header-only CSV read: every column a string."""
    df = f.narrow.keyed.select(
        F.col("id").alias("loan_id"), F.col("name_sha2").alias("member_id"), "term", "issue_d",
        "loan_status", "purpose", "title", "last_pymnt_d", "next_pymnt_d")
    return read_csv_strings(f.spark, write_csv(df, _path(f.spark, "loan_strings_csv")))


def sink_csv_roundtrip(f: LendingFrames) -> DataFrame:
    """Customers split written as CSV with a header and read back with its DDL."""
    path = write_csv(f.narrow.customers_raw, _path(f.spark, "customers_data_csv"), line_breaks=" ")
    return read_csv_schema(f.spark, path, schemas.CUSTOMERS_RAW_DDL)


def sink_parquet_roundtrip(f: LendingFrames) -> DataFrame:
    return read_parquet(f.spark, write_parquet(f.narrow.loans, _path(f.spark, "loans_data_cleaned")))


def external_table_roundtrip(f: LendingFrames) -> DataFrame:
    """Cleaned customers as Parquet, declared as an external table, scanned by name."""
    path = write_parquet(f.customers, _path(f.spark, "customers_data_cleaned"))
    name = catalog.create_external_table(f.spark, _db(f.spark), "customers", schemas.CUSTOMERS_TABLE_DDL, path)
    return catalog.scan_table(f.spark, name)


def scan_table(f: LendingFrames) -> DataFrame:
    """Score written as Parquet, declared as table ``score``, read back with SQL."""
    path = write_parquet(f.score, _path(f.spark, "final_score"))
    db = _db(f.spark)
    catalog.create_external_table(f.spark, db, "score", schemas.SCORE_TABLE_DDL, path)
    return f.spark.sql(f"SELECT * FROM `{db}`.`score`")


def scan_temp_view(f: LendingFrames) -> DataFrame:
    """The customers split as SQL over the keyed wide table registered as a temp view."""
    view = f"wide_{uuid.uuid4().hex[:12]}"
    text = lambda c: f"nullif(btrim({c}, concat(' ', chr(9), chr(10), chr(13))), '')"
    names = ["emp_title", "emp_length", "home_ownership", "addr_state", "zip_code", "grade", "sub_grade",
             "verification_status", "application_type", "verification_status_joint"]
    return catalog.scan_temp_view(f.spark, f.narrow.keyed, view, f"""
        SELECT name_sha2 AS member_id, {', '.join(f'{text(c)} AS {c}' for c in names)},
               TRY_CAST({text('annual_inc')} AS FLOAT) AS annual_inc, 'USA' AS country,
               CAST(tot_hi_cred_lim AS FLOAT) AS tot_hi_cred_lim, CAST(annual_inc_joint AS FLOAT) AS annual_inc_joint
        FROM {view}""")


def ingest_stamp(f: LendingFrames) -> DataFrame:
    return clean.ingest_stamp(f.narrow.repayments_raw, FIXED_INGEST_TS)


def consolidated_snapshot(f: LendingFrames) -> DataFrame:
    """The consolidated view materialised as a managed table (repeatable CTAS)."""
    name = catalog.snapshot_table(f.consolidated, _db(f.spark), "customers_loan_t",
                                  _path(f.spark, "customers_loan_t"))
    return catalog.scan_table(f.spark, name)


def _publish_clean_tables(f: LendingFrames, db: str) -> None:
    """The tables of members and loans are written in buckets of the member id, as the
    written wide rows they are read from, so that the view joins them without shuffling
    64 characters of key a row and table. All are packed with zstd."""
    from lendscope.plans.staged import CLEAN_TABLES, run_together

    def publish(table, attr, ddl):
        df, path = getattr(f, attr), _path(f.spark, f"catalog-{table}")
        if "member_id" not in df.columns:
            write_parquet(df, path, compression="zstd")
            catalog.create_external_table(f.spark, db, table, ddl, path)
            return
        catalog.save_bucketed_table(df, db, table, path, "member_id", f.buckets, dealt=True)
        catalog.create_external_table(f.spark, db, table, ddl, path, "member_id", f.buckets)

    run_together([lambda t=t, a=a, d=d: publish(t, a, d) for t, (a, d) in CLEAN_TABLES.items()], threads=4)


def consolidated_view_sql(f: LendingFrames) -> DataFrame:
    """Rows of the persistent view over the published tables."""
    db = _db(f.spark, "lendscope_view")
    _publish_clean_tables(f, db)
    view = catalog.create_or_replace_view(f.spark, db, "customers_loan_v",
                                          catalog.consolidated_view_sql(db, partitioned=True))
    return f.spark.sql(f"SELECT * FROM {view}")


def database_introspection(f: LendingFrames) -> DataFrame:
    """SHOW DATABASES, DESCRIBE DATABASE EXTENDED and SHOW TABLES of a database into
    which the cleaned tables were just published: whether it is listed, which items
    its description has, how many tables it lists and how many rows they hold."""
    from lendscope.plans.staged import CLEAN_TABLES
    db = _db(f.spark, "lendscope_info")
    _publish_clean_tables(f, db)
    listed = catalog.show_databases(f.spark).where(F.col("namespace") == db).agg(
        (F.count(F.lit(1)) == 1).alias("listed")).scalar()
    tables = catalog.show_tables(f.spark, db).agg(  # the session's temporary views are listed too
        F.count_if(F.col("isTemporary") == F.lit(False)).alias("n_tables")).scalar()
    rows = reduce(lambda a, b: a + b, [catalog.scan_table(f.spark, f"{db}.{t}").agg(F.count(F.lit(1))).scalar()
                                       for t in CLEAN_TABLES])
    info = catalog.describe_database(f.spark, db).where(
        F.col("info_name").isin("Namespace Name", "Location"))
    return info.select("info_name", F.contains("info_value", F.lit(db)).alias("names_database"),
                       listed.alias("listed"), tables.alias("n_tables"), rows.alias("n_rows"))


def catalog_tables(f: LendingFrames) -> DataFrame:
    """Publish the five cleaned tables, the view and the snapshot; list the
    database (SHOW TABLES) joined with each listed object's row count."""
    from lendscope.plans.staged import CLEAN_TABLES
    spark = f.spark
    db = _db(spark, "lendscope_catalog")
    _publish_clean_tables(f, db)
    view_sql = catalog.consolidated_view_sql(db, partitioned=True)
    catalog.create_or_replace_view(spark, db, "customers_loan_v", view_sql)
    seen = Observation()  # the view's rows are counted while the snapshot is written from it
    view = spark.table(f"`{db}`.`customers_loan_v`").observe(seen, F.count(F.lit(1)).alias("n_rows"))
    catalog.snapshot_table(view, db, "customers_loan_t", _path(spark, "catalog-customers_loan_t"))
    names = list(CLEAN_TABLES) + ["customers_loan_t"]
    counts = reduce(lambda a, b: a.unionByName(b), [
        catalog.scan_table(spark, f"{db}.{n}").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(n).alias("tableName"), "n_rows") for n in names]
        + [spark.createDataFrame([("customers_loan_v", seen.get["n_rows"])], "tableName string, n_rows bigint")])
    listed = catalog.show_tables(spark, db).where(F.col("isTemporary") == F.lit(False))
    return listed.select("tableName", "isTemporary").join(counts, "tableName")


def io_queries(store: FrameStore) -> dict:
    found = [scan_csv_inferred, scan_csv_schema, scan_csv_strings, sink_csv_roundtrip, sink_csv_single_file,
             sink_parquet_roundtrip, external_table_roundtrip, scan_table, scan_temp_view, ingest_stamp,
             consolidated_snapshot, consolidated_view_sql, database_introspection, catalog_tables]
    return {q.__name__: (lambda spark, sf_dir, q=q: q(store.frames(spark, sf_dir))) for q in found}
