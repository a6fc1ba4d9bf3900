"""Incremental refresh of the snapshot, versions of a table, counts on write."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from lendscope import schemas
from lendscope.plans.frames import LendingFrames
from lendscope.plans.lifecycle_queries import _earlier, _inputs
from lendscope.sources import catalog
from lendscope.sources.files import write_lookup_table, write_parquet_counted
from lendscope.sources.refresh import Snapshot, ViewInputs, bucket_of

BUCKETS = 16


@pytest.fixture(scope="module")
def frames(spark, sf_small):
    return LendingFrames(spark, sf_small)


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/rows-*/*/*.parquet")}


def changed(inputs, ids, **other):
    """The inputs with the loan amounts of some loans changed."""
    loans = inputs.loans.withColumn("loan_amount", F.when(F.col("loan_id").isin(ids), 1.0).otherwise(
        F.col("loan_amount")).cast("float"))
    return ViewInputs(**({"customers": inputs.customers, "loans": loans, "repayments": inputs.repayments,
                          "delinq": inputs.delinq, "details": inputs.details} | other))


def test_only_changed_buckets_are_rewritten(spark, frames, tmp_path):
    snap, inputs = Snapshot(spark, f"{tmp_path}/snap", BUCKETS), _inputs(frames)
    assert snap.refresh(inputs) == list(range(BUCKETS)) and same(snap.read(), frames.consolidated)
    before = files(f"{tmp_path}/snap")
    assert snap.refresh(inputs) == [] and files(f"{tmp_path}/snap") == before
    other = changed(inputs, ["100", "1200"])
    members = inputs.loans.where("loan_id IN ('100', '1200')").select(
        bucket_of(F.col("member_id"), BUCKETS).alias("b")).collect()
    assert snap.refresh(other) == sorted({r.b for r in members})
    assert same(snap.read(), other.view())
    after = files(f"{tmp_path}/snap")
    touched = {f"member_bucket={r.b}" for r in members}
    for f in before | after:
        assert (before.get(f) == after.get(f)) == (f.split("/")[-2] not in touched)


def test_changes_of_any_table_and_of_repeated_rows_are_seen(spark, frames, tmp_path):
    snap, inputs = Snapshot(spark, f"{tmp_path}/snap", BUCKETS), _inputs(frames)
    snap.refresh(inputs)
    pay = inputs.repayments.withColumn("last_payment_date", F.when(F.col("loan_id") == "7", "May-2020").otherwise(
        F.col("last_payment_date")))
    twice = inputs.details.unionByName(inputs.details.orderBy("member_id").limit(1))
    gone = inputs.customers.where(F.col("member_id") != inputs.customers.agg(F.max("member_id")).scalar())
    for now in (changed(inputs, [], repayments=pay), changed(inputs, [], details=twice),
                changed(inputs, [], customers=gone), inputs):
        assert len(snap.refresh(now)) <= 2
        assert same(snap.read(), now.view())


def test_a_bucket_without_customers_goes(spark, frames, tmp_path):
    snap, inputs = Snapshot(spark, f"{tmp_path}/snap", BUCKETS), _inputs(frames)
    snap.refresh(inputs)
    left = inputs.customers.where(bucket_of(F.col("member_id"), BUCKETS) != 3)
    assert snap.refresh(changed(inputs, [], customers=left)) == [3]
    assert not glob.glob(f"{tmp_path}/snap/rows-*/member_bucket=3")
    name = snap.declare(_database(spark, tmp_path), "snap")
    assert catalog.scan_table(spark, name).count() == snap.read().count() > 0


def test_a_refresh_that_dies_is_made_good(spark, frames, tmp_path, monkeypatch):
    """The rows are written before their fingerprints: the next refresh does them again."""
    snap, inputs = Snapshot(spark, f"{tmp_path}/snap", BUCKETS), _inputs(frames)
    snap.refresh(inputs)
    other = changed(inputs, ["100"])
    write = Snapshot._write

    def half(self, view):
        write(self, view)
        raise RuntimeError("lost")
    monkeypatch.setattr(Snapshot, "_write", half)
    with pytest.raises(RuntimeError):
        snap.refresh(other)
    monkeypatch.setattr(Snapshot, "_write", write)
    assert len(snap.refresh(other)) == 1 and same(snap.read(), other.view())
    assert snap.refresh(other) == []


def test_empty_inputs(spark, frames, tmp_path):
    inputs = _inputs(frames)
    none = ViewInputs(*[df.limit(0) for df in (inputs.customers, inputs.loans, inputs.repayments, inputs.delinq,
                                               inputs.details)])
    snap = Snapshot(spark, f"{tmp_path}/snap", BUCKETS)
    snap.refresh(none)
    assert snap.read().count() == 0 and snap.read().columns == frames.consolidated.columns
    snap.refresh(inputs)
    assert same(snap.read(), frames.consolidated)


def test_earlier_load_differs(frames):
    """The registered query's earlier load has changed, missing and vanished members."""
    now, then = frames.consolidated, _earlier(frames).consolidated
    assert now.exceptAll(then).count() > 0 and then.exceptAll(now).count() > 0


def _database(spark, tmp_path):
    db = f"t_{abs(hash(str(tmp_path)))}"
    catalog.create_database(spark, db, f"{tmp_path}/{db}.db")
    return db


def test_versions_switch_whole(spark, frames, tmp_path):
    db, base = _database(spark, tmp_path), f"{tmp_path}/versions"
    ddl, loans = schemas.LOANS_TABLE_DDL, frames.loans
    first = catalog.publish_version(loans.where("loan_id < '5'"), db, "loans", ddl, base)
    n_first = loans.where("loan_id < '5'").count()
    reader = catalog.scan_table(spark, f"{db}.loans")
    broken = loans.withColumn("loan_title", F.raise_error(F.lit("no title")).cast("string"))
    for bad in (broken, loans.drop("loan_title")):  # a write that fails, one that lacks a column
        with pytest.raises(Exception, match="no title|lacks"):
            catalog.publish_version(bad, db, "loans", ddl, base)
        assert catalog.table_location(spark, f"{db}.loans").endswith(first.rpartition("/")[2])
        assert catalog.scan_table(spark, f"{db}.loans").count() == n_first
    second = catalog.publish_version(loans, db, "loans", ddl, base)
    assert catalog.table_location(spark, f"{db}.loans").endswith(second.rpartition("/")[2])
    assert reader.count() == n_first  # a reader of the old version goes on
    assert same(catalog.scan_table(spark, f"{db}.loans"), loans)
    assert catalog.drop_old_versions(spark, db, "loans", base) >= 1
    assert same(catalog.scan_table(spark, f"{db}.loans"), loans)


def test_counts_are_taken_by_the_write(spark, frames, tmp_path):
    df = frames.loans_raw
    spark.sparkContext.setJobGroup("counted", "one write")
    try:
        got = write_parquet_counted(df, f"{tmp_path}/counted", {
            "rows": F.count(F.lit(1)), "no_amount": F.count_if(F.col("loan_amount").isNull())})
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.sparkContext.setJobGroup("plain", "one write")
    try:
        df.write.parquet(f"{tmp_path}/plain")
        plain = len(spark.sparkContext.statusTracker().getJobIdsForGroup("plain"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == plain  # counting adds no job
    assert got == {"rows": df.count(), "no_amount": df.where("loan_amount IS NULL").count()}


def test_lookup_files_are_range_sorted_with_bloom_filters(spark, frames, tmp_path):
    import pyarrow.parquet as pq
    path = write_lookup_table(frames.keyed.repartition(4), f"{tmp_path}/lookup", "name_sha2")
    spans = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        col = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == "name_sha2")
        stats = [meta.row_group(g).column(col).statistics for g in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    spans.sort()
    assert all(a[1] < b[0] or a[1] == b[0] for a, b in zip(spans, spans[1:]))
    key = frames.keyed.agg(F.max("name_sha2")).first()[0]
    found = spark.read.parquet(path).where(F.col("name_sha2") == key)
    assert "EqualTo(name_sha2" in found._jdf.queryExecution().toString()
    assert same(found, frames.keyed.where(F.col("name_sha2") == key))
