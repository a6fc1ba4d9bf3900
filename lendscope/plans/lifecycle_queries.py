"""Queries about tables over time: broken input lines, the view as factors,
incremental refresh and quarantine, counts taken while writing, versions.

Each derives an earlier state of the given tables, brings it up to date through
the operator under test, and returns what can then be read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lendscope import schemas
from lendscope.operators import clean, factorised, profile, quarantine
from lendscope.operators.quarantine_state import QuarantineState
from lendscope.plans.frames import FrameStore, LendingFrames
from lendscope.plans.io_queries import _db, _path
from lendscope.rules import MEMBER_KEY_COLUMNS
from lendscope.sources import catalog, ingest
from lendscope.sources.files import (
    read_csv_schema, read_parquet, write_csv, write_lookup_table, write_parquet, write_parquet_counted,
)
from lendscope.sources.refresh import Snapshot, ViewInputs

#: Broken lines of the wide CSV: order keys with these remainders of ``FAULT_EVERY``
#: are cut short, have a field too many, or no number where one belongs.
FAULT_EVERY, CUT, EXTRA, NO_NUMBER = 211, 3, 5, 7
CUT_FIELDS = 3


def _order(f: LendingFrames) -> Column:
    return F.col("id").cast("bigint")


def _faulty_csv(f: LendingFrames) -> str:
    """The wide rows as CSV lines, some of them broken."""
    raw = f.narrow.keyed.drop("name_sha2")
    rest = _order(f) % FAULT_EVERY
    spoiled = raw.withColumn("installment", F.when(rest == NO_NUMBER, F.lit("x"))
                             .otherwise(F.col("installment").cast("string")))
    line = F.to_csv(F.struct(*[f"`{c}`" for c in raw.columns]))
    lines = spoiled.select(F.when(rest == CUT, F.substring_index(line, ",", CUT_FIELDS))
                           .when(rest == EXTRA, F.concat(line, F.lit(",extra"))).otherwise(line).alias("line"))
    return ingest.write_lines(lines, ",".join(raw.columns), _path(f.spark, "wide_csv"))


def _ingested(f: LendingFrames) -> ingest.Ingested:
    """Inferred once, the schema kept; then read with the kept schema."""
    csv, kept = _faulty_csv(f), _path(f.spark, "wide_schema")
    schema = ingest.infer_schema(ingest.read_text_cells(f.spark, csv))
    ingest.save_schema(f.spark, schema, kept)
    return ingest.ingest_csv(f.spark, csv, _path(f.spark, "wide_rows"), ingest.load_schema(f.spark, kept))


def ingest_wide_csv(f: LendingFrames) -> DataFrame:
    """The wide loan CSV as typed rows, broken lines left out."""
    return _ingested(f).rows


def ingest_rejected_lines(f: LendingFrames) -> DataFrame:
    """The lines left out, each with what is wrong with it."""
    got = _ingested(f)
    return ingest.rejections(got.rejected, got.schema).select(
        F.split("line", ",")[0].cast("int").alias("id"), "n_fields", "reason", "columns")


def _units(c: Column) -> Column:
    """A float as whole 1024ths, which add up exactly."""
    return F.floor(c.cast("double") * 1024).cast("bigint")


#: One measure of each table
MEASURES = ("annual_income", "loan_amount", "interest_rate", "total_principal_received", "delinq_amnt", "pub_rec")


def _factors(f: LendingFrames) -> DataFrame:
    return factorised.factorise(f.customers, f.loans, f.repayments, f.delinq_table, f.details_table)


def factorised_totals(f: LendingFrames) -> DataFrame:
    """Rows and column sums of the consolidated view, without its rows."""
    one = factorised.totals(_factors(f), {c: _units for c in MEASURES})
    return one.select(*[F.col(c).cast("bigint").alias(c) for c in one.columns])


def factorised_view(f: LendingFrames) -> DataFrame:
    """The consolidated view's rows, expanded from its factors. Each factor is
    expanded on its own, so the factors are built once and kept, by member."""
    kept = catalog.save_bucketed_table(_factors(f), _db(f.spark, "lendscope_factors"), "factors",
                                       _path(f.spark, "factors"), "member_id", f.buckets)
    return factorised.expand(catalog.scan_table(f.spark, kept))


def factorised_members(f: LendingFrames) -> DataFrame:
    """Entries of each factor and rows of the view by member."""
    per = factorised.member_totals(_factors(f))
    return per.select("member_id", *[F.col(c).cast("bigint").alias(c) for c in per.columns if c != "member_id"])


#: A slice of the orders that an earlier load of the tables knew differently
SLICE_EVERY = 997


def _earlier(f: LendingFrames) -> LendingFrames:
    """The frames as an earlier load had them: some loans with other amounts, some
    not there yet, and some members that have gone since."""
    rest, now = _order(f) % SLICE_EVERY, f.keyed
    other = now.where(rest != 12).withColumns({
        "loan_amnt": F.when(rest == 11, F.col("loan_amnt") / 2).otherwise(F.col("loan_amnt")),
        "last_pymnt_amnt": F.when(rest == 14, F.lit(1.0)).otherwise(F.col("last_pymnt_amnt"))})
    gone = now.where(rest == 13).withColumns({"id": F.concat(F.lit("gone-"), "id"),
                                              "name_sha2": F.sha2(F.concat(F.lit("gone-"), "name_sha2"), 256)})
    return LendingFrames(f.spark, f.sf_dir, f.ingest_ts, f.rules).use_keyed(
        other.unionByName(gone.repartition(f.buckets, "name_sha2")))


def _inputs(f: LendingFrames) -> ViewInputs:
    return ViewInputs(f.customers, f.loans, f.repayments, f.delinq_table, f.details_table,
                      partitioned=f.materialize_wide)


def snapshot_refresh(f: LendingFrames) -> DataFrame:
    """The snapshot written from an earlier load and refreshed with the present
    one, read as a partitioned table."""
    snap = Snapshot(f.spark, _path(f.spark, "snapshot"))
    snap.refresh(_inputs(_earlier(f)))
    snap.refresh(_inputs(f))
    name = snap.declare(_db(f.spark, "lendscope_refresh"), "customers_loan_t")
    return catalog.scan_table(f.spark, name).drop("member_bucket")


def _load(f: LendingFrames, rows: Column) -> dict[str, DataFrame]:
    """The quarantine's tables of some wide rows. Customers are distinct rows with
    an income, as the cleaning leaves them; its later steps change no counts."""
    part = LendingFrames(f.spark, f.sf_dir, f.ingest_ts, f.rules, materialize_wide=False).use(keyed=f.keyed.where(rows))
    return {"customers": part.customers_income.drop("ingest_date"), "loans_defaulters_delinq": part.delinq_table,
            "loans_defaulters_details": part.details_table}


def _quarantine_state(f: LendingFrames) -> QuarantineState:
    """A new state, kept in the buckets that the loads are read from."""
    return QuarantineState(f.spark, _path(f.spark, "quarantine_state"), distinct=["customers"],
                           db=_db(f.spark, "lendscope_quarantine"), buckets=f.buckets, dealt=f.materialize_wide)


def quarantine_loads(f: LendingFrames) -> DataFrame:
    """Two loads and a retraction merged into one quarantine state: which ids
    enter or leave with each."""
    key = _order(f)
    second = (key % 40 == 0) | (key % 3 == 1)
    state = _quarantine_state(f)
    steps = [state.merge("load-1", _load(f, ~second)), state.merge("load-2", _load(f, second)),
             state.merge("retraction-3", _load(f, key % 120 == 0), sign=-1)]
    return reduce(lambda a, b: a.unionByName(b),
                  [s.withColumn("step", F.lit(i)) for i, s in enumerate(steps, 1)])


def quarantine_after_loads(f: LendingFrames) -> DataFrame:
    """The ids quarantined after two loads, from compacted counts: those of one load."""
    second = (_order(f) % 40 == 0) | (_order(f) % 3 == 1)
    state = _quarantine_state(f)
    state.merge("load-1", _load(f, ~second))
    state.merge("load-2", _load(f, second))
    state.compact("all-2")
    return state.quarantined()


def quality_counts_on_write(f: LendingFrames) -> DataFrame:
    """The quality counts, taken by the writes of the tables themselves."""
    from lendscope.plans.registry import quality_metrics
    from lendscope.plans.staged import run_together
    found = {}

    def write(name: str, df: DataFrame, metrics: dict) -> None:
        found[name] = write_parquet_counted(df, _path(f.spark, f"counted-{name}"), metrics)

    tables = quality_metrics(f)
    run_together([lambda n=n, d=d, m=m: write(n, d, m) for n, (d, m) in tables.items()], threads=4)
    return f.spark.createDataFrame([(t, m, int(v)) for t, ms in found.items() for m, v in ms.items()],
                                   "table_name string, metric string, value bigint")


def publish_versions(f: LendingFrames) -> DataFrame:
    """Loans published twice: a reader made before the switch and one after it."""
    spark, db, base = f.spark, _db(f.spark, "lendscope_versions"), _path(f.spark, "versions")
    publish = lambda df: catalog.publish_version(df, db, "loans", schemas.LOANS_TABLE_DDL, base)
    publish(f.loans.where(F.col("loan_id").cast("bigint") % 10 != 3))
    first = catalog.scan_table(spark, f"{db}.loans").withColumn("version", F.lit(1))
    publish(f.loans)
    second = catalog.scan_table(spark, f"{db}.loans").withColumn("version", F.lit(2))
    return first.unionByName(second)


def key_audit(f: LendingFrames) -> DataFrame:
    """Whether the member key tells members apart: rows, keys, shared keys, collisions."""
    return profile.key_audit(f.narrow.keyed, "name_sha2", list(MEMBER_KEY_COLUMNS))


def key_collisions(f: LendingFrames) -> DataFrame:
    """Loans by a shorter key (its first hex digits), where members do collide."""
    short = f.narrow.keyed.withColumn("short_key", F.substring("name_sha2", 1, 3))
    return profile.key_collisions(short, "short_key", list(MEMBER_KEY_COLUMNS))


def column_statistics(f: LendingFrames) -> DataFrame:
    """Name, type, NULLs and distinct values of the published tables' columns, from
    the catalog's own statistics. Distinct counts there are estimates: returned is
    whether each lies within a tenth of the exact one."""
    from lendscope.plans.staged import CLEAN_TABLES
    spark, db = f.spark, _db(f.spark, "lendscope_stats")
    found = []
    for table in ("loans", "loans_repayments", "loans_defaulters_delinq"):
        attr, ddl = CLEAN_TABLES[table]
        df = getattr(f, attr)
        write_parquet(df, path := _path(spark, f"stats-{table}"))
        name = catalog.create_external_table(spark, db, table, ddl, path)
        exact = catalog.scan_table(spark, name)
        counts = exact.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in exact.columns]).first()
        found += [(table, s.column, s.type, s.nulls, abs(s.distinct - counts[s.column]) <= 0.1 * counts[s.column] + 1)
                  for s in catalog.column_statistics(spark, name)]
    return spark.createDataFrame(found, "table_name string, column_name string, data_type string, n_null bigint, "
                                        "distinct_close boolean")


def ingest_lineage(f: LendingFrames) -> DataFrame:
    """Rows and distinct loans of the repayments by the input file they come from
    (files are named by the month of the issue date), from the reader's own
    metadata, next to the ingest stamp."""
    path = _path(f.spark, "repayments_by_month")
    month = F.substring("issue_d", 1, 3)
    rows = f.narrow.keyed.select(F.col("id").alias("loan_id"), "total_pymnt", month.alias("month"))
    rows.hint("rebalance", "month").write.partitionBy("month").mode("overwrite").parquet(path)
    read = clean.with_lineage(f.spark.read.parquet(path)).drop("month")
    return (read.groupBy(F.regexp_extract("source_file", "month=([A-Za-z]+)", 1).alias("month"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("loan_id").alias("n_loans"),
                 F.count_if(F.col("source_modified").isNull() | (F.col("source_block_start") < 0)).alias("n_unknown")))


def lookup_member_indexed(f: LendingFrames) -> DataFrame:
    """The lookup of a member (the key of no values) in files sorted by member with
    Bloom filters."""
    path = write_lookup_table(f.narrow.keyed, _path(f.spark, "member_index"), "name_sha2")
    return profile.lookup_key(f.spark.read.parquet(path), F.sha2(F.lit(""), 256), "name_sha2")


def score_sql_variables(f: LendingFrames) -> DataFrame:
    """The graded score in SQL: rule points as session variables, bands as SQL functions."""
    from lendscope.plans.score_sql import graded_score
    return graded_score(f.spark, f.repayments, f.loans_q, f.details_table, f.delinq_table, f.customers, f.rules,
                        tag=uuid.uuid4().hex[:12])


def _variant(f: LendingFrames, **options) -> LendingFrames:
    """The same wide rows under other options of the flow."""
    return LendingFrames(f.spark, f.sf_dir, f.ingest_ts, f.rules, materialize_wide=False, **options).use(
        keyed=f.keyed, customers=f.customers)


def score_with_left_delinq(f: LendingFrames) -> DataFrame:
    """The graded score, members without a delinquency record included."""
    return _variant(f, delinq_join="left").score


def duplicate_member_ids_dedup(f: LendingFrames) -> DataFrame:
    """The quarantined ids when repeated rows of the defaulters are dropped first."""
    return _variant(f, dedup=True).dup_ids


def duplicate_reports(f: LendingFrames) -> DataFrame:
    """The three duplicate reports written as CSV (ids partitioned, from one
    aggregation) and read back, with the table each id is duplicated in."""
    spark, sources = f.spark, f.quarantine_sources
    counts = read_parquet(spark, write_parquet(quarantine.duplicate_counts(sources), _path(spark, "duplicate_counts")))
    reports = []
    for name in sources:
        ids = counts.where(F.col(f"n_{name}") > 1).select("member_id")
        path = write_csv(ids, _path(spark, f"{name}_duplicates"))
        reports.append(read_csv_schema(spark, path, "member_id string").withColumn("table_name", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), reports)


def lifecycle_queries(store: FrameStore) -> dict:
    found = [ingest_wide_csv, ingest_rejected_lines, factorised_totals, factorised_view, factorised_members,
             snapshot_refresh, quarantine_loads, quarantine_after_loads, quality_counts_on_write, publish_versions,
             key_audit, key_collisions, column_statistics, ingest_lineage, lookup_member_indexed, score_sql_variables,
             score_with_left_delinq, duplicate_member_ids_dedup, duplicate_reports]
    return {q.__name__: (lambda spark, sf_dir, q=q: q(store.frames(spark, sf_dir))) for q in found}
