"""The end-to-end flow as stages that each write their tables.

wide rows -> keyed wide table -> cleaned entity tables -> published catalog
tables, consolidated view and snapshot -> duplicate reports and quarantined
tables -> loan score table.

Every stage reads what the previous stage wrote, so a lost executor costs at
most a re-run of the stage in flight, never a recomputation from the raw
input; this is the lineage cut. Output lives under the shared folder named by
``spark.checkpoint.dir`` unless ``base`` is given.

The keyed wide table is written once so that the four splits each read only
their own columns (plus the key) from columnar storage instead of re-deriving
the wide rows four times. With an explicit bucket count, loans and repayments
are stored bucketed by ``loan_id`` and the quarantined tables by ``member_id``,
so the score stage joins them without shuffling them again.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope import schemas
from lendscope.operators import quarantine
from lendscope.plans.frames import LendingFrames
from lendscope.rules import ScoreRules
from lendscope.session import app_id, shared_path
from lendscope.sources import catalog
from lendscope.sources.files import read_parquet, write_csv, write_parquet

CLEAN_TABLES = {
    # name: (frame attribute, declared DDL)
    "customers": ("customers", schemas.CUSTOMERS_TABLE_DDL),
    "loans": ("loans", schemas.LOANS_TABLE_DDL),
    "loans_repayments": ("repayments", schemas.REPAYMENTS_TABLE_DDL),
    "loans_defaulters_delinq": ("delinq", schemas.DELINQ_TABLE_DDL),
    "loans_defaulters_details": ("details", schemas.DETAILS_TABLE_DDL),
}
QUARANTINED = {
    "customers_c": ("customers_c", schemas.CUSTOMERS_TABLE_DDL),
    "loans_defaulters_delinq_c": ("delinq_c", schemas.DELINQ_TABLE_DDL),
    "loans_defaulters_details_c": ("details_c", schemas.DETAILS_TABLE_DDL),
}
# Tables stored bucketed by their join key: the score joins repayments to
# loans on loan_id, then everything else on member_id.
BUCKET_KEYS = {
    "loans": "loan_id",
    "loans_repayments": "loan_id",
    "customers_c": "member_id",
    "loans_defaulters_delinq_c": "member_id",
    "loans_defaulters_details_c": "member_id",
}


STAGES = ("wide", "clean", "publish", "quarantine", "score")


def run_together(actions, threads: int) -> None:
    """Run independent Spark actions (table writes) concurrently from a few
    threads: their jobs share the executors, so one write's straggler tail
    does not leave the cluster idle before the next starts. Any failure is
    re-raised."""
    if threads <= 1 or len(actions) <= 1:
        for act in actions:
            act()
        return
    with ThreadPoolExecutor(max_workers=min(threads, len(actions))) as pool:
        for fut in [pool.submit(act) for act in actions]:
            fut.result()


def run_staged(spark: SparkSession, sf_dir: str | None = None, base: str | None = None,
               db: str = "lending", ingest_ts=None, buckets: int = 0,
               rules: ScoreRules | None = None, raw: DataFrame | None = None,
               snapshot: bool = True, stages=STAGES, threads: int = 4) -> dict:
    """Run the flow (all stages, or the named ``stages``); returns the output
    base path, database and stage timings.

    The input is either ``raw``, a wide loan table with the source column names
    (for example ``sources.files.read_wide_loans(spark, csv_path)``), or the
    star-schema tables in ``sf_dir`` mapped by the testbed; it is needed only
    when the ``wide`` stage runs. A stage that is not run has its outputs read
    back from ``base`` (re-declared as plain external tables over that folder),
    so e.g. ``stages=["score"]`` re-scores from the tables an earlier run wrote,
    as re-running one step would.

    ``buckets`` is the bucket count of the tables in ``BUCKET_KEYS``; 0 (the
    default) writes every table unbucketed. A bucket is one task that adaptive
    execution neither splits nor merges, so give a count only for known sizes.
    ``rules`` defaults to the score parameters set in the session conf
    (``spark.sql.excellent_rated_pts`` ...), falling back to the fixed values.
    ``snapshot=False`` declares only the (lazy) consolidated view: a member
    key with many loans makes the view's row count the product of its loans,
    delinquency and details rows, which may be too large to materialise.
    ``threads`` independent writes of a stage are submitted at once (1 = one
    after another).
    """
    run = set(stages)
    unknown = run - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; choose from {STAGES}")
    if "wide" in run and raw is None and sf_dir is None:
        raise ValueError("give the wide loan table (raw=) or a star-schema directory (sf_dir=)")
    rules = rules or ScoreRules.from_conf(spark)
    base = (base or shared_path(spark, "flow", app_id(spark), uuid.uuid4().hex[:12])).rstrip("/")
    timings: dict[str, float] = {}
    f = LendingFrames(spark, sf_dir or "", ingest_ts=ingest_ts, rules=rules, materialize_wide=False)
    if raw is not None:
        f.use(raw=raw)
    catalog.create_database(spark, db, f"{base}/warehouse/{db}.db")

    def publish(df, table, ddl, location):
        if buckets and table in BUCKET_KEYS:
            return catalog.save_bucketed_table(df, db, table, location, BUCKET_KEYS[table], buckets)
        write_parquet(df, location)
        return catalog.create_external_table(spark, db, table, ddl, location)

    def existing(tables: dict, folder: str, written_now: bool) -> dict:
        """The tables of ``folder``: as just written (and declared) by this call,
        or else re-declared over ``base`` (plainly; same rows), so a table of the
        same name left in the catalog by a run over another folder is never read."""
        out = {}
        for table, (_, ddl) in tables.items():
            if not written_now:
                catalog.create_external_table(spark, db, table, ddl, f"{base}/{folder}/{table}")
            out[table] = catalog.scan_table(spark, f"{db}.{table}")
        return out

    def stage(name):
        timings[name] = time.time()

    def done(name):
        timings[name] = round(time.time() - timings[name], 3)

    # 1. keyed wide table
    if "wide" in run:
        stage("wide")
        write_parquet(f.keyed, f"{base}/wide_keyed")
        done("wide")
    if "clean" in run:
        f.use(keyed=read_parquet(spark, f"{base}/wide_keyed"))

    # 2. cleaned entity tables, declared in the database (+ the record/enquiry id list)
    if "clean" in run:
        stage("clean")
        frames_out = {table: getattr(f, attr) for table, (attr, _) in CLEAN_TABLES.items()}
        actions = [lambda t=table, ddl=ddl: publish(frames_out[t], t, ddl, f"{base}/clean/{t}")
                   for table, (_, ddl) in CLEAN_TABLES.items()]
        records = f.records_enq
        actions.append(lambda: write_parquet(records, f"{base}/clean/loans_defaulters_records_enq"))
        run_together(actions, threads)
        done("clean")
    t = existing(CLEAN_TABLES, "clean", "clean" in run)
    f.use(customers=t["customers"], loans=t["loans"], repayments=t["loans_repayments"],
          delinq_table=t["loans_defaulters_delinq"], details_table=t["loans_defaulters_details"])

    # 3. consolidated view and snapshot over the published tables
    if "publish" in run:
        stage("publish")
        view_sql = catalog.consolidated_view_sql(db)
        catalog.create_or_replace_view(spark, db, "customers_loan_v", view_sql)
        if snapshot:
            catalog.snapshot_table(spark.sql(view_sql), db, "customers_loan_t",
                                   f"{base}/snapshot/customers_loan_t")
        done("publish")

    # 4. duplicate reports and quarantine, from the published tables
    if "quarantine" in run:
        stage("quarantine")
        # one aggregation finds the duplicated keys of all three tables; the reports
        # and the quarantine list are read from its (small) written output
        sources = f.quarantine_sources
        write_parquet(quarantine.duplicate_counts(sources), f"{base}/quarantine/duplicate_counts")
        counts = read_parquet(spark, f"{base}/quarantine/duplicate_counts")
        f.use(dup_ids=counts.select("member_id"))
        actions = [lambda n=name: write_csv(counts.where(F.col(f"n_{n}") > 1).select("member_id"),
                                            f"{base}/reports/{n}_duplicates") for name in sources]
        dup_ids = f.dup_ids
        actions.append(lambda: write_csv(dup_ids, f"{base}/reports/duplicate_member_ids"))
        quarantined = {table: getattr(f, attr) for table, (attr, _) in QUARANTINED.items()}
        actions += [lambda t=table, ddl=ddl: publish(quarantined[t], t, ddl, f"{base}/cleaned/{t}")
                    for table, (_, ddl) in QUARANTINED.items()]
        run_together(actions, threads)
        done("quarantine")

    # 5. score from the quarantined tables
    if "score" in run:
        stage("score")
        c = existing(QUARANTINED, "cleaned", "quarantine" in run)
        f.use(dup_ids=read_parquet(spark, f"{base}/quarantine/duplicate_counts").select("member_id"),
              customers=c["customers_c"], delinq_table=c["loans_defaulters_delinq_c"],
              details_table=c["loans_defaulters_details_c"])
        write_parquet(f.score, f"{base}/final_score")
        catalog.create_external_table(spark, db, "score", schemas.SCORE_TABLE_DDL, f"{base}/final_score")
        done("score")

    return {"base": base, "db": db, "buckets": buckets, "timings": timings}


def declare_outputs(spark: SparkSession, base: str, db: str = "lending") -> list[str]:
    """Declare the tables an earlier ``run_staged`` wrote under ``base`` (cleaned,
    quarantined, score, the snapshot if present) and the consolidated view in
    ``db`` of this session's catalog, e.g. in a new process without a
    persistent metastore; returns the declared names. Bucketed tables are
    declared as plain Parquet tables (same rows)."""
    base = base.rstrip("/")
    catalog.create_database(spark, db, f"{base}/warehouse/{db}.db")
    names = []
    for tables, folder in ((CLEAN_TABLES, "clean"), (QUARANTINED, "cleaned")):
        for table, (_, ddl) in tables.items():
            names.append(catalog.create_external_table(spark, db, table, ddl, f"{base}/{folder}/{table}"))
    names.append(catalog.create_external_table(spark, db, "score", schemas.SCORE_TABLE_DDL, f"{base}/final_score"))
    names.append(catalog.create_or_replace_view(spark, db, "customers_loan_v", catalog.consolidated_view_sql(db)))
    snap = f"{base}/snapshot/customers_loan_t"
    try:
        schema = spark.read.parquet(snap).schema
    except Exception:  # noqa: BLE001 - run with snapshot=False
        schema = None
    if schema is not None:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        names.append(catalog.create_external_table(spark, db, "customers_loan_t", ddl, snap))
    return names


def main(argv: list[str] | None = None) -> None:
    """``python -m lendscope.plans.staged (--wide-csv PATH | --sf-dir DIR) [--base OUT] [--db NAME] [--stages ...]``

    Uses the session the environment provides (``spark-submit`` config), so the
    checkpoint folder, shuffle partitions and executors come from the cluster.
    """
    import argparse
    import json

    from lendscope.session import ensure_checkpoint_dir
    from lendscope.sources.files import read_wide_loans

    ap = argparse.ArgumentParser(prog="lendscope.plans.staged")
    src = ap.add_mutually_exclusive_group()
    src.add_argument("--wide-csv", help="wide loan CSV (header row, one loan per row)")
    ap.add_argument("--wide-schema", help="DDL of the wide CSV (skips the type-inference pass)")
    src.add_argument("--sf-dir", help="directory of the star-schema Parquet tables")
    ap.add_argument("--base", help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--db", default="lending")
    ap.add_argument("--buckets", type=int, default=0)
    ap.add_argument("--stages", default=",".join(STAGES),
                    help=f"comma-separated subset of {','.join(STAGES)} (others are read from --base)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("lendscope-staged").getOrCreate()
    ensure_checkpoint_dir(spark)
    raw = read_wide_loans(spark, args.wide_csv, args.wide_schema) if args.wide_csv else None
    out = run_staged(spark, args.sf_dir, base=args.base, db=args.db, buckets=args.buckets, raw=raw,
                     stages=[x for x in args.stages.split(",") if x])
    print(json.dumps(out))


if __name__ == "__main__":
    main()
