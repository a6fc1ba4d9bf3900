"""Invariants and plan shape on the sf0.001 tables; entry contract."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lendscope.plans.registry import all_queries, frames


@pytest.fixture(scope="module")
def f(spark, sf_small):
    return frames(spark, sf_small)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["member_id", "payment_history_pts", "defaulters_history_pts",
                          "financial_health_pts", "loan_score", "loan_final_grade"]
    assert df.count() > 0


def test_every_query_has_oracle(spark):
    from lendscope.plans.oracle_sql import oracle_queries
    from lendscope.plans.registry import all_queries
    assert set(all_queries()) == set(oracle_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(all_queries()) <= set(entry.queries())


def test_score_invariants(f):
    s = f.score
    assert s.where(F.col("loan_score") > 2850).count() == 0
    assert s.groupBy("member_id").count().where("count > 1").count() == 0
    assert s.join(f.dup_ids, "member_id", "left_semi").count() == 0
    assert s.where(F.col("loan_score").isNull() != F.col("loan_final_grade").isNull()).count() == 0


# a null-aware anti join (what SQL NOT IN plans as) prints as "LeftAnti, Build<side>, true"
NULL_AWARE = re.compile(r"LeftAnti, Build\w+, true")


def has_bad_join(plan: str) -> bool:
    return ("CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan
            or NULL_AWARE.search(plan) is not None)


def test_bad_join_detector_catches_sql_not_in(spark):
    p = spark.createDataFrame([(1,), (2,)], "k int")
    q = spark.createDataFrame([(1,)], "v int")
    p.createOrReplaceTempView("nin_probe")
    q.createOrReplaceTempView("nin_list")
    qe = spark.sql("SELECT * FROM nin_probe WHERE k NOT IN (SELECT v FROM nin_list)")._jdf.queryExecution()
    qe.toRdd().count()
    assert has_bad_join(qe.executedPlan().toString())


def test_score_plan_has_no_cartesian_or_null_aware_join(f):
    qe = f.score.select("*")._jdf.queryExecution()
    qe.toRdd().count()
    assert not has_bad_join(qe.executedPlan().toString())


def test_scans_are_pruned(f):
    """The record/enquiry ids read four columns of the 38-column wide table."""
    import re
    plan = f.records_enq._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) == 1
    cols = {c.split(":")[0] for c in schemas[0].split(",")}
    assert cols == {"name_sha2", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"}


def test_staged_flow(spark, sf_small):
    from lendscope.plans.staged import run_staged
    # output goes under the session's spark.checkpoint.dir (shared folder)
    out = run_staged(spark, sf_small, db="lending_test")
    assert set(out["timings"]) == {"wide", "clean", "publish", "quarantine", "score"}
    tables = {r.tableName for r in spark.sql("SHOW TABLES IN lending_test").collect()}
    assert {"customers", "loans", "loans_repayments", "loans_defaulters_delinq", "loans_defaulters_details",
            "customers_loan_v", "customers_loan_t", "customers_c", "loans_defaulters_delinq_c",
            "loans_defaulters_details_c", "score"} <= tables
    staged = spark.table("lending_test.score")
    lazy = frames(spark, sf_small).score
    assert staged.count() == lazy.count()
    assert staged.select("member_id").exceptAll(lazy.select("member_id")).count() == 0


def test_staged_tables_are_bucketed(spark, sf_small):
    from lendscope.plans.staged import BUCKET_KEYS, run_staged
    from lendscope.sources import catalog
    run_staged(spark, sf_small, db="lending_bucket_test", buckets=4)
    for table, key in BUCKET_KEYS.items():
        info = {r.col_name: r.data_type for r in
                spark.sql(f"DESCRIBE TABLE EXTENDED lending_bucket_test.{table}").collect()}
        assert info.get("Num Buckets") == "4", table
        assert key in info.get("Bucket Columns", ""), table
    loc = {r.info_name: r.info_value for r in catalog.describe_database(spark, "lending_bucket_test").collect()}
    assert "lending_bucket_test.db" in loc["Location"]
    assert "lending_bucket_test" in {r[0] for r in catalog.show_databases(spark).collect()}


def test_staged_flow_from_wide_csv(spark, sf_small):
    """The flow run on a wide CSV file gives the same score as the flow run on the tables."""
    from lendscope.plans.staged import run_staged
    from lendscope.session import shared_path
    from lendscope.sources.files import read_wide_loans
    f = frames(spark, sf_small)
    path = shared_path(spark, "tests", "wide_csv")
    # a hand-kept file has its padding; the member key is hashed over it
    (f.raw.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    out = run_staged(spark, raw=read_wide_loans(spark, path), db="lending_csv_test", buckets=0)
    assert "/flow/" in out["base"]
    from_csv = spark.table("lending_csv_test.score")
    lazy = f.score
    assert from_csv.count() == lazy.count()
    assert from_csv.exceptAll(lazy).count() == 0


def test_single_file_csv_report(spark, f):
    """K1: a small report written as one CSV file with a header, read back whole."""
    import glob
    from lendscope.session import shared_path
    from lendscope.sources.files import read_csv_schema, write_csv
    path = write_csv(f.dup_ids, shared_path(spark, "tests", "dup_ids_single"), single_file=True)
    if path.startswith("/"):
        assert len(glob.glob(f"{path}/part-*.csv")) == 1
    back = read_csv_schema(spark, path, "member_id string")
    assert back.count() == f.dup_ids.count()
    assert back.exceptAll(f.dup_ids).count() == 0


def test_rescore_alone_in_a_fresh_catalog(spark, sf_small):
    """stages=["score"] re-scores from the tables an earlier run wrote, declaring
    them from the output folder (as a new process with an empty catalog would)."""
    from lendscope.plans.staged import run_staged
    from lendscope.rules import ScoreRules
    first = run_staged(spark, sf_small, db="lending_stage_a", buckets=4)
    before = spark.table("lending_stage_a.score")
    n, best = before.count(), before.agg({"loan_score": "max"}).first()[0]
    out = run_staged(spark, db="lending_stage_b", base=first["base"], stages=["score"],
                     rules=ScoreRules(excellent=900))
    assert set(out["timings"]) == {"score"}
    after = spark.table("lending_stage_b.score")
    assert after.count() == n
    assert after.agg({"loan_score": "max"}).first()[0] > best


def test_wide_copy_removed_when_application_ends(sf_small):
    """The per-application wide-table copy is deleted when that application's JVM exits."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from lendscope.session import local_session\n"
        "import __spark_entry__ as e\n"
        "s = local_session(2)\n"
        "files = e.queries()['member_key'](s, %r).inputFiles()\n"
        "from lendscope.plans.registry import frames\n"
        "import os; p = os.path.dirname(frames(s, %r).keyed.inputFiles()[0].replace('file://', ''))\n"
        "print(os.path.exists(p), p)\n"
        "s.stop()\n"
    ) % (repo, sf_small, sf_small)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    existed, path = out.stdout.strip().splitlines()[-1].split(" ", 1)
    assert existed == "True" and "/frames/keyed/" in path
    assert not os.path.exists(path)


def test_public_score_function_equals_frame_graph(f):
    from lendscope.operators import score
    direct = score.loan_score_grades(f.repayments, f.loans, f.details_c, f.delinq_c, f.customers_c, f.dup_ids)
    assert direct.columns == f.score.columns
    assert direct.exceptAll(f.score).count() == 0 and f.score.exceptAll(direct).count() == 0


def test_declare_outputs_of_an_earlier_run(spark, sf_small):
    from lendscope.plans.staged import declare_outputs, run_staged
    out = run_staged(spark, sf_small, db="lending_decl_src", buckets=0)
    n = spark.table("lending_decl_src.score").count()
    v = spark.table("lending_decl_src.customers_loan_t").count()
    names = declare_outputs(spark, out["base"], db="lending_decl")
    assert "lending_decl.score" in names and "lending_decl.customers_loan_v" in names
    assert spark.sql("SELECT * FROM lending_decl.score").count() == n
    assert spark.table("lending_decl.customers_loan_v").count() == v
    assert spark.table("lending_decl.customers_loan_t").count() == v


def test_no_query_plans_cross_or_null_aware_joins_at_scale(spark, sf_small):
    """With broadcasts disabled (the shape at scale), no registered query's final
    plan has a cartesian product, a nested-loop join or a null-aware anti join."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        offenders = []
        for name, fn in all_queries().items():
            qe = fn(spark, sf_small).select("*")._jdf.queryExecution()
            qe.toRdd().count()
            if has_bad_join(qe.executedPlan().toString()):
                offenders.append(name)
        assert offenders == []
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_skipped_stage_reads_its_own_base_not_a_stale_table(spark, sf_small):
    """A db reused for a run over another folder must not leak that run's tables
    into a later partial run."""
    from lendscope.plans.staged import run_staged
    from lendscope.session import shared_path
    a = run_staged(spark, sf_small, db="lending_reuse", base=shared_path(spark, "tests", "flow_a"), buckets=0)
    n_a = spark.table("lending_reuse.score").count()
    # a second folder whose quarantined customers table is empty: rescoring from it must give 0 rows
    b = shared_path(spark, "tests", "flow_b")
    run_staged(spark, sf_small, db="lending_reuse_b", base=b, buckets=0)
    empty = spark.table("lending_reuse_b.customers_c").limit(0)
    empty.write.mode("overwrite").parquet(b + "/cleaned/customers_c_tmp")
    spark.read.parquet(b + "/cleaned/customers_c_tmp").write.mode("overwrite").parquet(b + "/cleaned/customers_c")
    run_staged(spark, db="lending_reuse", base=b, stages=["score"])
    assert n_a > 0 and spark.table("lending_reuse.score").count() == 0


def test_changed_inputs_give_new_rows(spark, tmp_path, sf_small):
    for t in ("orders", "customer", "nation", "lineitem"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    queries = all_queries()
    before = {k: queries[k](spark, str(tmp_path)).count() for k in ("member_key", "duplicate_member_ids")}
    half = spark.read.parquet(f"{sf_small}/orders.parquet").where("o_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert queries["member_key"](spark, str(tmp_path)).count() == half.count() < before["member_key"]
    assert queries["duplicate_member_ids"](spark, str(tmp_path)).count() < before["duplicate_member_ids"]


def test_no_order_is_lost_in_the_wide_table(f, spark, sf_small):
    assert f.raw.count() == spark.read.parquet(f"{sf_small}/orders.parquet").count()


def test_io_queries_keep_earlier_results_readable(spark, tmp_path, sf_small):
    """Built twice, and over two directories with one base name."""
    other = tmp_path / "sf0.001"
    for t in ("orders", "customer", "nation", "lineitem"):
        df = spark.read.parquet(f"{sf_small}/{t}.parquet")
        (df.where("o_orderkey % 3 = 0") if t == "orders" else df).write.parquet(f"{other}/{t}.parquet")
    q = all_queries()
    for key in ("scan_csv_schema", "scan_table", "consolidated_snapshot"):
        first, second, third = q[key](spark, sf_small), q[key](spark, sf_small), q[key](spark, str(other))
        n = second.count()
        assert first.count() == n and 0 < third.count() < n and first.count() == n


def test_score_has_one_anti_join_and_five_joins(spark, f):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.enabled")
    for k, v in zip(keys, ("-1", "-1", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        plan = f.score.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in keys:
            spark.conf.unset(k)
    joins = re.findall(r"SortMergeJoin .*", plan)
    assert len(joins) == 5 and sum("LeftAnti" in j for j in joins) == 1


def test_customers_are_deduplicated_once(spark, f):
    """The quarantined customers and the consolidated view read the written table."""
    for df in (f.customers_c, f.consolidated):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "emp_title" not in " ".join(re.findall(r"Aggregate \[([^\]]*)\]", plan))
