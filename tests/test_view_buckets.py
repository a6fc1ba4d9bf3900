"""The persistent view over published tables: what it shuffles, and its rows on odd keys."""

import re

import pytest

from lendscope.operators.consolidate import VIEW_COLUMNS
from lendscope.plans import io_queries
from lendscope.plans.frames import LendingFrames
from lendscope.plans.staged import CLEAN_TABLES
from lendscope.session import scratch_path
from lendscope.sources import catalog


def test_the_view_shuffles_only_loans_and_repayments(spark, sf_small):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = LendingFrames(spark, sf_small)
        view = io_queries.consolidated_view_sql(f)
        keys = re.findall(r"Exchange hashpartitioning\((\w+)#", view._jdf.queryExecution().executedPlan().toString())
        assert sorted(keys) == ["loan_id", "loan_id", "member_id"]
        assert view.columns == VIEW_COLUMNS
        assert view.exceptAll(f.consolidated).count() == 0 and view.count() == f.consolidated.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_published_tables_are_packed_and_lie_by_member(spark, sf_small):
    f, db = LendingFrames(spark, sf_small), io_queries._db(spark, "lendscope_view_buckets_test")
    io_queries._publish_clean_tables(f, db)
    for table, (attr, ddl) in CLEAN_TABLES.items():
        got, want = catalog.scan_table(spark, f"{db}.{table}"), getattr(f, attr)
        assert got.columns == [c.split()[0] for c in ddl.split(", ")]
        assert all(p.endswith(".zstd.parquet") for p in got.inputFiles())
        want = want.select(*got.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
        if "member_id" in got.columns:
            counts = got.groupBy("member_id").count()._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in counts


@pytest.mark.parametrize("partitioned", [False, True])
def test_the_view_is_the_left_chain_whatever_the_keys(spark, partitioned):
    """Repeated and null member and loan ids, members without loans, loans without members."""
    rows = {
        "customers": [("a", "x"), ("a", "y"), ("b", "x"), ("c", None), ("", "e"), (None, "n"), (None, "n")],
        "loans": [("1", "a", 1.0), ("1", "a", 1.0), ("2", "b", 2.0), (None, "b", 3.0), ("4", None, 4.0), ("5", "z", 5.0),
                  ("6", "", 6.0), ("2", "a", 7.0)],
        "loans_repayments": [("1", 10.0), ("1", 11.0), ("2", 12.0), (None, 13.0), ("9", 14.0)],
        "loans_defaulters_delinq": [("a", 1), ("a", 1), ("c", 2), (None, 3), ("z", 4)],
        "loans_defaulters_details": [("a", 1), ("a", 2), ("b", 0), ("", 5), (None, 3)],
    }
    columns = {
        "customers": "member_id string, emp_title string", "loans": "loan_id string, member_id string, loan_amount float",
        "loans_repayments": "loan_id string, total_principal_received float",
        "loans_defaulters_delinq": "member_id string, delinq_2yrs int",
        "loans_defaulters_details": "member_id string, pub_rec int",
    }
    db = io_queries._db(spark, "lendscope_view_keys_test")
    for table, (_, ddl) in CLEAN_TABLES.items():
        df, path = spark.createDataFrame(rows[table], columns[table]), scratch_path(spark, "tests", "view_keys")
        if partitioned and "member_id" in df.columns:
            catalog.save_bucketed_table(df, db, table, path, "member_id", 3)
            catalog.create_external_table(spark, db, table, ddl, path, "member_id", 3)
        else:
            df.write.parquet(path)
            catalog.create_external_table(spark, db, table, ddl, path)
    got = spark.sql(catalog.consolidated_view_sql(db, partitioned=partitioned))
    assert got.columns == VIEW_COLUMNS
    c, l, r, d, e = (f"{db}.{t}" for t in CLEAN_TABLES)
    some = "loan_id", "member_id", "emp_title", "loan_amount", "total_principal_received", "delinq_2yrs", "pub_rec"
    want = spark.sql(f"""SELECT l.loan_id, c.member_id, emp_title, loan_amount, total_principal_received, delinq_2yrs, pub_rec
        FROM {c} c LEFT JOIN {l} l ON c.member_id = l.member_id LEFT JOIN {r} r ON l.loan_id = r.loan_id
        LEFT JOIN {d} d ON c.member_id = d.member_id LEFT JOIN {e} e ON c.member_id = e.member_id""")
    key = lambda row: [(v is not None, v) for v in row]
    assert sorted(map(tuple, got.select(*some).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
