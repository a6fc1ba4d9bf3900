"""The written frames lie by member key; the single-file report holds every id."""

import re

from pyspark.sql import functions as F

from lendscope.operators.quarantine_state import QuarantineState
from lendscope.plans import io_queries, lifecycle_queries
from lendscope.plans.frames import LendingFrames
from lendscope.sources.tables import StarTables
from lendscope.sources.testbed import raw_loans


def _shuffles(df):
    """Shuffles by member key of the plan as first made, broadcasts left out."""
    initial = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\((?:member_id|__key|__by|name_sha2)#", initial))


def test_member_key_steps_read_the_buckets_in_place(spark, sf_small):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = LendingFrames(spark, sf_small)
        assert _shuffles(f.dup_ids) == 0
        assert _shuffles(f.customers_c) == 0
        assert _shuffles(f.consolidated) == 0
        plain = LendingFrames(spark, sf_small, materialize_wide=False)
        assert _shuffles(plain.dup_ids) > 0
        for name in ("customers", "dup_ids", "consolidated", "score"):
            a, b = getattr(f, name), getattr(plain, name)
            assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_single_file_report_holds_every_duplicate_id(spark, sf_small):
    f = LendingFrames(spark, sf_small)
    got = io_queries.sink_csv_single_file(f)
    assert got.columns == ["member_id"] and len(got.inputFiles()) == 1
    assert got.exceptAll(f.dup_ids).count() == 0 and got.count() == f.dup_ids.count() > 4


def test_quarantine_counts_are_merged_where_they_lie(spark, sf_small):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = LendingFrames(spark, sf_small)
        key, state = lifecycle_queries._order(f), lifecycle_queries._quarantine_state(f)
        plain = QuarantineState(spark, lifecycle_queries._path(spark, "plain_state"), distinct=["customers"])
        for name, rows, sign in (("load 1", key % 3 != 1, 1), ("load-2", key % 3 == 1, 1), ("back", key % 120 == 0, -1)):
            load = lifecycle_queries._load(f, rows)
            got, want = state.merge(name, load, sign), plain.merge(name, load, sign)
            assert _shuffles(got) == 0
            assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
        for s in (state, plain):
            s.compact("all")
        assert _shuffles(state.quarantined()) == 0
        ids = state.quarantined()
        assert ids.exceptAll(plain.quarantined()).count() == 0 and ids.count() == plain.quarantined().count() > 0
        assert state.counts().exceptAll(plain.counts()).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_written_frames_are_packed_with_an_entropy_coder(spark, sf_small):
    keyed = LendingFrames(spark, sf_small).keyed
    assert keyed.inputFiles() and all(p.endswith(".zstd.parquet") for p in keyed.inputFiles())


def test_payments_are_added_up_exactly(spark):
    orders = [(1, 10.0, "x"), (2, 20.0, "x"), (3, 30.0, "x")]
    lines = [(1, 0.1), (1, 0.2), (1, 99999999.99), (2, None), (2, None)]
    t = StarTables(
        spark.createDataFrame(orders, "o_orderkey bigint, o_totalprice double, o_orderpriority string")
        .withColumn("o_orderdate", F.to_timestamp(F.lit("2024-01-01"))),
        spark.createDataFrame([(i, 0, 5.0, "BUILDING") for i in range(4)],
                              "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string"),
        spark.createDataFrame([(0, "ALGERIA")], "n_nationkey int, n_name string"),
        spark.createDataFrame(lines, "l_orderkey bigint, l_extendedprice double"))
    got = {r.id: r.total_rec_prncp for r in raw_loans(t).select("id", "total_rec_prncp").collect()}
    assert got == {"1": 100000000.29 / 2, "2": 0.0, "3": 0.0}
    sums = [n for n in re.findall(r"sum#\d+L?", raw_loans(t)._jdf.queryExecution().executedPlan().toString())]
    assert sums and all(n.endswith("L") for n in sums)  # shuffled as longs
