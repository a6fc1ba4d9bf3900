"""A member key holding a third of all rows: duplicate detection collapses it
map-side, the quarantine removes it, and the score neither fans out nor
contains it."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lendscope.plans.frames import LendingFrames
from lendscope.rules import MEMBER_KEY_COLUMNS

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def skewed(spark, sf_small):
    f = LendingFrames(spark, sf_small, materialize_wide=False)
    hot = (F.abs(F.hash("id")) % 3) == 0
    raw = f.raw.withColumns({c: F.when(hot, F.lit(None)).otherwise(F.col(c)) for c in MEMBER_KEY_COLUMNS})
    g = LendingFrames(spark, sf_small, materialize_wide=False)
    g.use(raw=raw)
    return g


def test_hot_key_share(skewed):
    n = skewed.keyed.count()
    hot = skewed.keyed.where(F.col("name_sha2") == EMPTY_SHA).count()
    assert hot > n / 4


def test_hot_key_is_quarantined_and_unscored(skewed):
    assert skewed.dup_ids.where(F.col("member_id") == EMPTY_SHA).count() == 1
    s = skewed.score
    assert s.where(F.col("member_id") == EMPTY_SHA).count() == 0
    assert s.groupBy("member_id").count().where("count > 1").count() == 0


def test_duplicate_detection_is_partially_aggregated(skewed):
    plan = skewed.dup_details._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_score_joins_are_filtered_before_member_joins(skewed):
    plan = skewed.score._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Cross" not in plan


def test_hot_key_on_the_right_is_split_by_aqe(spark):
    """A left outer join cannot split a hot key whose rows are on the right; the
    inner-plus-unmatched form of the same join lets AQE split it."""
    import re
    from lendscope.operators.consolidate import left_join_splittable
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 300000
        right = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("rk"),
            F.col("id").alias("rv"))
        left = spark.range(n // 3).select(F.col("id").cast("string").alias("k")).union(
            spark.createDataFrame([("hot",)], "k string"))

        def skew_split(df):
            qe = df._jdf.queryExecution()
            qe.toRdd().count()
            plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
            return len(re.findall(r"SortMergeJoin\(skew=true\)", plan))

        plain = left.join(right, F.col("k") == F.col("rk"), "left")
        rewritten = left_join_splittable(left, right, "k", "rk")
        assert skew_split(plain) == 0
        assert skew_split(rewritten) >= 1
        assert rewritten.count() == plain.count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_member_of_the_sql_view_is_split_by_aqe(spark):
    """The persistent view's SELECT over tables whose one member has a third of the loans."""
    from lendscope.plans.staged import CLEAN_TABLES
    from lendscope.session import scratch_path
    from lendscope.sources import catalog
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        db = "lendscope_view_skew_test"
        catalog.create_database(spark, db, scratch_path(spark, "tests", "view_skew_db"))
        n = 200_000
        ids = {"customers": spark.range(n // 3).select(F.col("id").cast("string").alias("member_id")),
               "loans": spark.range(n).select(
                   F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("member_id"),
                   F.col("id").cast("string").alias("loan_id")),
               "loans_repayments": spark.range(n // 10).select(F.col("id").cast("string").alias("loan_id"))}
        for table, (_, ddl) in CLEAN_TABLES.items():
            df = ids.get(table, spark.range(1000).select(F.col("id").cast("string").alias("member_id")))
            path = scratch_path(spark, "tests", "view_skew")
            df.repartition(8).write.parquet(path)
            catalog.create_external_table(spark, db, table, ddl, path)
        view = spark.sql(catalog.consolidated_view_sql(db))
        qe = view._jdf.queryExecution()
        rows = qe.toRdd().count()
        assert "SortMergeJoin(skew=true)" in qe.executedPlan().toString().split("== Initial Plan ==")[0]
        c, l = spark.table(f"{db}.customers"), spark.table(f"{db}.loans")
        assert rows == c.join(l, "member_id", "left").count() == view.count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
