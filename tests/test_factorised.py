"""The consolidated view as factors: totals and rows equal the view's."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendscope.operators import factorised as fz
from lendscope.operators.consolidate import consolidated_view
from lendscope.plans.frames import LendingFrames


def units(c):
    return F.floor(c.cast("double") * 1024).cast("bigint")


MEASURES = {c: units for c in ("annual_income", "loan_amount", "total_interest_received", "delinq_amnt", "pub_rec")}


def view_totals(view):
    return tuple(view.agg(F.count(F.lit(1)), *[F.sum(units(F.col(c))) for c in MEASURES]).first())


@pytest.fixture
def tables(spark, sf_small):
    f = LendingFrames(spark, sf_small)
    return f.customers, f.loans, f.repayments, f.delinq_table, f.details_table


def multiplied(tables):
    """Every third member with several rows in each table, repeated rows among them."""
    out = []
    for i, df in enumerate(tables):
        key = "loan_id" if "loan_id" in df.columns else "member_id"
        more = df.where(F.pmod(F.xxhash64(key), F.lit(3)) == 0)
        if "loan_id" in df.columns and "member_id" in df.columns:
            more = more.withColumn("loan_id", F.concat("loan_id", F.lit("-b")))
        elif i >= 3:
            more = more.unionByName(more)
        out.append(df.unionByName(more))
    return out


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_factors_give_the_views_rows_and_totals(spark, tables, block):
    for ts in (tables, multiplied(tables)):
        view, factors = consolidated_view(*ts), fz.factorise(*ts, block=block)
        got = tuple(int(x) for x in fz.totals(factors, MEASURES).first())
        assert got == view_totals(view)
        rows = fz.expand(factors)
        assert rows.dtypes == view.dtypes
        assert rows.exceptAll(view).count() == 0 and view.exceptAll(rows).count() == 0


def hot(spark, n):
    """One member with n rows in each of three tables: n ** 3 rows of the view."""
    ids = spark.range(n)
    customers = spark.createDataFrame([("hot", 10.0), ("cold", 1.0), (None, 5.0)], "member_id string, annual_income float")
    loans = ids.select(F.lit("hot").alias("member_id"), F.col("id").cast("string").alias("loan_id"),
                       F.lit(2.0).cast("float").alias("loan_amount"))
    delinq = ids.select(F.lit("hot").alias("member_id"), (F.col("id") % 5).cast("int").alias("delinq_2yrs"),
                        F.lit(1.0).cast("float").alias("delinq_amnt"))
    details = ids.select(F.lit("hot").alias("member_id"), F.lit(3).alias("pub_rec"))
    repayments = ids.where("id % 2 = 0").select(F.col("id").cast("string").alias("loan_id"),
                                                F.lit(4.0).cast("float").alias("total_interest_received"))
    tables = {"customers": customers, "loans": loans, "repayments": repayments, "delinq": delinq, "details": details}
    homes = {"loans": fz.LOAN_COLS, "repayments": fz.REPAYMENT_COLS, "delinq": fz.DELINQ_COLS,
             "details": fz.DETAIL_COLS, "customers": fz.FACTORS["customers"]}
    return [df.withColumns({c: F.lit(None).cast("string") for c in homes[t] if c not in df.columns})
            for t, df in tables.items()]


def test_a_hot_member_never_forms_its_product(spark):
    n = 20_000
    factors = fz.factorise(*hot(spark, n), block=1000).cache()
    got = fz.totals(factors, MEASURES).first()
    assert got.n_rows == n ** 3 + 2  # 8e12 rows, and the two members without anything
    assert got.loan_amount == Decimal(2 * 1024) * n ** 3 and got.pub_rec == 3 * 1024 * n ** 3
    assert got.total_interest_received == Decimal(4 * 1024) * (n // 2) * n * n
    assert got.annual_income == Decimal(10 * 1024) * n ** 3 + 6 * 1024
    sizes = factors.where("member_id = 'hot'").select(*[F.size(f).alias(f) for f in fz.FACTORS])
    most = sizes.agg(*[F.max(f).alias(f) for f in fz.FACTORS]).first()
    assert most.loans < 1300 and sizes.count() == 20  # dealt over parts
    assert most.delinq == 5 and most.details == 1     # equal entries are held once
    plan = fz.totals(factors, MEASURES)._jdf.queryExecution().toString()
    assert "Join" not in plan.split("== Physical Plan ==")[1].split("InMemoryTableScan")[0]
    factors.unpersist()


def test_members_without_an_id_and_no_rows(spark):
    ts = hot(spark, 2)
    factors = fz.factorise(*ts)
    per = {r.member_id: r for r in fz.member_totals(factors).collect()}
    assert set(per) == {"hot", "cold", None} and per[None].n_rows == 1 and per["hot"].n_rows == 8
    view = consolidated_view(*ts)
    assert fz.expand(factors).exceptAll(view).count() == 0 and view.exceptAll(fz.expand(factors)).count() == 0
    none = fz.totals(fz.factorise(*[t.limit(0) for t in ts]), MEASURES).first()
    assert none.n_rows is None
