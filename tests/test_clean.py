"""Cleaning steps on hand-made rows (expected values written from the rules)."""

import pytest

from lendscope.operators import clean

CUST_DDL = "member_id string, emp_length string, annual_income float"


def test_impute_emp_length_fills_floor_avg(spark):
    df = spark.createDataFrame(
        [("a", "10+ years", 1.0), ("b", "< 1 year", 1.0), ("c", "n/a", 1.0), ("d", None, 1.0)], CUST_DDL)
    out = {r.member_id: r.emp_length for r in clean.impute_emp_length(df).collect()}
    assert out == {"a": 10, "b": 1, "c": 5, "d": 5}
    assert clean.impute_emp_length(df).schema["emp_length"].dataType.simpleString() == "int"


def test_impute_emp_length_all_null_stays_null(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", "n/a", 1.0)], CUST_DDL)
    assert [r.emp_length for r in clean.impute_emp_length(df).collect()] == [None, None]


def test_avg_emp_length_is_bigint_floor(spark):
    df = spark.createDataFrame([("a", "10 years", 1.0), ("b", "1 year", 1.0), ("c", "2 years", 1.0)], CUST_DDL)
    r = clean.avg_emp_length(df)
    assert r.schema["avg_emp_length"].dataType.simpleString() == "bigint"
    assert r.first().avg_emp_length == 4


def test_strict_rename_raises_on_missing(spark):
    df = spark.createDataFrame([("a", 1.0)], "member_id string, tot_hi_cred_lim float")
    with pytest.raises(ValueError):
        clean.strict_rename(df, {"tot_hi_credit_lim": "total_high_credit_limit"})
    assert clean.strict_rename(df, {"tot_hi_cred_lim": "total_high_credit_limit"}).columns == \
        ["member_id", "total_high_credit_limit"]


def test_dedup_then_income_filter(spark):
    df = spark.createDataFrame([("a", "1 year", 1.0), ("a", "1 year", 1.0), ("b", "1 year", None)], CUST_DDL)
    out = clean.filter_not_null(clean.dedup_rows(df), "annual_income")
    assert [r.member_id for r in out.collect()] == ["a"]


def test_normalise_state(spark):
    df = spark.createDataFrame([("CA",), ("NATION_3",), (None,)], "address_state string")
    assert [r.address_state for r in clean.normalise_state(df).collect()] == ["CA", "NA", None]


def test_term_to_years_keeps_position(spark):
    df = spark.createDataFrame([("1", " 36 months", "x"), ("2", " 60 months", "y"), ("3", " 42 months", "z")],
                               "loan_id string, loan_term_months string, after string")
    out = clean.term_to_years(df)
    assert out.columns == ["loan_id", "loan_term_years", "after"]
    assert [r.loan_term_years for r in out.collect()] == [3, 5, 3]


def test_categorise_purpose(spark):
    df = spark.createDataFrame([("car",), ("pay my bills",), ("Medical",), ("medical",)], "loan_purpose string")
    assert [r.loan_purpose for r in clean.categorise_purpose(df).collect()] == ["car", "other", "other", "medical"]


def test_dropna_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x float, y string")
    assert [r.y for r in clean.dropna_subset(df, ["x"]).collect()] == ["a"]


def test_repair_total_payment(spark):
    ddl = ("total_principal_received float, total_interest_received float, total_late_fee_received float, "
           "total_payment_received float")
    df = spark.createDataFrame([(10.0, 2.0, 1.0, 0.0), (0.0, 2.0, 1.0, 0.0), (10.0, 2.0, 1.0, 7.0)], ddl)
    assert [r.total_payment_received for r in clean.repair_total_payment(df).collect()] == [13.0, 0.0, 7.0]


def test_nullify_zero_dates(spark):
    df = spark.createDataFrame([("0.0", "0"), ("Mar-2019", None)], "last_payment_date string, next_payment_date string")
    rows = clean.nullify_zero_dates(df).collect()
    assert [(r.last_payment_date, r.next_payment_date) for r in rows] == [(None, None), ("Mar-2019", None)]


def test_defaulter_counts_and_splits(spark):
    ddl = ("member_id string, delinq_2yrs float, delinq_amnt float, pub_rec float, pub_rec_bankruptcies float, "
           "inq_last_6mths float, total_rec_late_fee float, mths_since_last_delinq float, "
           "mths_since_last_record float")
    df = spark.createDataFrame([
        ("a", 1.9, 0.0, None, 0.0, 0.0, 0.0, None, None),
        ("b", None, 0.0, 0.0, 0.0, 0.0, 0.0, 12.7, None),
        ("c", 0.0, 0.0, 0.0, 0.0, 2.0, 0.0, None, None),
    ], ddl)
    d = clean.stamped_defaulters(df, "2024-01-01 00:00:00")
    filled = {r.member_id: (r.delinq_2yrs, r.pub_rec) for r in d.collect()}
    assert filled == {"a": (1, 0), "b": (0, 0), "c": (0, 0)}
    delinq = {r.member_id: r.mths_since_last_delinq for r in clean.delinquent_members(d).collect()}
    assert delinq == {"a": None, "b": 12}
    assert [r.member_id for r in clean.record_enquiry_members(d).collect()] == ["c"]
    assert clean.defaulter_details(d).columns == \
        ["member_id", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths", "ingest_date"]
