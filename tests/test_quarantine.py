"""NOT IN semantics, duplicate lists and the consolidated view's shape."""

from lendscope.operators import quarantine
from lendscope.operators.consolidate import VIEW_COLUMNS, consolidated_view


def _ids(df, col="k"):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is None, v))


def test_not_in_three_valued(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    one = spark.createDataFrame([(1,)], "v int")
    empty = spark.createDataFrame([], "v int")
    with_null = spark.createDataFrame([(1,), (None,)], "v int")
    assert _ids(quarantine.not_in(probe, one, "k", "v")) == [2]
    assert _ids(quarantine.not_in(probe, empty, "k", "v")) == [1, 2, None]
    assert _ids(quarantine.not_in(probe, with_null, "k", "v")) == []


def test_not_in_plan_avoids_null_aware_broadcast(spark):
    probe = spark.createDataFrame([(1,), (2,)], "k int")
    vals = spark.createDataFrame([(1,)], "v int")
    plan = quarantine.not_in(probe, vals, "k", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "isnull" not in plan.split("LeftAnti")[1].split("\n")[0].lower()


def test_duplicate_member_ids_union_distinct(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "member_id string")
    b = spark.createDataFrame([("x",), ("x",), ("z",), ("z",)], "member_id string")
    da, db = quarantine.duplicate_keys(a), quarantine.duplicate_keys(b)
    assert _ids(quarantine.duplicate_member_ids(da, db), "member_id") == ["x", "z"]


def test_drop_quarantined(spark):
    t = spark.createDataFrame([("x", 1), ("y", 2)], "member_id string, v int")
    q = spark.createDataFrame([("x",)], "member_id string")
    assert _ids(quarantine.drop_quarantined(t, q), "member_id") == ["y"]


def test_consolidated_view_fan_out(spark):
    cust = spark.createDataFrame([("m1",), ("m2",)], "member_id string")
    for c in ("emp_title", "emp_length", "home_ownership", "annual_income", "address_state", "address_zipcode",
              "address_country", "grade", "sub_grade", "verification_status", "total_high_credit_limit",
              "application_type", "join_annual_income", "verification_status_joint"):
        cust = cust.withColumn(c, cust.member_id.substr(1, 0))
    loans = spark.sql("""SELECT * FROM VALUES ('L1','m2'),('L2','m2') AS t(loan_id, member_id)""")
    for c in ("loan_amount", "funded_amount", "loan_term_years", "interest_rate", "monthly_installment",
              "issue_date", "loan_status", "loan_purpose"):
        loans = loans.withColumn(c, loans.loan_id.substr(1, 0))
    reps = spark.sql("""SELECT 'L1' AS loan_id, 1.0 AS total_principal_received, 1.0 AS total_interest_received,
                        1.0 AS total_late_fee_received, 'x' AS last_payment_date, 'y' AS next_payment_date""")
    delinq = spark.sql("SELECT 'm2' AS member_id, 1 AS delinq_2yrs, 1.0 AS delinq_amnt, 1 AS mths_since_last_delinq")
    details = spark.sql("""SELECT * FROM VALUES ('m2',0,0,0),('m2',1,0,0) AS
                           t(member_id, pub_rec, pub_rec_bankruptcies, inq_last_6mths)""")
    v = consolidated_view(cust, loans, reps, delinq, details)
    assert v.columns == VIEW_COLUMNS and len(VIEW_COLUMNS) == 35
    rows = v.collect()
    assert sum(r.member_id == "m1" for r in rows) == 1
    assert [r.loan_id for r in rows if r.member_id == "m1"] == [None]
    assert sum(r.member_id == "m2" for r in rows) == 4  # 2 loans x 2 details rows


def test_duplicate_counts_equals_union_of_lists(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "member_id string")
    b = spark.createDataFrame([("x",), ("x",), ("z",), ("z",), ("y",)], "member_id string")
    rows = sorted(tuple(r) for r in quarantine.duplicate_counts({"a": a, "b": b}).collect())
    assert rows == [("x", 2, 2), ("z", 0, 2)]
    ids = _ids(quarantine.quarantined_ids({"a": a, "b": b}), "member_id")
    union = _ids(quarantine.duplicate_member_ids(quarantine.duplicate_keys(a), quarantine.duplicate_keys(b)),
                 "member_id")
    assert ids == union == ["x", "z"]


def test_drop_quarantined_with_null_rules(spark):
    t = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "member_id string, v int")
    q = spark.createDataFrame([("x",)], "member_id string")
    q_null = spark.createDataFrame([("x",), (None,)], "member_id string")
    assert _ids(quarantine.drop_quarantined(t, q, keys_never_null=False), "v") == [3]
    assert _ids(quarantine.drop_quarantined(t, q_null, keys_never_null=False), "v") == []
    assert _ids(quarantine.drop_quarantined(t, q), "v") == [2, 3]  # plain anti join keeps the NULL key
