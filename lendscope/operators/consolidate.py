"""Consolidated borrower-loan view: customers left-joined to loans, repayments,
delinquency and public-record details.

Delinquency and details hang off the customer key, so a member with several
loans gets (loans x delinquency rows x details rows) output rows; that is the
view's definition and is kept. The score path never uses this view. The
joins are arranged so that AQE can split a hot member's partition in each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The view's columns by table.
CUSTOMER_COLS = [
    "member_id", "emp_title", "emp_length", "home_ownership", "annual_income", "address_state",
    "address_zipcode", "address_country", "grade", "sub_grade", "verification_status",
    "total_high_credit_limit", "application_type", "join_annual_income",
    "verification_status_joint",
]
LOAN_COLS = [
    "loan_amount", "funded_amount", "loan_term_years", "interest_rate", "monthly_installment",
    "issue_date", "loan_status", "loan_purpose",
]
REPAYMENT_COLS = [
    "total_principal_received", "total_interest_received", "total_late_fee_received",
    "last_payment_date", "next_payment_date",
]
DELINQ_COLS = ["delinq_2yrs", "delinq_amnt", "mths_since_last_delinq"]
DETAIL_COLS = ["pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"]

VIEW_COLUMNS = ["loan_id"] + CUSTOMER_COLS + LOAN_COLS + REPAYMENT_COLS + DELINQ_COLS + DETAIL_COLS


def left_join_splittable(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                         right_keys: DataFrame | None = None, partitioned: bool = False) -> DataFrame:
    """``left LEFT OUTER JOIN right ON left_key = right_key`` (``right_key`` dropped),
    written as the inner join plus the unmatched left rows padded with NULLs.

    Same rows as the outer join. The point is skew: AQE can split a skewed
    partition of a left outer join only on the left side, so a hot key whose
    rows sit on the right would be joined by one task; an inner join may be
    split on either side. The unmatched rows come from an anti join against the
    right side's distinct keys, which are pre-aggregated map-side.

    Cost: the two branches shuffle ``left`` on the key separately (Catalyst
    plans them differently, e.g. it pushes the anti join below a
    de-duplicating aggregate in ``left``) and the right side's keys are
    shuffled once more, in exchange for a join whose hot key AQE can split
    instead of one task processing it whole. Where the keys of ``right`` are at
    hand from a cheaper frame (its source before a join), pass them as ``right_keys``.
    With ``partitioned`` the result stays partitioned by the key for later joins,
    for a ``left`` that lies so in storage (then nothing can be split).
    """
    cond = F.col(left_key) == F.col(right_key)
    matched = left.join(right, cond, "inner").drop(right_key)
    keys = (right if right_keys is None else right_keys).select(right_key).distinct()
    pads = {c: F.lit(None).cast(t) for c, t in right.dtypes if c != right_key}
    unmatched = left.join(keys, cond, "left_anti").withColumns(pads)
    if not partitioned:
        return matched.unionByName(unmatched)
    # a union keeps its parts' partitioning by columns that are the parts' own
    part = lambda df: df.withColumnRenamed(left_key, "__by")
    return part(matched).unionByName(part(unmatched)).withColumnRenamed("__by", left_key)


def consolidated_view(customers: DataFrame, loans: DataFrame, repayments: DataFrame,
                      delinq: DataFrame, details: DataFrame, partitioned: bool = False) -> DataFrame:
    """The 35-column borrower-loan view (left outer joins from customers).

    Customers to loans uses :func:`left_join_splittable`: there a hot member's
    rows are on the right (its loans), which AQE cannot split in a left outer
    join. The later joins on ``member_id`` are plain left joins, because from
    then on the hot member's rows are on the left (customer x loan rows), the
    side AQE splits. The repayments meet the loans first, on ``loan_id``, while
    the rows lack the customer's columns: the only rows to shuffle by loan, and
    with ``partitioned`` (customers, delinquency and details read from tables
    bucketed by member) those of customers then stay where they are in every join.
    """
    c = customers.select(*CUSTOMER_COLS)
    l = loans.select("loan_id", F.col("member_id").alias("__l_member"), *LOAN_COLS)
    r = repayments.select(F.col("loan_id").alias("__r_loan"), *REPAYMENT_COLS)
    d = delinq.select(F.col("member_id").alias("__d_member"), *DELINQ_COLS)
    e = details.select(F.col("member_id").alias("__e_member"), *DETAIL_COLS)
    lent = l.join(r, F.col("loan_id") == F.col("__r_loan"), "left").drop("__r_loan")
    j = left_join_splittable(c, lent, "member_id", "__l_member", l.select("__l_member"), partitioned)
    j = j.join(d, F.col("member_id") == F.col("__d_member"), "left").drop("__d_member")
    j = j.join(e, F.col("member_id") == F.col("__e_member"), "left").drop("__e_member")
    return j.select(*VIEW_COLUMNS)
