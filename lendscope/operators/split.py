"""Vertical split of the wide loan table into four entity frames.

Each split is a projection of one keyed scan, typed to the fixed DDL the
cleaning steps read with (float columns are 32-bit). Values are read as after a
CSV hop: strings are trimmed and blank ones are NULL, malformed numbers are
NULL. The member key is hashed before that, over the untouched values, and being
a digest needs no trimming: passed on as it is, it keeps the rows' partitioning by
key. Column pruning keeps each split's scan to its own columns plus the nine key columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendscope import schemas

_KEY = "name_sha2"


#: What a CSV writer trims: everything up to the space character.
_BLANKS = "".join(map(chr, range(33)))


def csv_value(c: Column, source_type: str, target_type: str) -> Column:
    """``c`` as a typed CSV reader would give it back."""
    if source_type == "string":
        # most cells need no trimming: their first and last characters tell
        outer = (c < F.lit("!")) | (F.right(c, F.lit(1)) < F.lit("!"))
        c = F.when(outer, F.nullif(F.btrim(c, F.lit(_BLANKS)), F.lit(""))).otherwise(c)
    return c if source_type == target_type else c.try_cast(target_type)


def _typed(df: DataFrame, pairs: list[tuple[str, object]], ddl: str) -> DataFrame:
    """Select ``pairs`` (target name, source column or Column) as values of the DDL types."""
    types = dict(part.strip().split()[:2] for part in ddl.split(","))
    have = dict(df.dtypes)
    out = []
    for name, src in pairs:
        c = csv_value(F.col(src), have[src], types[name]) if isinstance(src, str) else src.cast(types[name])
        out.append(c.alias(name))
    return df.select(*out)


def split_customers(keyed: DataFrame, country: str = "USA") -> DataFrame:
    pairs = [
        ("member_id", F.col(_KEY)), ("emp_title", "emp_title"), ("emp_length", "emp_length"),
        ("home_ownership", "home_ownership"), ("annual_inc", "annual_inc"),
        ("addr_state", "addr_state"), ("zip_code", "zip_code"), ("country", F.lit(country)),
        ("grade", "grade"), ("sub_grade", "sub_grade"),
        ("verification_status", "verification_status"), ("tot_hi_cred_lim", "tot_hi_cred_lim"),
        ("application_type", "application_type"), ("annual_inc_joint", "annual_inc_joint"),
        ("verification_status_joint", "verification_status_joint"),
    ]
    return _typed(keyed, pairs, schemas.CUSTOMERS_RAW_DDL)


def split_loans(keyed: DataFrame) -> DataFrame:
    pairs = [
        ("loan_id", "id"), ("member_id", F.col(_KEY)), ("loan_amount", "loan_amnt"),
        ("funded_amount", "funded_amnt"), ("loan_term_months", "term"),
        ("interest_rate", "int_rate"), ("monthly_installment", "installment"),
        ("issue_date", "issue_d"), ("loan_status", "loan_status"),
        ("loan_purpose", "purpose"), ("loan_title", "title"),
    ]
    return _typed(keyed, pairs, schemas.LOANS_RAW_DDL)


def split_repayments(keyed: DataFrame) -> DataFrame:
    pairs = [
        ("loan_id", "id"), ("total_principal_received", "total_rec_prncp"),
        ("total_interest_received", "total_rec_int"),
        ("total_late_fee_received", "total_rec_late_fee"),
        ("total_payment_received", "total_pymnt"), ("last_payment_amount", "last_pymnt_amnt"),
        ("last_payment_date", "last_pymnt_d"), ("next_payment_date", "next_pymnt_d"),
    ]
    return _typed(keyed, pairs, schemas.REPAYMENTS_RAW_DDL)


def split_defaulters(keyed: DataFrame) -> DataFrame:
    pairs = [
        ("member_id", F.col(_KEY)), ("delinq_2yrs", "delinq_2yrs"), ("delinq_amnt", "delinq_amnt"),
        ("pub_rec", "pub_rec"), ("pub_rec_bankruptcies", "pub_rec_bankruptcies"),
        ("inq_last_6mths", "inq_last_6mths"), ("total_rec_late_fee", "total_rec_late_fee"),
        ("mths_since_last_delinq", "mths_since_last_delinq"),
        ("mths_since_last_record", "mths_since_last_record"),
    ]
    return _typed(keyed, pairs, schemas.DEFAULTERS_RAW_DDL)


# Source-named projection of the loans split, as it sits in the wide table and
# in the split CSV header (the cleaning step binds it positionally).
LOAN_SOURCE_COLUMNS = [
    "id", _KEY, "loan_amnt", "funded_amnt", "term", "int_rate", "installment",
    "issue_d", "loan_status", "purpose", "title",
]


def split_loans_source(keyed: DataFrame) -> DataFrame:
    """The loans split with source column names (what the split CSV holds)."""
    return keyed.select(
        F.col("id").alias("loan_id"), F.col(_KEY).alias("member_id"),
        *[F.col(c) for c in LOAN_SOURCE_COLUMNS[2:]],
    )
