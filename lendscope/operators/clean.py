"""Cleaning of the four entity frames.

Each step is a function DataFrame -> DataFrame; the composite ``clean_*``
functions chain them in the workload's order. Scale notes:

* ``dropDuplicates()`` plans as a hash aggregate with a map-side partial, so a
  heavily repeated row collapses before the shuffle.
* The employment-length fill uses ``floor(avg(...))`` as a scalar subquery:
  one extra partial/final aggregate job whose result is inlined as a literal;
  nothing is collected through Python and no cross join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendscope.functions.text import (
    cap_state_code, digits_to_int, lit_timestamp, months_to_years, zero_sentinel_to_null,
)
from lendscope.rules import LOAN_PURPOSES, OTHER_PURPOSE

# Column renames and required columns of the analysed workload.
CUSTOMER_RENAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}

LOAN_REQUIRED = [
    "loan_amount", "funded_amount", "loan_term_months", "interest_rate",
    "monthly_installment", "issue_date", "loan_status", "loan_purpose",
]
REPAYMENT_REQUIRED = [
    "total_principal_received", "total_interest_received", "total_late_fee_received",
    "total_payment_received", "last_payment_amount",
]
DEFAULTER_COUNTS = ["delinq_2yrs", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"]


# --- generic steps -----------------------------------------------------------

def strict_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns, failing on a missing source column (a silent no-op
    rename would leave the target column absent and later read as NULL)."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}; have {df.columns}")
    return df.withColumnsRenamed(mapping)


def ingest_stamp(df: DataFrame, ingest_ts=None, name: str = "ingest_date") -> DataFrame:
    """Append the ingestion timestamp (fixed literal, or current_timestamp if None)."""
    return df.withColumns({name: lit_timestamp(ingest_ts)})


def with_lineage(read: DataFrame) -> DataFrame:
    """Append where each row of a file scan comes from, as the reader knows it:
    file, its modification time and the block's start. Taken from the scan's own
    metadata, so it costs no listing; call it on the scan itself."""
    m = F.col("_metadata")
    return read.withColumns({"source_file": m["file_path"], "source_modified": m["file_modification_time"],
                             "source_block_start": m["file_block_start"]})


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are equal in every column."""
    return df.dropDuplicates()


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def dropna_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with NULL (or NaN in float/double columns) in any listed column."""
    return df.dropna(how="any", subset=subset)


def floor_avg(df: DataFrame, column: str) -> Column:
    """``floor(avg(column))`` over ``df`` as a scalar-subquery Column (bigint; NULL if no values)."""
    return df.select(F.floor(F.avg(column)).alias(f"avg_{column}")).scalar()


# --- customers ---------------------------------------------------------------

def parse_emp_length(df: DataFrame) -> DataFrame:
    return df.withColumns({"emp_length": digits_to_int("emp_length")})


def impute_emp_length(df: DataFrame) -> DataFrame:
    """Parse emp_length to int, then fill NULLs with floor(avg) over the same rows."""
    parsed = parse_emp_length(df)
    fill = floor_avg(parsed, "emp_length").cast("int")
    return parsed.withColumns({"emp_length": F.coalesce(F.col("emp_length"), fill)})


def avg_emp_length(customers: DataFrame) -> DataFrame:
    """One row: the fill value used by ``impute_emp_length``."""
    parsed = parse_emp_length(customers)
    return parsed.select(F.floor(F.avg("emp_length")).alias("avg_emp_length"))


def normalise_state(df: DataFrame, column: str = "address_state") -> DataFrame:
    return df.withColumns({column: cap_state_code(column)})


def clean_customers(customers_raw: DataFrame, ingest_ts=None) -> DataFrame:
    """rename -> stamp -> dedup -> income not null -> emp_length int + fill -> state code."""
    df = strict_rename(customers_raw, CUSTOMER_RENAMES)
    df = ingest_stamp(df, ingest_ts)
    df = dedup_rows(df)
    df = filter_not_null(df, "annual_income")
    df = impute_emp_length(df)
    return normalise_state(df)


# --- loans -------------------------------------------------------------------

def term_to_years(df: DataFrame) -> DataFrame:
    """loan_term_months (' 36 months') -> loan_term_years (3), same position."""
    df = df.withColumns({"loan_term_months": months_to_years("loan_term_months")})
    return df.withColumnsRenamed({"loan_term_months": "loan_term_years"})


def categorise_purpose(df: DataFrame, lookup=LOAN_PURPOSES, other: str = OTHER_PURPOSE) -> DataFrame:
    c = F.col("loan_purpose")
    return df.withColumns({"loan_purpose": F.when(c.isin(list(lookup)), c).otherwise(F.lit(other))})


def loans_before_categories(loans_raw: DataFrame, ingest_ts=None) -> DataFrame:
    df = ingest_stamp(loans_raw, ingest_ts)
    df = dropna_subset(df, LOAN_REQUIRED)
    return term_to_years(df)


def clean_loans(loans_raw: DataFrame, ingest_ts=None, dedup: bool = False) -> DataFrame:
    """stamp -> dropna(8 columns) -> term in years -> purpose outside the list => 'other'.
    ``dedup`` (default: no, as in the flow) drops rows that are equal in every column first."""
    rows = dedup_rows(loans_raw) if dedup else loans_raw
    return categorise_purpose(loans_before_categories(rows, ingest_ts))


# --- repayments --------------------------------------------------------------

def repair_total_payment(df: DataFrame) -> DataFrame:
    """Principal received but zero total payment: total = principal + interest + late fee."""
    p, t = F.col("total_principal_received"), F.col("total_payment_received")
    fixed = p + F.col("total_interest_received") + F.col("total_late_fee_received")
    return df.withColumns({
        "total_payment_received": F.when((p != F.lit(0.0)) & (t == F.lit(0.0)), fixed).otherwise(t)
    })


def nullify_zero_dates(df: DataFrame, columns=("last_payment_date", "next_payment_date")) -> DataFrame:
    """Date strings that read as the number 0 ('0.0') become NULL."""
    return df.withColumns({c: zero_sentinel_to_null(c) for c in columns})


def clean_repayments(repayments_raw: DataFrame, ingest_ts=None, dedup: bool = False) -> DataFrame:
    df = ingest_stamp(dedup_rows(repayments_raw) if dedup else repayments_raw, ingest_ts)
    df = dropna_subset(df, REPAYMENT_REQUIRED)
    df = repair_total_payment(df)
    return nullify_zero_dates(df)


# --- defaulters --------------------------------------------------------------

def fill_defaulter_counts(defaulters_raw: DataFrame, columns=DEFAULTER_COUNTS) -> DataFrame:
    """Counters to int (truncating), NULL -> 0."""
    return defaulters_raw.withColumns(
        {c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in columns})


def stamped_defaulters(defaulters_raw: DataFrame, ingest_ts=None, dedup: bool = False) -> DataFrame:
    """With ``dedup`` a member that is repeated with equal values is one row, and so
    no longer a duplicate id for the quarantine."""
    rows = dedup_rows(defaulters_raw) if dedup else defaulters_raw
    return ingest_stamp(fill_defaulter_counts(rows), ingest_ts)


def delinquent_members(defaulters: DataFrame) -> DataFrame:
    """Members with a delinquency in two years or a months-since-delinquency value."""
    return defaulters.where(
        (F.col("delinq_2yrs") > 0) | (F.col("mths_since_last_delinq") > 0)
    ).select(
        "member_id", "delinq_2yrs", "delinq_amnt",
        F.col("mths_since_last_delinq").cast("int").alias("mths_since_last_delinq"),
        "ingest_date",
    )


def record_enquiry_members(defaulters: DataFrame) -> DataFrame:
    """Member ids with a public record, a bankruptcy or a recent enquiry."""
    return defaulters.where(
        (F.col("pub_rec") > 0) | (F.col("pub_rec_bankruptcies") > 0) | (F.col("inq_last_6mths") > 0)
    ).select("member_id")


def defaulter_details(defaulters: DataFrame) -> DataFrame:
    """Public-record and enquiry counters, one row per source row."""
    return defaulters.select(
        "member_id", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths", "ingest_date")
