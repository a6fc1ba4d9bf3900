"""Schemas of the split and cleaned entity tables.

The split schemas are the fixed DDL the cleaning steps read their CSV input
with (positional binding); the table schemas are the columns the published
external tables declare.
"""

# Column lists and types of the entity tables (must match the
# analysed workload's declared schemas).
CUSTOMERS_RAW_DDL = (
    "member_id string, emp_title string, emp_length string, home_ownership string, "
    "annual_inc float, addr_state string, zip_code string, country string, grade string, "
    "sub_grade string, verification_status string, tot_hi_cred_lim float, "
    "application_type string, annual_inc_joint float, verification_status_joint string"
)
LOANS_RAW_DDL = (
    "loan_id string, member_id string, loan_amount float, funded_amount float, "
    "loan_term_months string, interest_rate float, monthly_installment float, "
    "issue_date string, loan_status string, loan_purpose string, loan_title string"
)
REPAYMENTS_RAW_DDL = (
    "loan_id string, total_principal_received float, total_interest_received float, "
    "total_late_fee_received float, total_payment_received float, last_payment_amount float, "
    "last_payment_date string, next_payment_date string"
)
DEFAULTERS_RAW_DDL = (
    "member_id string, delinq_2yrs float, delinq_amnt float, pub_rec float, "
    "pub_rec_bankruptcies float, inq_last_6mths float, total_rec_late_fee float, "
    "mths_since_last_delinq float, mths_since_last_record float"
)

CUSTOMERS_TABLE_DDL = (
    "member_id string, emp_title string, emp_length int, home_ownership string, "
    "annual_income float, address_state string, address_zipcode string, "
    "address_country string, grade string, sub_grade string, verification_status string, "
    "total_high_credit_limit float, application_type string, join_annual_income float, "
    "verification_status_joint string, ingest_date timestamp_ntz"
)
LOANS_TABLE_DDL = (
    "loan_id string, member_id string, loan_amount float, funded_amount float, "
    "loan_term_years int, interest_rate float, monthly_installment float, issue_date string, "
    "loan_status string, loan_purpose string, loan_title string, ingest_date timestamp_ntz"
)
REPAYMENTS_TABLE_DDL = REPAYMENTS_RAW_DDL + ", ingest_date timestamp_ntz"
DELINQ_TABLE_DDL = (
    "member_id string, delinq_2yrs int, delinq_amnt float, mths_since_last_delinq int"
)
DETAILS_TABLE_DDL = (
    "member_id string, pub_rec int, pub_rec_bankruptcies int, inq_last_6mths int"
)
SCORE_TABLE_DDL = (
    "member_id string, payment_history_pts float, defaulters_history_pts float, "
    "financial_health_pts float, loan_score float, loan_final_grade string"
)
