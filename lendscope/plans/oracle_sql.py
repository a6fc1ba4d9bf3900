"""Independent DuckDB SQL for every checked query key.

Written from the survey's rule tables (points as tables looked up by range or
pattern), not generated from the Spark operators. Each key's SQL is a ``WITH`` chain over the pre-registered
tables (orders, customer, nation, lineitem), built from the named CTEs below;
only the CTEs a query needs are emitted, in dependency order.

DuckDB differences handled here: float*decimal stays float in DuckDB (cast
operands to DOUBLE where Spark computes in double); ``cast(x as int)``
rounds (use ``trunc`` first); ``regexp_replace`` needs the 'g' flag;
``floor(avg)`` is double (cast to BIGINT).
"""

from __future__ import annotations

TS = "TIMESTAMP '2024-01-01 00:00:00'"

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    _CTES[name] = (deps, sql)


def with_ctes(select: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{select}" if order else select


# --- wide table ----------------------------------------------------------------

_cte("li", (), """
SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS paid
FROM lineitem GROUP BY l_orderkey""")

_cte("ob", (), """
SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
       o_orderkey - CASE WHEN o_orderkey % 40 = 0 AND o_orderkey > 0 THEN 1 ELSE 0 END AS bno
FROM orders""")

_cte("raw_clean", ("li", "ob"), """
SELECT bno, o_orderkey,
  CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN bno % 101 = 0 THEN NULL ELSE concat('Borrower#', CAST(bno AS VARCHAR)) END AS emp_title,
  CASE bno % 13 WHEN 0 THEN 'n/a' WHEN 1 THEN '< 1 year' WHEN 2 THEN '10+ years' WHEN 3 THEN NULL
       ELSE concat(CAST(bno % 13 AS VARCHAR), ' years') END AS emp_length,
  CASE WHEN bno % 53 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'OWN'
       WHEN c_mktsegment = 'BUILDING' THEN 'RENT' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'MORTGAGE'
       WHEN c_mktsegment = 'FURNITURE' THEN 'ANY' ELSE 'OTHER' END AS home_ownership,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 10 AS DOUBLE) END AS annual_inc,
  concat(CAST(bno % 1000 AS VARCHAR), 'xx') AS zip_code,
  CASE WHEN bno % 31 = 0 THEN NULL WHEN bno % 29 = 0 THEN n_name ELSE substr(n_name, 1, 2) END AS addr_state,
  CASE WHEN bno % 97 = 0 THEN 'H' ELSE substr('ABCDEFG', CAST(bno % 7 AS INTEGER) + 1, 1) END AS grade,
  concat(CASE WHEN bno % 97 = 0 THEN 'H' ELSE substr('ABCDEFG', CAST(bno % 7 AS INTEGER) + 1, 1) END,
         CAST(bno % 5 + 1 AS VARCHAR)) AS sub_grade,
  CASE bno % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Not Verified' ELSE 'Source Verified' END AS verification_status,
  CASE bno % 9 WHEN 0 THEN NULL ELSE o_totalprice * (1 + (bno % 9) * (bno % 9)) / 2 END AS tot_hi_cred_lim,
  CASE bno % 10 WHEN 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
  CASE bno % 10 WHEN 0 THEN CAST(120000.0 AS DOUBLE) ELSE NULL END AS annual_inc_joint,
  CASE bno % 10 WHEN 0 THEN 'Not Verified' ELSE NULL END AS verification_status_joint,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_totalprice END AS loan_amnt,
  o_totalprice AS funded_amnt,
  CASE WHEN o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
  CAST(5 + o_orderkey % 20 AS DOUBLE) AS int_rate,
  o_totalprice / 36 AS installment,
  concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(extract(month FROM o_orderdate) AS INTEGER) * 3 - 2, 3),
         '-', CAST(extract(year FROM o_orderdate) AS VARCHAR)) AS issue_d,
  CASE o_orderkey % 8 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace Period'
       WHEN 3 THEN 'Late (16-30 days)' WHEN 4 THEN 'Late (31-120 days)' WHEN 5 THEN 'Charged Off'
       WHEN 6 THEN 'Default' ELSE 'Does not meet the credit policy. Status:Fully Paid' END AS loan_status,
  CASE o_orderkey % 6 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'car'
       WHEN 3 THEN 'wedding' WHEN 4 THEN 'pay my bills' ELSE 'Medical' END AS purpose,
  o_orderpriority AS title,
  coalesce(paid, CAST(0 AS DOUBLE)) / 2 AS total_rec_prncp,
  coalesce(paid, CAST(0 AS DOUBLE)) / 4 AS total_rec_int,
  CAST(o_orderkey % 4 AS DOUBLE) AS total_rec_late_fee,
  CASE WHEN o_orderkey % 50 = 1 THEN CAST(-5 AS DOUBLE) WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DOUBLE)
       ELSE coalesce(paid, CAST(0 AS DOUBLE)) END AS total_pymnt,
  CASE o_orderkey % 6 WHEN 0 THEN o_totalprice / 36 * 0.25 WHEN 1 THEN o_totalprice / 36 * 0.75
       WHEN 2 THEN o_totalprice / 36 WHEN 3 THEN o_totalprice / 36 * 1.25 WHEN 4 THEN o_totalprice / 36 * 2
       ELSE CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END END AS last_pymnt_amnt,
  CASE o_orderkey % 5 WHEN 0 THEN '0.0' WHEN 1 THEN NULL ELSE 'Mar-2019' END AS last_pymnt_d,
  CASE o_orderkey % 7 WHEN 0 THEN '0.0' WHEN 1 THEN NULL ELSE 'Apr-2019' END AS next_pymnt_d,
  CASE WHEN bno % 84 = 0 THEN CAST(0 AS DOUBLE) WHEN bno % 8 = 7 THEN NULL ELSE CAST(bno % 8 AS DOUBLE) END AS delinq_2yrs,
  CAST(bno % 100 AS DOUBLE) AS delinq_amnt,
  CASE bno % 8 WHEN 1 THEN NULL ELSE CAST(bno % 7 AS DOUBLE) END AS pub_rec,
  CASE WHEN bno % 84 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(bno % 9 AS DOUBLE) END AS pub_rec_bankruptcies,
  CASE WHEN bno % 84 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(bno % 11 AS DOUBLE) END AS inq_last_6mths,
  CASE WHEN bno % 3 = 0 THEN CAST(12 AS DOUBLE) ELSE NULL END AS mths_since_last_delinq,
  CASE WHEN bno % 4 = 0 THEN CAST(30 AS DOUBLE) ELSE NULL END AS mths_since_last_record
FROM ob
JOIN customer ON c_custkey = ob.bno % (SELECT COUNT(*) FROM customer)
JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN li ON l_orderkey = o_orderkey""")

# padded, blank and malformed cells; a borrower without any key value
_cte("raw_dirty", ("raw_clean",), r"""
SELECT * REPLACE (
  CASE WHEN bno % 17 = 1 THEN '  ' || emp_title || ' ' ELSE emp_title END AS emp_title,
  CASE bno % 19 WHEN 2 THEN home_ownership || ' ' WHEN 3 THEN '   ' ELSE home_ownership END AS home_ownership,
  CASE WHEN bno % 23 = 4 THEN ' ' || grade ELSE grade END AS grade,
  CASE WHEN bno % 23 = 4 THEN sub_grade || ' ' ELSE sub_grade END AS sub_grade,
  CASE bno % 59 WHEN 5 THEN 'n/a' WHEN 6 THEN ' ' WHEN 7 THEN ' ' || CAST(annual_inc AS VARCHAR) || ' '
       ELSE CAST(annual_inc AS VARCHAR) END AS annual_inc,
  CASE WHEN bno % 29 = 8 THEN chr(9) || verification_status ELSE verification_status END AS verification_status,
  CASE WHEN o_orderkey % 31 = 9 THEN ' ' || loan_status ELSE loan_status END AS loan_status,
  CASE WHEN o_orderkey % 31 = 10 THEN purpose || ' ' ELSE purpose END AS purpose,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE title END AS title)
FROM raw_clean""")

_cte("raw", ("raw_dirty",), """
SELECT * EXCLUDE (bno, o_orderkey) REPLACE (""" + ",\n  ".join(
    f"CASE WHEN bno % 503 <> 0 THEN {c} END AS {c}" for c in (
        "emp_title", "emp_length", "home_ownership", "annual_inc", "zip_code", "addr_state", "grade", "sub_grade",
        "verification_status")) + """)
FROM raw_dirty""")

_cte("keyed", ("raw",), """
SELECT *, sha256(concat_ws('||', emp_title, emp_length, home_ownership, annual_inc,
                          zip_code, addr_state, grade, sub_grade, verification_status)) AS name_sha2
FROM raw""")

# --- splits: values as read back from CSV ------------------------------------------

def _hop(*cols: str) -> str:
    """Trimmed strings, blank ones NULL."""
    out = []
    for c in cols:
        name, _, alias = c.partition(" AS ")
        out.append(f"nullif(trim({name}, chr(9) || ' '), '') AS {alias or name}")
    return ", ".join(out)


_cte("customers_raw", ("keyed",), f"""
SELECT name_sha2 AS member_id, {_hop('emp_title', 'emp_length', 'home_ownership', 'addr_state', 'zip_code', 'grade',
                                     'sub_grade', 'verification_status', 'application_type',
                                     'verification_status_joint')},
       TRY_CAST(trim(annual_inc) AS FLOAT) AS annual_inc, 'USA' AS country,
       CAST(tot_hi_cred_lim AS FLOAT) AS tot_hi_cred_lim, CAST(annual_inc_joint AS FLOAT) AS annual_inc_joint
FROM keyed""")

_cte("loans_raw", ("keyed",), f"""
SELECT id AS loan_id, name_sha2 AS member_id, CAST(loan_amnt AS FLOAT) AS loan_amount,
       CAST(funded_amnt AS FLOAT) AS funded_amount, CAST(int_rate AS FLOAT) AS interest_rate,
       CAST(installment AS FLOAT) AS monthly_installment,
       {_hop('term AS loan_term_months', 'issue_d AS issue_date', 'loan_status', 'purpose AS loan_purpose',
             'title AS loan_title')}
FROM keyed""")

_cte("repayments_raw", ("keyed",), f"""
SELECT id AS loan_id, CAST(total_rec_prncp AS FLOAT) AS total_principal_received,
       CAST(total_rec_int AS FLOAT) AS total_interest_received,
       CAST(total_rec_late_fee AS FLOAT) AS total_late_fee_received,
       CAST(total_pymnt AS FLOAT) AS total_payment_received,
       CAST(last_pymnt_amnt AS FLOAT) AS last_payment_amount,
       {_hop('last_pymnt_d AS last_payment_date', 'next_pymnt_d AS next_payment_date')}
FROM keyed""")

_cte("defaulters_raw", ("keyed",), """
SELECT name_sha2 AS member_id, CAST(delinq_2yrs AS FLOAT) AS delinq_2yrs, CAST(delinq_amnt AS FLOAT) AS delinq_amnt,
       CAST(pub_rec AS FLOAT) AS pub_rec, CAST(pub_rec_bankruptcies AS FLOAT) AS pub_rec_bankruptcies,
       CAST(inq_last_6mths AS FLOAT) AS inq_last_6mths, CAST(total_rec_late_fee AS FLOAT) AS total_rec_late_fee,
       CAST(mths_since_last_delinq AS FLOAT) AS mths_since_last_delinq,
       CAST(mths_since_last_record AS FLOAT) AS mths_since_last_record
FROM keyed""")

# --- customers -----------------------------------------------------------------------

_cte("cust_renamed", ("customers_raw",), f"""
SELECT DISTINCT member_id, emp_title, emp_length, home_ownership, annual_inc AS annual_income,
       addr_state AS address_state, zip_code AS address_zipcode, country AS address_country, grade, sub_grade,
       verification_status, tot_hi_cred_lim AS total_high_credit_limit, application_type,
       annual_inc_joint AS join_annual_income, verification_status_joint, {TS} AS ingest_date
FROM customers_raw""")

_cte("cust_income", ("cust_renamed",), "SELECT * FROM cust_renamed WHERE annual_income IS NOT NULL")

_cte("cust_parsed", ("cust_income",), r"""
SELECT * REPLACE (TRY_CAST(regexp_replace(emp_length, '\D', '', 'g') AS INTEGER) AS emp_length)
FROM cust_income""")

_cte("cust_avg", ("cust_parsed",), """
SELECT CAST(floor(avg(emp_length)) AS BIGINT) AS avg_emp_length FROM cust_parsed""")

_cte("cust_filled", ("cust_parsed", "cust_avg"), """
SELECT * REPLACE (coalesce(emp_length, CAST((SELECT avg_emp_length FROM cust_avg) AS INTEGER)) AS emp_length)
FROM cust_parsed""")

_cte("customers_clean", ("cust_filled",), """
SELECT * REPLACE (CASE WHEN length(address_state) > 2 THEN 'NA' ELSE address_state END AS address_state)
FROM cust_filled""")

# --- loans -------------------------------------------------------------------------------

_LOANS_NOT_NULL = """loan_amount IS NOT NULL AND NOT isnan(loan_amount)
  AND funded_amount IS NOT NULL AND NOT isnan(funded_amount)
  AND loan_term_months IS NOT NULL
  AND interest_rate IS NOT NULL AND NOT isnan(interest_rate)
  AND monthly_installment IS NOT NULL AND NOT isnan(monthly_installment)
  AND issue_date IS NOT NULL AND loan_status IS NOT NULL AND loan_purpose IS NOT NULL"""

_cte("loans_na0", ("loans_raw",), f"SELECT * FROM loans_raw WHERE {_LOANS_NOT_NULL}")
_cte("loans_na", ("loans_na0",), f"SELECT *, {TS} AS ingest_date FROM loans_na0")

_TERM_YEARS = ("CAST(trunc(TRY_CAST(regexp_replace(loan_term_months, ' months', '', 'g') AS INTEGER) / 12) "
               "AS INTEGER) AS loan_term_years")
_PURPOSE = """CASE WHEN loan_purpose IN ('debt_consolidation', 'credit_card', 'home_improvement', 'other',
  'major_purchase', 'medical', 'small_business', 'car', 'vacation', 'moving', 'house', 'wedding',
  'renewable_energy', 'educational') THEN loan_purpose ELSE 'other' END AS loan_purpose"""

_cte("loans_term", ("loans_na",), f"""
SELECT loan_id, member_id, loan_amount, funded_amount, {_TERM_YEARS}, interest_rate, monthly_installment,
       issue_date, loan_status, loan_purpose, loan_title, ingest_date
FROM loans_na""")

_cte("loans_clean", ("loans_term",), f"SELECT * REPLACE ({_PURPOSE}) FROM loans_term")

# --- repayments --------------------------------------------------------------------------

_REP_NOT_NULL = """total_principal_received IS NOT NULL AND NOT isnan(total_principal_received)
  AND total_interest_received IS NOT NULL AND NOT isnan(total_interest_received)
  AND total_late_fee_received IS NOT NULL AND NOT isnan(total_late_fee_received)
  AND total_payment_received IS NOT NULL AND NOT isnan(total_payment_received)
  AND last_payment_amount IS NOT NULL AND NOT isnan(last_payment_amount)"""
_REPAIR = """CASE WHEN total_principal_received <> 0.0 AND total_payment_received = 0.0
  THEN total_principal_received + total_interest_received + total_late_fee_received
  ELSE total_payment_received END AS total_payment_received"""
_ZERO_DATES = """CASE WHEN TRY_CAST(last_payment_date AS DOUBLE) = 0.0 THEN NULL ELSE last_payment_date END
  AS last_payment_date,
  CASE WHEN TRY_CAST(next_payment_date AS DOUBLE) = 0.0 THEN NULL ELSE next_payment_date END
  AS next_payment_date"""

_cte("rep_na", ("repayments_raw",), f"SELECT *, {TS} AS ingest_date FROM repayments_raw WHERE {_REP_NOT_NULL}")
_cte("rep_fixed", ("rep_na",), f"SELECT * REPLACE ({_REPAIR}) FROM rep_na")
_cte("repayments_clean", ("rep_fixed",), f"SELECT * REPLACE ({_ZERO_DATES}) FROM rep_fixed")

# --- defaulters --------------------------------------------------------------------------

_cte("def_counts", ("defaulters_raw",), """
SELECT member_id, coalesce(CAST(trunc(delinq_2yrs) AS INTEGER), 0) AS delinq_2yrs, delinq_amnt,
       coalesce(CAST(trunc(pub_rec) AS INTEGER), 0) AS pub_rec,
       coalesce(CAST(trunc(pub_rec_bankruptcies) AS INTEGER), 0) AS pub_rec_bankruptcies,
       coalesce(CAST(trunc(inq_last_6mths) AS INTEGER), 0) AS inq_last_6mths,
       total_rec_late_fee, mths_since_last_delinq, mths_since_last_record
FROM defaulters_raw""")
_cte("def_filled", ("def_counts",), f"SELECT *, {TS} AS ingest_date FROM def_counts")
_cte("delinq", ("def_filled",), """
SELECT member_id, delinq_2yrs, delinq_amnt, CAST(trunc(mths_since_last_delinq) AS INTEGER) AS mths_since_last_delinq,
       ingest_date
FROM def_filled WHERE delinq_2yrs > 0 OR mths_since_last_delinq > 0""")
_cte("records_enq", ("def_filled",), """
SELECT member_id FROM def_filled WHERE pub_rec > 0.0 OR pub_rec_bankruptcies > 0.0 OR inq_last_6mths > 0.0""")
_cte("details", ("def_filled",), """
SELECT member_id, pub_rec, pub_rec_bankruptcies, inq_last_6mths, ingest_date FROM def_filled""")
_cte("delinq_t", ("delinq",), "SELECT member_id, delinq_2yrs, delinq_amnt, mths_since_last_delinq FROM delinq")
_cte("details_t", ("details",), "SELECT member_id, pub_rec, pub_rec_bankruptcies, inq_last_6mths FROM details")

# --- quarantine --------------------------------------------------------------------------

for _name, _src in (("dup_customers", "customers_clean"), ("dup_delinq", "delinq_t"), ("dup_details", "details_t")):
    _cte(_name, (_src,), f"SELECT member_id FROM {_src} GROUP BY member_id HAVING count(*) > 1")

_cte("dup_ids", ("dup_customers", "dup_delinq", "dup_details"),
     "SELECT * FROM dup_customers UNION SELECT * FROM dup_delinq UNION SELECT * FROM dup_details")

for _name, _src in (("customers_c", "customers_clean"), ("delinq_c", "delinq_t"), ("details_c", "details_t"),
                    ("loans_c", "loans_clean")):
    _cte(_name, (_src, "dup_ids"), f"SELECT * FROM {_src} ANTI JOIN dup_ids USING (member_id)")

# --- consolidated view: every customer with what is known by member or by loan --------------

_cte("consolidated", ("customers_clean", "loans_clean", "repayments_clean", "delinq_t", "details_t"), """
WITH paid AS (
  SELECT loan_id, total_principal_received, total_interest_received, total_late_fee_received, last_payment_date,
         next_payment_date
  FROM repayments_clean),
lent AS (SELECT * EXCLUDE (loan_title, ingest_date) FROM loans_clean LEFT JOIN paid USING (loan_id)),
trouble AS (SELECT * FROM delinq_t FULL JOIN details_t USING (member_id))
SELECT * EXCLUDE (ingest_date)
FROM customers_clean LEFT JOIN lent USING (member_id) LEFT JOIN trouble USING (member_id)""")

# --- score: rule tables, looked up by range or pattern --------------------------------------

# Points by name; the queries under other rules replace this table only.
DEFAULT_POINTS = {"unacceptable": 0, "very_bad": 100, "bad": 250, "good": 500, "very_good": 650, "excellent": 800,
                  "grade_f": 750, "grade_e": 1000, "grade_d": 1500, "grade_c": 2000, "grade_b": 2500}


def _score_ctes(tag: str, p: dict[str, int], delinq: str = "JOIN") -> None:
    """The score's rule tables and steps under points ``p``; names end in ``tag``."""
    # ratio of funded amount to credit limit: (above, up to]
    _cte(f"limit_band{tag}", (), f"""
SELECT * FROM (VALUES (NULL, 0.10, {p['excellent']}), (0.10, 0.20, {p['very_good']}), (0.20, 0.30, {p['good']}),
  (0.30, 0.50, {p['bad']}), (0.50, 0.70, {p['very_bad']}), (0.70, NULL, {p['unacceptable']})) AS t(lo, hi, pts)""")
    # counters: [from, to]
    _cte(f"count_band{tag}", (), f"""
SELECT * FROM (VALUES (0, 0, {p['excellent']}), (1, 2, {p['bad']}), (3, 5, {p['very_bad']})) AS t(lo, hi, pts)""")
    _cte(f"status_rule{tag}", (), f"""
SELECT * FROM (VALUES (1, 'fully paid', {p['excellent']}), (2, 'current', {p['good']}),
  (3, 'in grace period', {p['bad']}), (4, 'late (16-30 days)', {p['very_bad']}),
  (5, 'late (31-120 days)', {p['very_bad']})) AS t(rank, part, pts)""")
    _cte(f"home_rule{tag}", (), f"""
SELECT * FROM (VALUES (1, 'own', {p['excellent']}), (2, 'rent', {p['good']}), (3, 'mortgage', {p['bad']}),
  (4, 'any', {p['very_bad']})) AS t(rank, ending, pts)""")
    _cte(f"grade_rule{tag}", (), f"""
SELECT g.grade, g.grade || CAST(f.n AS VARCHAR) AS sub_grade, g.base * f.factor AS pts
FROM (VALUES ('A', {p['excellent']}), ('B', {p['very_good']}), ('C', {p['good']}), ('D', {p['bad']}),
             ('E', {p['very_bad']})) AS g(grade, base)
CROSS JOIN (VALUES (1, 1.00), (2, 0.95), (3, 0.90), (4, 0.85), (5, 0.80)) AS f(n, factor)""")
    _cte(f"letter_band{tag}", (), f"""
SELECT * FROM (VALUES ({p['grade_b']}, NULL, 'A'), ({p['grade_c']}, {p['grade_b']}, 'B'),
  ({p['grade_d']}, {p['grade_c']}, 'C'), ({p['grade_e']}, {p['grade_d']}, 'D'),
  ({p['grade_f']}, {p['grade_e']}, 'E'), (NULL, {p['grade_f']}, 'F')) AS t(above, upto, letter)""")

    _cte(f"payment_history{tag}", ("repayments_clean", "loans_c"), f"""
WITH amounts AS (
  SELECT member_id, loan_id, CAST(last_payment_amount AS DOUBLE) AS paid, CAST(monthly_installment AS DOUBLE) AS due,
         CAST(total_payment_received AS DOUBLE) AS total, CAST(funded_amount AS DOUBLE) / 2 AS half
  FROM loans_c JOIN repayments_clean USING (loan_id))
SELECT member_id,
  CASE sign(paid - due) WHEN -1 THEN {p['very_bad']} WHEN 0 THEN {p['good']}
       ELSE if(paid > due * 1.5, {p['excellent']}, {p['very_good']}) END AS last_payment_pts,
  CASE WHEN total >= half THEN {p['very_good']} WHEN coalesce(total, 0) = 0 THEN {p['unacceptable']}
       WHEN total > 0 THEN {p['good']} END AS total_payment_pts
FROM amounts""")
    banded = lambda col, more: (
        f"coalesce((SELECT pts FROM count_band{tag} WHERE {col} BETWEEN lo AND hi), "
        f"if(coalesce({col}, 6) > 5, {more}, NULL))")
    _cte(f"ldh{tag}", (f"payment_history{tag}", "details_c", "delinq_c", f"count_band{tag}"), f"""
SELECT * EXCLUDE (delinq_2yrs, delinq_amnt, mths_since_last_delinq, pub_rec, pub_rec_bankruptcies, inq_last_6mths),
  {banded('delinq_2yrs', p['grade_f'])} AS delinq_pts, {banded('pub_rec', p['very_bad'])} AS public_records_pts,
  {banded('pub_rec_bankruptcies', p['very_bad'])} AS public_bankruptcies_pts,
  {banded('inq_last_6mths', p['unacceptable'])} AS enq_pts
FROM payment_history{tag} JOIN details_c USING (member_id) {delinq} delinq_c USING (member_id)""")
    _cte(f"fh{tag}", (f"ldh{tag}", "loans_c", "customers_c", f"limit_band{tag}", f"status_rule{tag}",
                      f"home_rule{tag}", f"grade_rule{tag}"), f"""
SELECT h.*, {status_pts('loan_status', p, tag)} AS loan_status_pts, {home_pts('home_ownership', p, tag)} AS home_pts,
  {limit_pts('funded_amount', 'total_high_credit_limit', p, tag)} AS credit_limit_pts,
  {grade_pts('c.grade', 'c.sub_grade', p, tag)} AS grade_pts
FROM ldh{tag} h JOIN loans_c USING (member_id) JOIN customers_c c USING (member_id)""")
    _cte(f"scored{tag}", (f"fh{tag}",), f"""
WITH groups AS (
  SELECT member_id, 0.20 * (last_payment_pts + total_payment_pts) AS payment_history_pts,
         0.45 * (delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) AS defaulters_history_pts,
         0.35 * (loan_status_pts + home_pts + credit_limit_pts + grade_pts) AS financial_health_pts
  FROM fh{tag})
SELECT *, payment_history_pts + defaulters_history_pts + financial_health_pts AS loan_score FROM groups""")
    _cte(f"graded{tag}", (f"scored{tag}", f"letter_band{tag}"), f"""
SELECT member_id, {_FLOAT_SCORES}, letter AS loan_final_grade
FROM scored{tag} LEFT JOIN letter_band{tag}
  ON loan_score > coalesce(above, loan_score - 1) AND loan_score <= coalesce(upto, loan_score)""")


def status_pts(col: str, p: dict, tag: str = "") -> str:
    return (f"coalesce((SELECT arg_min(pts, rank) FROM status_rule{tag} WHERE contains(lower({col}), part)), "
            f"{p['unacceptable']})")


def home_pts(col: str, p: dict, tag: str = "") -> str:
    return (f"if({col} IS NULL, {p['very_bad']}, "
            f"(SELECT arg_min(pts, rank) FROM home_rule{tag} WHERE ends_with(lower({col}), ending)))")


def limit_pts(funded: str, limit: str, p: dict, tag: str = "") -> str:
    f, most = f"CAST({funded} AS DOUBLE)", f"CAST({limit} AS DOUBLE)"
    return (f"coalesce((SELECT max(pts) FROM limit_band{tag} WHERE (lo IS NULL OR {f} > {most} * lo) "
            f"AND (hi IS NULL OR {f} <= {most} * hi)), {p['unacceptable']})")


def grade_pts(grade: str, sub_grade: str, p: dict, tag: str = "") -> str:
    return (f"coalesce((SELECT r.pts FROM grade_rule{tag} r WHERE r.grade = {grade} AND r.sub_grade = {sub_grade}), "
            f"if({grade} IN ('F', 'G'), {p['unacceptable']}, NULL))")


_FLOAT_SCORES = ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in (
    "payment_history_pts", "defaulters_history_pts", "financial_health_pts", "loan_score"))

_score_ctes("", DEFAULT_POINTS)
_score_ctes("_left", DEFAULT_POINTS, "LEFT JOIN")
# the parameters that the query of that name sets: excellent 900, grade B above 2100 (C), F up to 700
_score_ctes("_conf", DEFAULT_POINTS | {"excellent": 900, "grade_c": 2100, "grade_f": 700})


# --- per-key SQL ---------------------------------------------------------------------------------

def _all(cte: str) -> str:
    return with_ctes(f"SELECT * FROM {cte}", cte)


_QUALITY = """
SELECT 'loans' AS table_name, 'rows' AS metric, count(*) AS value FROM loans_raw
UNION ALL SELECT 'loans', 'null_loan_amount', count(*) FILTER (WHERE loan_amount IS NULL) FROM loans_raw
UNION ALL SELECT 'loans_repayments', 'rows', count(*) FROM repayments_raw
UNION ALL SELECT 'loans_repayments', 'null_principal',
  count(*) FILTER (WHERE total_principal_received IS NULL) FROM repayments_raw
UNION ALL SELECT 'loans_repayments', 'zero_payment_nonzero_principal',
  count(*) FILTER (WHERE total_payment_received = 0.0 AND total_principal_received <> 0.0) FROM repayments_raw
UNION ALL SELECT 'loans_defaulters', 'rows', count(*) FROM def_filled
UNION ALL SELECT 'loans_defaulters', 'delinquent',
  count(*) FILTER (WHERE delinq_2yrs > 0 OR mths_since_last_delinq > 0) FROM def_filled
UNION ALL SELECT 'loans_defaulters', 'records_enq',
  count(*) FILTER (WHERE pub_rec > 0 OR pub_rec_bankruptcies > 0 OR inq_last_6mths > 0) FROM def_filled
UNION ALL SELECT 'duplicate_member_ids', 'in_customers', count(*) FROM dup_customers
UNION ALL SELECT 'duplicate_member_ids', 'in_loans_defaulters_delinq', count(*) FROM dup_delinq
UNION ALL SELECT 'duplicate_member_ids', 'in_loans_defaulters_details', count(*) FROM dup_details
UNION ALL SELECT 'duplicate_member_ids', 'rows', count(*) FROM dup_ids"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["member_key"] = with_ctes("SELECT id, name_sha2 AS member_id FROM keyed", "keyed")
    for k, c in (("split_customers", "customers_raw"), ("split_loans", "loans_raw"),
                 ("split_repayments", "repayments_raw"), ("split_defaulters", "defaulters_raw")):
        q[k] = _all(c)

    q["clean_customers"] = _all("customers_clean")
    q["avg_emp_length"] = _all("cust_avg")
    q["impute_emp_length"] = _all("cust_filled")
    q["normalise_state"] = with_ctes(
        "SELECT * REPLACE (CASE WHEN length(address_state) > 2 THEN 'NA' ELSE address_state END "
        "AS address_state) FROM cust_renamed", "cust_renamed")
    q["dedup_rows"] = with_ctes("SELECT DISTINCT * FROM customers_raw", "customers_raw")
    q["filter_not_null"] = with_ctes("SELECT * FROM customers_raw WHERE annual_inc IS NOT NULL", "customers_raw")
    q["clean_loans"] = _all("loans_clean")
    q["dropna_subset"] = _all("loans_na0")
    q["term_to_years"] = with_ctes(
        f"SELECT loan_id, member_id, loan_amount, funded_amount, {_TERM_YEARS}, interest_rate, "
        "monthly_installment, issue_date, loan_status, loan_purpose, loan_title FROM loans_raw", "loans_raw")
    q["categorise_purpose"] = with_ctes(f"SELECT * REPLACE ({_PURPOSE}) FROM loans_raw", "loans_raw")
    q["purpose_frequency"] = with_ctes(
        "SELECT loan_purpose, count(*) AS total_count FROM loans_term GROUP BY loan_purpose", "loans_term")
    q["clean_repayments"] = _all("repayments_clean")
    q["repair_total_payment"] = with_ctes(f"SELECT * REPLACE ({_REPAIR}) FROM repayments_raw", "repayments_raw")
    q["nullify_zero_dates"] = with_ctes(f"SELECT * REPLACE ({_ZERO_DATES}) FROM repayments_raw", "repayments_raw")
    q["fill_defaulter_counts"] = _all("def_counts")
    q["delinquent_members"] = _all("delinq")
    q["record_enquiry_members"] = _all("records_enq")
    q["defaulter_details"] = _all("details")

    q["profile_nulls"] = with_ctes("""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE annual_income IS NULL) AS n_null_income,
       count(*) FILTER (WHERE emp_length IS NULL) AS n_null_emp_length,
       count(*) FILTER (WHERE address_state IS NULL) AS n_null_state,
       count(*) FILTER (WHERE address_state LIKE 'NA') AS n_state_na,
       count(*) FILTER (WHERE address_state NOT LIKE 'NA') AS n_state_not_na
FROM customers_clean""", "customers_clean")
    q["profile_state_length"] = with_ctes(
        "SELECT count(address_state) AS n_long_states FROM cust_filled WHERE length(address_state) > 2",
        "cust_filled")
    q["quality_counts"] = with_ctes(_QUALITY, "loans_raw", "repayments_raw", "def_filled", "dup_ids")
    q["top_members_by_count"] = with_ctes(
        "SELECT member_id, count(*) AS totalCount FROM details_t GROUP BY member_id "
        "ORDER BY totalCount DESC, member_id LIMIT 10", "details_t")
    q["top_clean_members_by_count"] = with_ctes(
        "SELECT member_id, count(*) AS totalCount FROM customers_c GROUP BY member_id "
        "ORDER BY totalCount DESC, member_id LIMIT 10", "customers_c")
    q["counter_frequency"] = with_ctes(
        "SELECT delinq_2yrs, count(*) AS totalCount FROM def_filled GROUP BY delinq_2yrs", "def_filled")
    q["key_frequency"] = with_ctes(
        "SELECT name_sha2, count(*) AS total_cnt FROM keyed GROUP BY name_sha2 HAVING count(*) > 1", "keyed")
    q["count_distinct_keys"] = with_ctes(
        "SELECT count(DISTINCT name_sha2) AS n_distinct_keys FROM keyed", "keyed")
    q["lookup_member"] = with_ctes("SELECT * FROM keyed WHERE name_sha2 LIKE 'e3b0c44298fc1c149%'", "keyed")

    q["lookup_duplicate_member"] = with_ctes(
        "SELECT * FROM details_t WHERE member_id = (SELECT min(member_id) FROM dup_ids)", "details_t", "dup_ids")
    q["duplicate_keys_customers"] = _all("dup_customers")
    q["duplicate_keys_delinq"] = _all("dup_delinq")
    q["duplicate_keys_details"] = _all("dup_details")
    q["duplicate_member_ids"] = _all("dup_ids")
    q["quarantine_filter_customers"] = _all("customers_c")
    q["quarantine_filter_delinq"] = _all("delinq_c")
    q["quarantine_filter_details"] = _all("details_c")
    q["not_in_null_semantics"] = with_ctes(
        "SELECT * FROM customers_raw WHERE addr_state NOT IN (SELECT n_name FROM nation)", "customers_raw")

    q["consolidated_view"] = _all("consolidated")
    q["consolidated_snapshot"] = _all("consolidated")
    q["consolidated_view_sql"] = _all("consolidated")
    q["not_in_null_list"] = with_ctes(
        "SELECT * FROM customers_raw WHERE addr_state NOT IN (SELECT left(n_name, 2) FROM nation "
        "UNION ALL SELECT NULL)", "customers_raw")
    q["not_in_empty_list"] = with_ctes(
        "SELECT * FROM customers_raw WHERE addr_state NOT IN (SELECT n_name FROM nation WHERE n_name IS NULL)",
        "customers_raw")
    q["not_in_states"] = with_ctes(
        "SELECT * FROM customers_raw WHERE addr_state NOT IN (SELECT left(n_name, 2) FROM nation "
        "UNION ALL SELECT 'NA')", "customers_raw")
    for key, src in (("top_customers_by_count", "customers_clean"), ("top_delinq_by_count", "delinq_t")):
        q[key] = with_ctes(f"SELECT member_id, count(*) AS totalCount FROM {src} GROUP BY member_id "
                           "ORDER BY totalCount DESC, member_id LIMIT 10", src)
    q["lookup_duplicate_customer"] = with_ctes(
        "SELECT * FROM customers_clean WHERE member_id = (SELECT min(member_id) FROM dup_customers)",
        "customers_clean", "dup_customers")
    q["lookup_duplicate_delinq"] = with_ctes(
        "SELECT * FROM delinq_t WHERE member_id = (SELECT min(member_id) FROM dup_delinq)", "delinq_t", "dup_delinq")
    q["database_introspection"] = with_ctes("""
SELECT unnest(['Namespace Name', 'Location']) AS info_name, true AS names_database, true AS listed,
       5::BIGINT AS n_tables, (SELECT count(*) FROM customers_clean) + (SELECT count(*) FROM loans_clean)
       + (SELECT count(*) FROM repayments_clean) + (SELECT count(*) FROM delinq_t) + (SELECT count(*) FROM details_t)
       AS n_rows""", "customers_clean", "loans_clean", "repayments_clean", "delinq_t", "details_t")

    q["score_payment_history"] = _all("payment_history")
    q["score_defaulter_pts"] = _all("ldh")
    p = DEFAULT_POINTS
    q["status_points"] = with_ctes(
        f"SELECT loan_id, member_id, loan_status, {status_pts('loan_status', p)} AS loan_status_pts FROM loans_clean",
        "loans_clean", "status_rule")
    q["home_points"] = with_ctes(
        f"SELECT member_id, home_ownership, {home_pts('home_ownership', p)} AS home_pts FROM customers_clean",
        "customers_clean", "home_rule")
    q["credit_limit_points"] = with_ctes(f"""
SELECT loan_id, member_id, funded_amount, total_high_credit_limit,
       {limit_pts('funded_amount', 'total_high_credit_limit', p)} AS credit_limit_pts
FROM loans_c JOIN customers_c USING (member_id)""", "loans_c", "customers_c", "limit_band")
    q["grade_points"] = with_ctes(
        f"SELECT a.member_id, a.grade, a.sub_grade, CAST({grade_pts('a.grade', 'a.sub_grade', p)} AS DOUBLE) "
        "AS grade_pts FROM customers_clean a", "customers_clean", "grade_rule")
    q["score_with_conf_rules"] = _all("graded_conf")
    q["score_financial_health"] = with_ctes(
        "SELECT * REPLACE (CAST(grade_pts AS DOUBLE) AS grade_pts) FROM fh", "fh")
    q["loan_score"] = with_ctes(f"SELECT member_id, {_FLOAT_SCORES} FROM scored", "scored")
    q["loan_score_grades"] = _all("graded")

    # io round trips compare against the SQL of what was written
    q["scan_csv_inferred"] = _all("dup_ids")
    q["sink_csv_single_file"] = _all("dup_ids")
    q["scan_csv_schema"] = _all("loans_raw")
    q["scan_csv_strings"] = with_ctes(
        f"SELECT id AS loan_id, name_sha2 AS member_id, {_hop('term', 'issue_d', 'loan_status', 'purpose', 'title', 'last_pymnt_d', 'next_pymnt_d')} "
        "FROM keyed", "keyed")
    q["sink_csv_roundtrip"] = _all("customers_raw")
    q["sink_parquet_roundtrip"] = _all("loans_clean")
    q["external_table_roundtrip"] = _all("customers_clean")
    q["scan_table"] = _all("graded")
    q["scan_temp_view"] = _all("customers_raw")
    q["catalog_tables"] = with_ctes("""
SELECT 'customers' AS tableName, false AS isTemporary, count(*) AS n_rows FROM customers_clean
UNION ALL SELECT 'loans', false, count(*) FROM loans_clean
UNION ALL SELECT 'loans_repayments', false, count(*) FROM repayments_clean
UNION ALL SELECT 'loans_defaulters_delinq', false, count(*) FROM delinq_t
UNION ALL SELECT 'loans_defaulters_details', false, count(*) FROM details_t
UNION ALL SELECT 'customers_loan_v', false, count(*) FROM consolidated
UNION ALL SELECT 'customers_loan_t', false, count(*) FROM consolidated""",
        "customers_clean", "loans_clean", "repayments_clean", "delinq_t", "details_t", "consolidated")
    q["ingest_stamp"] = with_ctes(f"SELECT *, {TS} AS ingest_date FROM repayments_raw", "repayments_raw")
    from lendscope.plans import lifecycle_sql
    return q | lifecycle_sql.queries()
