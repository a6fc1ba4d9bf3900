"""DuckDB SQL of the queries about tables over time (see ``lifecycle_queries``)."""

from __future__ import annotations

from lendscope import schemas
from lendscope.plans.oracle_sql import _CTES, _QUALITY, _all, _cte, _hop, with_ctes

# what the broken lines of the wide CSV are, and the columns that are numbers in it
_BROKEN = "CAST(id AS BIGINT) % 211"
_NUMBERS = ("tot_hi_cred_lim annual_inc_joint loan_amnt funded_amnt int_rate installment total_rec_prncp total_rec_int "
            "total_rec_late_fee total_pymnt last_pymnt_amnt delinq_2yrs delinq_amnt pub_rec pub_rec_bankruptcies "
            "inq_last_6mths mths_since_last_delinq mths_since_last_record").split()
_TEXTS = ("emp_title emp_length home_ownership annual_inc zip_code addr_state grade sub_grade verification_status "
          "application_type verification_status_joint term issue_d loan_status purpose title last_pymnt_d "
          "next_pymnt_d").split()

_FIRST = "NOT (CAST(id AS BIGINT) % 40 = 0 OR CAST(id AS BIGINT) % 3 = 1)"
_TAKEN_BACK = "CAST(id AS BIGINT) % 120 <> 0"


def _slice(tag: str, rows: str) -> str:
    """The quarantine's duplicate ids of some wide rows, as a chain of CTEs; its last name."""
    chain = ("customers_raw", "cust_renamed", "cust_income", "defaulters_raw", "def_counts", "def_filled", "delinq",
             "details", "delinq_t", "details_t")
    rename = {n: f"{n}_{tag}" for n in ("keyed", *chain)}
    _cte(rename["keyed"], ("keyed",), f"SELECT * FROM keyed WHERE {rows}")
    for name in chain:
        deps, sql = _CTES[name]
        for old in deps:
            sql = sql.replace(f"FROM {old}", f"FROM {rename[old]}")
        _cte(rename[name], tuple(rename[d] for d in deps), sql)
    parts = [rename[n] for n in ("cust_income", "delinq_t", "details_t")]
    _cte(f"dup_ids_{tag}", tuple(parts), " UNION ".join(
        f"(SELECT member_id FROM {p} GROUP BY member_id HAVING count(*) > 1)" for p in parts))
    return f"dup_ids_{tag}"


def _units(c: str) -> str:
    return f"CAST(sum(CAST(floor(CAST({c} AS DOUBLE) * 1024) AS BIGINT)) AS BIGINT) AS {c}"


def _column_statistics() -> str:
    tables = {"loans": ("loans_clean", schemas.LOANS_TABLE_DDL), "loans_repayments": ("repayments_clean", schemas.REPAYMENTS_TABLE_DDL),
              "loans_defaulters_delinq": ("delinq_t", schemas.DELINQ_TABLE_DDL)}
    rows = []
    for table, (cte, ddl) in tables.items():
        for part in ddl.split(","):
            column, kind = part.split()
            rows.append(f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, "
                        f"count(*) - count({column}) AS n_null, true AS distinct_close FROM {cte}")
    return with_ctes(" UNION ALL ".join(rows), *[cte for cte, _ in tables.values()])


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_wide_csv"] = with_ctes(
        f"SELECT CAST(id AS INTEGER) AS id, {_hop(*_TEXTS)}, {', '.join(_NUMBERS)} FROM raw "
        f"WHERE {_BROKEN} NOT IN (3, 5, 7)", "raw")
    q["ingest_rejected_lines"] = with_ctes(f"""
SELECT CAST(id AS INTEGER) AS id, CASE {_BROKEN} WHEN 3 THEN 3 WHEN 5 THEN 38 ELSE 37 END AS n_fields,
       if({_BROKEN} = 7, 'value', 'fields') AS reason, if({_BROKEN} = 7, 'installment', '') AS "columns"
FROM raw WHERE {_BROKEN} IN (3, 5, 7)""", "raw")
    q["factorised_totals"] = with_ctes(
        "SELECT count(*) AS n_rows, " + ", ".join(_units(c) for c in (
            "annual_income", "loan_amount", "interest_rate", "total_principal_received", "delinq_amnt", "pub_rec"))
        + " FROM consolidated", "consolidated")
    q["factorised_view"] = _all("consolidated")
    q["factorised_members"] = with_ctes("""
SELECT c.member_id, c.n AS n_customers, coalesce(l.n, 0) AS n_loans, coalesce(d.n, 0) AS n_delinq,
       coalesce(e.n, 0) AS n_details, v.n AS n_rows
FROM (SELECT member_id, count(*) AS n FROM customers_clean GROUP BY ALL) c
LEFT JOIN (SELECT member_id, count(*) AS n FROM loans_clean GROUP BY ALL) l USING (member_id)
LEFT JOIN (SELECT member_id, count(*) AS n FROM delinq_t GROUP BY ALL) d USING (member_id)
LEFT JOIN (SELECT member_id, count(*) AS n FROM details_t GROUP BY ALL) e USING (member_id)
JOIN (SELECT member_id, count(*) AS n FROM consolidated GROUP BY ALL) v USING (member_id)""",
        "customers_clean", "loans_clean", "delinq_t", "details_t", "consolidated")
    q["snapshot_refresh"] = _all("consolidated")
    first = _slice("load1", _FIRST)
    last = _slice("kept3", _TAKEN_BACK)
    q["quarantine_loads"] = with_ctes(f"""
SELECT member_id, 'enter' AS change, 1 AS step FROM {first}
UNION ALL SELECT member_id, 'enter', 2 FROM (SELECT * FROM dup_ids EXCEPT SELECT * FROM {first})
UNION ALL SELECT member_id, 'leave', 2 FROM (SELECT * FROM {first} EXCEPT SELECT * FROM dup_ids)
UNION ALL SELECT member_id, 'leave', 3 FROM (SELECT * FROM dup_ids EXCEPT SELECT * FROM {last})
UNION ALL SELECT member_id, 'enter', 3 FROM (SELECT * FROM {last} EXCEPT SELECT * FROM dup_ids)""",
        "dup_ids", first, last)
    q["quarantine_after_loads"] = _all("dup_ids")
    q["quality_counts_on_write"] = with_ctes(_QUALITY, "loans_raw", "repayments_raw", "def_filled", "dup_ids")
    q["publish_versions"] = with_ctes("""
SELECT *, 1 AS version FROM loans_clean WHERE CAST(loan_id AS BIGINT) % 10 <> 3
UNION ALL SELECT *, 2 FROM loans_clean""", "loans_clean")
    values = ("emp_title, emp_length, home_ownership, annual_inc, zip_code, addr_state, grade, sub_grade, "
              "verification_status")
    q["key_audit"] = with_ctes(f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_shared,
       count(*) FILTER (WHERE v > 1) AS n_collisions,
       CAST(coalesce(sum(n) FILTER (WHERE v > 1), 0) AS BIGINT) AS n_colliding_rows
FROM (SELECT name_sha2, count(*) AS n, count(DISTINCT row({values})) AS v FROM keyed GROUP BY name_sha2)""", "keyed")
    q["key_collisions"] = with_ctes(f"""
SELECT left(name_sha2, 3) AS short_key, count(*) AS n_rows FROM keyed
GROUP BY ALL HAVING count(DISTINCT row({values})) > 1""", "keyed")
    q["column_statistics"] = _column_statistics()
    q["ingest_lineage"] = with_ctes(
        "SELECT left(issue_d, 3) AS month, count(*) AS n_rows, count(DISTINCT id) AS n_loans, 0::BIGINT AS n_unknown "
        "FROM keyed GROUP BY ALL", "keyed")
    q["lookup_member_indexed"] = with_ctes("SELECT * FROM keyed WHERE name_sha2 = sha256('')", "keyed")
    q["score_sql_variables"] = _all("graded")
    q["score_with_left_delinq"] = _all("graded_left")
    q["duplicate_member_ids_dedup"] = with_ctes("""
SELECT member_id FROM dup_customers
UNION SELECT member_id FROM (SELECT DISTINCT * FROM defaulters_raw) WHERE coalesce(trunc(delinq_2yrs), 0) > 0
  OR mths_since_last_delinq > 0 GROUP BY member_id HAVING count(*) > 1
UNION SELECT member_id FROM (SELECT DISTINCT * FROM defaulters_raw) GROUP BY member_id HAVING count(*) > 1""",
        "dup_customers", "defaulters_raw")
    q["duplicate_reports"] = with_ctes("""
SELECT member_id, 'customers' AS table_name FROM dup_customers
UNION ALL SELECT member_id, 'loans_defaulters_delinq' FROM dup_delinq
UNION ALL SELECT member_id, 'loans_defaulters_details' FROM dup_details""", "dup_ids")
    return q
