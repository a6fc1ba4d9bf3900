"""The loan score in SQL, with its parameters as session variables.

Points and thresholds are declared as variables of the session and the bands as
SQL functions over them; the statement itself names no number of the rules. The
names carry the call's tag and are dropped once the statement is analysed (the
analysed plan holds the values), so calls of several threads don't see each
other's rules and the session's conf is never changed.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from lendscope.rules import ScoreRules

_POINTS = ("unacceptable", "very_bad", "bad", "good", "very_good", "excellent")


def _variables(r: ScoreRules) -> dict[str, tuple[str, object]]:
    """name: (type, value)"""
    found = {p: ("INT", getattr(r, p)) for p in _POINTS}
    found |= {"delinq_over_5": ("INT", r.delinq_over_5)}
    found |= {f"bound_{letter.lower()}": ("INT", bound) for bound, letter in r.letter_bands()}
    found |= {f"ratio_{i}": ("DOUBLE", x) for i, x in enumerate(r.credit_limit_ratios)}
    found |= {f"weight_{n}": ("DECIMAL(10,4)", getattr(r, f"{n}_weight")) for n in ("payment", "defaulters", "financial")}
    found |= {f"base_{g.lower()}": ("DECIMAL(10,2)", Decimal(b)) for g, b in r.grade_bases}
    found |= {f"factor_{i}": ("DECIMAL(10,4)", x) for i, x in enumerate(r.sub_grade_factors, 1)}
    return found


def _functions(r: ScoreRules) -> dict[str, tuple[str, str]]:
    """name: (parameters and result, body); ``{v}`` is the prefix of variables."""
    status = " ".join(
        f"WHEN {' OR '.join(f'lower(s) LIKE {_text(p)}' for p in pats)} THEN {{v}}{points}"
        for pats, points in zip(r.status_patterns, ("excellent", "good", "bad", "very_bad", "unacceptable"), strict=True))
    own, rent, mortgage, any_ = map(_text, r.home_patterns)
    steps = ("excellent", "very_good", "good", "bad", "very_bad")
    limit = " ".join(f"WHEN funded <= most * {{v}}ratio_{i} THEN {{v}}{p}" for i, p in enumerate(steps))
    bases = " ".join(f"WHEN {_text(g)} THEN {{v}}base_{g.lower()}" for g, _ in r.grade_bases)
    factors = " ".join(f"WHEN {_text(str(i))} THEN {{v}}factor_{i}" for i in range(1, len(r.sub_grade_factors) + 1))
    zero = ", ".join(map(_text, r.zero_point_grades))
    letters = " ".join(f"WHEN score > {{v}}bound_{letter.lower()} THEN {_text(letter)}" for _, letter in r.letter_bands())
    return {
        "last_payment": ("(paid FLOAT, due FLOAT) RETURNS INT", """CASE
            WHEN paid IS NULL OR due IS NULL THEN {v}unacceptable WHEN paid < due THEN {v}very_bad
            WHEN paid = due THEN {v}good WHEN paid <= due * 1.5D THEN {v}very_good ELSE {v}excellent END"""),
        "total_payment": ("(total FLOAT, funded FLOAT) RETURNS INT", """CASE
            WHEN total >= funded * 0.5D THEN {v}very_good WHEN coalesce(total, 0) = 0 THEN {v}unacceptable
            WHEN total > 0 AND total < funded * 0.5D THEN {v}good END"""),
        "counter": ("(n INT, more INT) RETURNS INT", """CASE
            WHEN n = 0 THEN {v}excellent WHEN n IN (1, 2) THEN {v}bad WHEN n IN (3, 4, 5) THEN {v}very_bad
            WHEN n IS NULL OR n > 5 THEN more END"""),
        "status": ("(s STRING) RETURNS INT", f"CASE {status} ELSE {{v}}unacceptable END"),
        "home": ("(s STRING) RETURNS INT", f"""CASE WHEN s IS NULL THEN {{v}}very_bad
            WHEN lower(s) LIKE {own} THEN {{v}}excellent WHEN lower(s) LIKE {rent} THEN {{v}}good
            WHEN lower(s) LIKE {mortgage} THEN {{v}}bad WHEN lower(s) LIKE {any_} THEN {{v}}very_bad END"""),
        "credit_limit": ("(funded FLOAT, most FLOAT) RETURNS INT", f"CASE {limit} ELSE {{v}}unacceptable END"),
        "grade": ("(grade STRING, sub_grade STRING) RETURNS DECIMAL(20,6)", f"""CASE
            WHEN grade IN ({zero}) THEN CAST({{v}}unacceptable AS DECIMAL(20,6))
            WHEN left(sub_grade, 1) = grade AND length(sub_grade) = 2 THEN CAST(
              (CASE grade {bases} END) * (CASE right(sub_grade, 1) {factors} END) AS DECIMAL(20,6)) END"""),
        "letter": ("(score DECIMAL(30,10)) RETURNS STRING", f"CASE {letters} WHEN score IS NOT NULL THEN 'F' END"),
    }


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SELECT = """
WITH points AS (
  SELECT l.member_id,
         CAST({f}last_payment(p.last_payment_amount, l.monthly_installment)
              + {f}total_payment(p.total_payment_received, l.funded_amount) AS DECIMAL(20,6)) AS payment,
         CAST({f}counter(d.delinq_2yrs, {v}delinq_over_5) + {f}counter(e.pub_rec, {v}very_bad)
              + {f}counter(e.pub_rec_bankruptcies, {v}very_bad)
              + {f}counter(e.inq_last_6mths, {v}unacceptable) AS DECIMAL(20,6)) AS defaulters,
         CAST({f}status(l.loan_status) + {f}home(c.home_ownership)
              + {f}credit_limit(l.funded_amount, c.total_high_credit_limit) AS DECIMAL(20,6))
         + {f}grade(c.grade, c.sub_grade) AS financial
  FROM {{repayments}} p JOIN {{loans}} l ON p.loan_id = l.loan_id
       JOIN {{details}} e ON l.member_id = e.member_id JOIN {{delinq}} d ON l.member_id = d.member_id
       JOIN {{customers}} c ON l.member_id = c.member_id),
scored AS (
  SELECT member_id, payment * {v}weight_payment AS payment_history_pts,
         defaulters * {v}weight_defaulters AS defaulters_history_pts,
         financial * {v}weight_financial AS financial_health_pts
  FROM points),
summed AS (SELECT *, payment_history_pts + defaulters_history_pts + financial_health_pts AS loan_score FROM scored)
SELECT member_id, CAST(payment_history_pts AS FLOAT) AS payment_history_pts,
       CAST(defaulters_history_pts AS FLOAT) AS defaulters_history_pts,
       CAST(financial_health_pts AS FLOAT) AS financial_health_pts, CAST(loan_score AS FLOAT) AS loan_score,
       {f}letter(CAST(loan_score AS DECIMAL(30,10))) AS loan_final_grade
FROM summed
"""


def graded_score(spark: SparkSession, repayments: DataFrame, loans: DataFrame, details: DataFrame, delinq: DataFrame,
                 customers: DataFrame, rules: ScoreRules, tag: str) -> DataFrame:
    """The graded score of the cleaned tables (``loans`` without quarantined members)."""
    v, f = f"v_{tag}_", f"f_{tag}_"
    names = _variables(rules)
    functions = _functions(rules)
    try:
        for name, (kind, value) in names.items():
            spark.sql(f"DECLARE OR REPLACE VARIABLE {v}{name} {kind} DEFAULT CAST('{value}' AS {kind})")
        for name, (signature, body) in functions.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f}{name}{signature} RETURN {body.format(v=v)}")
        return spark.sql(_SELECT.format(v=v, f=f), repayments=repayments, loans=loans, details=details, delinq=delinq,
                         customers=customers)
    finally:
        for name in functions:
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {f}{name}")
        for name in names:
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {v}{name}")
