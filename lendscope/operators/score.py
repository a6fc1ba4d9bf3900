"""Weighted loan score and letter grade.

Three point groups, each a set of first-match-wins bands (see ``rules``):
payment history (last payment vs. instalment, total paid vs. funded amount),
defaulter history (four banded counters) and financial health (loan status,
home ownership, credit-limit use, grade x sub-grade). The weighted sum is
computed in exact decimals, graded, and only then cast to float.

Plan shape. Quarantined members are removed from the loans once, before any
join (a plain ``left_anti`` that AQE turns into a broadcast when the id list is
small); the other inputs come unfiltered, since inner joins on ``member_id``
from the filtered loans drop their quarantined rows. The loan's own columns are
carried along from the ``loan_id`` join, so loans are read and joined once. No
member fans out: after the quarantine every member has at most one loan, one
details row and one delinquency row. The joins share the ``member_id`` hash
partitioning, so the chain needs one shuffle per input and none between joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendscope.functions.bands import first_match, like_any
from lendscope.operators.quarantine import drop_quarantined
from lendscope.rules import DEFAULT_RULES, ScoreRules

SCORE_COLUMNS = ["payment_history_pts", "defaulters_history_pts", "financial_health_pts", "loan_score"]


# --- point expressions -----------------------------------------------------------

def last_payment_points(paid: Column, instalment: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    half, one_and_half = instalment * 0.5, instalment * 1.5
    return first_match([
        (paid < half, r.very_bad),
        ((paid >= half) & (paid < instalment), r.very_bad),
        (paid == instalment, r.good),
        ((paid > instalment) & (paid <= one_and_half), r.very_good),
        (paid > one_and_half, r.excellent),
    ], r.unacceptable, has_otherwise=True)


def total_payment_points(total: Column, funded: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    """No ELSE: a negative total payment scores NULL."""
    half = funded * 0.5
    return first_match([
        (total >= half, r.very_good),
        ((total < half) & (total > 0), r.good),
        ((total == 0) | total.isNull(), r.unacceptable),
    ])


def counter_points(c: Column, above_five, r: ScoreRules = DEFAULT_RULES) -> Column:
    """0 -> excellent, 1-2 -> bad, 3-5 -> very bad, above 5 or NULL -> ``above_five``."""
    return first_match([
        (c == 0, r.excellent),
        (c.between(1, 2), r.bad),
        (c.between(3, 5), r.very_bad),
        ((c > 5) | c.isNull(), above_five),
    ])


def loan_status_points(status: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    s = F.lower(status)
    values = (r.excellent, r.good, r.bad, r.very_bad, r.unacceptable)
    return first_match(
        [(like_any(s, pats), v) for pats, v in zip(r.status_patterns, values, strict=True)],
        r.unacceptable, has_otherwise=True)


def home_points(home: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    """No ELSE: ownership values matching no pattern (e.g. OTHER) score NULL."""
    s = F.lower(home)
    own, rent, mortgage, any_ = r.home_patterns
    return first_match([
        (s.like(own), r.excellent),
        (s.like(rent), r.good),
        (s.like(mortgage), r.bad),
        (s.like(any_) | s.isNull(), r.very_bad),
    ])


def credit_limit_points(funded: Column, limit: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    ratios = r.credit_limit_ratios
    values = (r.excellent, r.very_good, r.good, r.bad, r.very_bad)
    branches = [(funded <= limit * ratios[0], values[0])]
    for lo, hi, v in zip(ratios[:-1], ratios[1:], values[1:], strict=True):
        branches.append(((funded > limit * lo) & (funded <= limit * hi), v))
    branches.append((funded > limit * ratios[-1], r.unacceptable))
    return first_match(branches, r.unacceptable, has_otherwise=True)


def grade_points(grade: Column, sub_grade: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    """Exact decimal points per (grade, sub-grade); F/G -> 0; anything else NULL."""
    branches = [((grade == g) & (sub_grade == sg), F.lit(pts)) for g, sg, pts in r.sub_grade_points()]
    branches.append((grade.isin(list(r.zero_point_grades)), r.unacceptable))
    return first_match(branches)


def letter_grade(score: Column, r: ScoreRules = DEFAULT_RULES) -> Column:
    bands = r.letter_bands()
    branches = [(score > bound, letter) for bound, letter in bands]
    branches.append((score <= bands[-1][0], "F"))
    return first_match(branches)


# --- point groups ------------------------------------------------------------------

def payment_history(repayments: DataFrame, loans: DataFrame, quarantined: DataFrame | None = None,
                    r: ScoreRules = DEFAULT_RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """member_id, last_payment_pts, total_payment_pts (repayments joined to loans on
    loan_id), and the loan columns named in ``carry``."""
    l = loans.select("loan_id", "member_id", "monthly_installment", "funded_amount",
                     *[c for c in carry if c != "funded_amount"])
    if quarantined is not None:
        l = drop_quarantined(l, quarantined)
    p = repayments.select("loan_id", "last_payment_amount", "total_payment_received")
    j = p.join(l, "loan_id")
    return j.select(
        "member_id",
        last_payment_points(F.col("last_payment_amount"), F.col("monthly_installment"), r)
        .alias("last_payment_pts"),
        total_payment_points(F.col("total_payment_received"), F.col("funded_amount"), r)
        .alias("total_payment_pts"),
        *[F.col(c) for c in carry],
    )


def defaulter_history(ph: DataFrame, details: DataFrame, delinq: DataFrame,
                      r: ScoreRules = DEFAULT_RULES, delinq_join: str = "inner") -> DataFrame:
    """Payment history plus the four defaulter counters' points (joins on member_id).

    The delinquency table holds only members with a delinquency, so the inner join
    scores nobody else. With ``delinq_join="left"`` members without a record are
    kept, and get the points that the rules give a NULL counter."""
    e = details.select("member_id", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
    d = delinq.select("member_id", "delinq_2yrs")
    j = ph.join(e, "member_id").join(d, "member_id", delinq_join)
    return j.select(
        *[F.col(c) for c in ph.columns],
        counter_points(F.col("delinq_2yrs"), r.delinq_over_5, r).alias("delinq_pts"),
        counter_points(F.col("pub_rec"), r.very_bad, r).alias("public_records_pts"),
        counter_points(F.col("pub_rec_bankruptcies"), r.very_bad, r).alias("public_bankruptcies_pts"),
        counter_points(F.col("inq_last_6mths"), r.unacceptable, r).alias("enq_pts"),
    )


#: Loan columns that the financial-health points need
LOAN_CARRY = ("loan_status", "funded_amount")


def financial_health(ldh: DataFrame, loans: DataFrame | None, customers: DataFrame,
                     quarantined: DataFrame | None = None, r: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """Adds loan status, home ownership, credit-limit and grade points (joins on member_id).

    With ``loans=None`` the loan columns are those that ``ldh`` carries (see
    ``LOAN_CARRY``); a caller that has not quarantined its members passes the loans,
    and each of a member's points rows then meets each of its loans."""
    a = customers.select("member_id", "home_ownership", "total_high_credit_limit", "grade", "sub_grade")
    j = ldh
    if loans is not None:
        l = loans.select("member_id", *LOAN_CARRY)
        if quarantined is not None:
            l = drop_quarantined(l, quarantined)
        j = ldh.drop(*LOAN_CARRY).join(l, "member_id")
    j = j.join(a, "member_id")
    return j.select(
        *[F.col(c) for c in ldh.columns if c not in LOAN_CARRY],
        loan_status_points(F.col("loan_status"), r).alias("loan_status_pts"),
        home_points(F.col("home_ownership"), r).alias("home_pts"),
        credit_limit_points(F.col("funded_amount"), F.col("total_high_credit_limit"), r)
        .alias("credit_limit_pts"),
        grade_points(F.col("grade"), F.col("sub_grade"), r).alias("grade_pts"),
    )


def weighted_score(points: DataFrame, r: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """Weighted group sums and their total, as exact decimals (NULL if any part is NULL)."""
    c = F.col
    ph = (c("last_payment_pts") + c("total_payment_pts")) * F.lit(r.payment_weight)
    dh = (c("delinq_pts") + c("public_records_pts") + c("public_bankruptcies_pts") + c("enq_pts")) \
        * F.lit(r.defaulters_weight)
    fh = (c("loan_status_pts") + c("home_pts") + c("credit_limit_pts") + c("grade_pts")) \
        * F.lit(r.financial_weight)
    s = points.select(
        "member_id", ph.alias("payment_history_pts"), dh.alias("defaulters_history_pts"),
        fh.alias("financial_health_pts"))
    return s.withColumns({
        "loan_score": c("payment_history_pts") + c("defaulters_history_pts") + c("financial_health_pts")
    })


def graded(score: DataFrame, r: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """Letter grade from the exact score, then the four score columns cast to float."""
    g = score.withColumns({"loan_final_grade": letter_grade(F.col("loan_score"), r)})
    return g.withColumns({c: F.col(c).cast("float") for c in SCORE_COLUMNS})


def as_float(score: DataFrame) -> DataFrame:
    return score.withColumns({c: F.col(c).cast("float") for c in SCORE_COLUMNS})


def loan_score_grades(repayments: DataFrame, loans: DataFrame, details: DataFrame,
                      delinq: DataFrame, customers: DataFrame, quarantined: DataFrame,
                      r: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """End-to-end score over the cleaned tables.

    All tables are the cleaned ones; whether ``details``, ``delinq`` and
    ``customers`` still hold quarantined members makes no difference.
    """
    ph = payment_history(repayments, drop_quarantined(loans, quarantined), None, r, LOAN_CARRY)
    fh = financial_health(defaulter_history(ph, details, delinq, r), None, customers, None, r)
    return graded(weighted_score(fh, r), r)
