"""Operators against brute-force Python models of their SQL semantics."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lendscope.operators import quarantine, score
from lendscope.rules import ScoreRules

small = st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=6)


def sql_not_in(probe, values):
    """x NOT IN (values) under SQL three-valued logic; keep rows where it is TRUE."""
    out = []
    for x in probe:
        if not values:
            out.append(x)
        elif x is None or None in values:
            continue  # NULL or FALSE
        elif x not in values:
            out.append(x)
    return out


@settings(max_examples=25, deadline=None)
@given(probe=small, values=small)
def test_not_in_matches_sql_semantics(spark, probe, values):
    p = spark.createDataFrame([(x,) for x in probe], "k int")
    v = spark.createDataFrame([(x,) for x in values], "v int")
    got = sorted((r.k for r in quarantine.not_in(p, v, "k", "v").collect()), key=lambda x: (x is None, x))
    assert got == sorted(sql_not_in(probe, values), key=lambda x: (x is None, x))


def py_counter(c, above_five, r):
    if c is None or c > 5:
        return above_five
    if c == 0:
        return r.excellent
    if 1 <= c <= 2:
        return r.bad
    if 3 <= c <= 5:
        return r.very_bad
    return None  # negative: no branch


def test_counter_bands_over_a_range(spark):
    r = ScoreRules()
    vals = list(range(-3, 12)) + [None]
    df = spark.createDataFrame([(v,) for v in vals], "c int")
    for above in (r.delinq_over_5, r.very_bad, r.unacceptable):
        got = [x.p for x in df.select(score.counter_points(F.col("c"), above, r).alias("p")).collect()]
        assert got == [py_counter(v, above, r) for v in vals]


def test_letter_grade_over_a_range(spark):
    from decimal import Decimal
    r = ScoreRules()
    vals = [Decimal(v) / 4 for v in range(0, 4 * 2900, 37)] + [Decimal("750"), Decimal("2500"), None]

    def py(s):
        if s is None:
            return None
        for bound, letter in ((2500, "A"), (2000, "B"), (1500, "C"), (1000, "D"), (750, "E")):
            if s > bound:
                return letter
        return "F"

    df = spark.createDataFrame([(v,) for v in vals], "s decimal(17,4)")
    got = [x.g for x in df.select(score.letter_grade(F.col("s"), r).alias("g")).collect()]
    assert got == [py(v) for v in vals]


def test_last_payment_over_a_grid(spark):
    r = ScoreRules()
    inst = 80.0
    vals = [float(p) for p in range(0, 200, 3)] + [40.0, 80.0, 120.0, None]

    def py(p):
        if p is None:
            return r.unacceptable
        if p < inst * 0.5 or p < inst:
            return r.very_bad
        if p == inst:
            return r.good
        if p <= inst * 1.5:
            return r.very_good
        return r.excellent

    df = spark.createDataFrame([(v, inst) for v in vals], "p float, i float")
    got = [x.v for x in df.select(score.last_payment_points(F.col("p"), F.col("i"), r).alias("v")).collect()]
    assert got == [py(v) for v in vals]


def test_left_join_splittable_equals_left_outer_join(spark):
    from lendscope.operators.consolidate import left_join_splittable
    left = spark.createDataFrame(
        [(k, i) for i, k in enumerate(["hot", "hot", "a", "b", None, "c"])], "k string, lv int")
    right = spark.createDataFrame(
        [("hot", i) for i in range(7)] + [("a", 100), ("a", 101), ("z", 9), (None, 8)], "rk string, rv int")
    got = left_join_splittable(left, right, "k", "rk")
    want = left.join(right, left.k == right.rk, "left").drop("rk")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 2 * 7 + 2 + 3


emp = st.one_of(st.none(), st.sampled_from(["10+ years", "< 1 year", "n/a", "3 years", "x", "", "0 years"]),
                st.text(alphabet="0123456789ab +<", max_size=4))
state = st.one_of(st.none(), st.sampled_from(["CA", "NY", "NATION", "ABC", "A", ""]))
income = st.one_of(st.none(), st.sampled_from([1.0, 2.5, 100.0]))
cust_rows = st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3"]), emp, income, state), max_size=8)


def py_clean_customers(rows):
    import math
    import re as _re
    kept = [r for r in set(rows) if r[2] is not None]

    def parse(s):
        if s is None:
            return None
        d = _re.sub(r"[^0-9]", "", s)
        return int(d) if d and int(d) < 2 ** 31 else None

    parsed = [(m, parse(e), i, st_) for m, e, i, st_ in kept]
    vals = [e for _, e, _, _ in parsed if e is not None]
    fill = math.floor(sum(vals) / len(vals)) if vals else None
    out = []
    for m, e, i, st_ in parsed:
        st2 = "NA" if st_ is not None and len(st_) > 2 else st_
        out.append((m, e if e is not None else fill, i, st2))
    return sorted(out, key=str)


@settings(max_examples=20, deadline=None)
@given(rows=cust_rows)
def test_clean_customers_matches_python_model(spark, rows):
    from lendscope.operators import clean
    ddl = ("member_id string, emp_length string, annual_inc float, addr_state string")
    df = spark.createDataFrame(rows, ddl)
    for c, t in (("emp_title", "string"), ("home_ownership", "string"), ("zip_code", "string"),
                 ("country", "string"), ("grade", "string"), ("sub_grade", "string"),
                 ("verification_status", "string"), ("tot_hi_cred_lim", "float"),
                 ("application_type", "string"), ("annual_inc_joint", "float"),
                 ("verification_status_joint", "string")):
        df = df.withColumn(c, F.lit(None).cast(t))
    out = clean.clean_customers(df, "2024-01-01 00:00:00")
    got = sorted(((r.member_id, r.emp_length, r.annual_income, r.address_state) for r in out.collect()), key=str)
    assert got == py_clean_customers(rows)


fl = st.one_of(st.none(), st.sampled_from([0.0, 1.5, 10.0, float("nan")]))
date = st.one_of(st.none(), st.sampled_from(["0.0", "0", "Mar-2019", "x", " 0.0"]))
rep_rows = st.lists(st.tuples(st.sampled_from(["1", "2", "3"]), fl, fl, fl, fl, fl, date, date), max_size=8)


def py_clean_repayments(rows):
    import math

    def bad(x):
        return x is None or (isinstance(x, float) and math.isnan(x))

    def zero(s):
        if s is None:
            return None
        try:
            return None if float(s.strip()) == 0.0 else s
        except ValueError:
            return s

    out = []
    for lid, p, i, fee, t, last, d1, d2 in rows:
        if any(bad(x) for x in (p, i, fee, t, last)):
            continue
        t2 = p + i + fee if (p != 0.0 and t == 0.0) else t
        out.append((lid, t2, zero(d1), zero(d2)))
    return sorted(out, key=str)


@settings(max_examples=20, deadline=None)
@given(rows=rep_rows)
def test_clean_repayments_matches_python_model(spark, rows):
    from lendscope.operators import clean
    from lendscope.schemas import REPAYMENTS_RAW_DDL
    df = spark.createDataFrame(rows, REPAYMENTS_RAW_DDL)
    out = clean.clean_repayments(df, "2024-01-01 00:00:00")
    got = sorted(((r.loan_id, r.total_payment_received, r.last_payment_date, r.next_payment_date)
                  for r in out.collect()), key=str)
    assert got == py_clean_repayments(rows)


term = st.one_of(st.none(), st.sampled_from([" 36 months", " 60 months", "36 months", " 42 months", "x months"]))
purpose = st.one_of(st.none(), st.sampled_from(["car", "wedding", "pay my bills", "Medical", "other"]))
loan_rows = st.lists(st.tuples(st.sampled_from(["1", "2"]), fl, term, purpose), max_size=8)


def py_clean_loans(rows):
    import math
    lookup = {"debt_consolidation", "credit_card", "home_improvement", "other", "major_purchase", "medical",
              "small_business", "car", "vacation", "moving", "house", "wedding", "renewable_energy", "educational"}
    out = []
    for lid, amount, t, p in rows:
        if amount is None or math.isnan(amount) or t is None or p is None:
            continue
        digits = t.replace(" months", "").strip()
        years = int(int(digits) / 12) if digits.isdigit() else None
        out.append((lid, years, p if p in lookup else "other"))
    return sorted(out, key=str)


@settings(max_examples=20, deadline=None)
@given(rows=loan_rows)
def test_clean_loans_matches_python_model(spark, rows):
    from lendscope.operators import clean
    df = spark.createDataFrame(
        [(lid, "m", a, a, t, 5.0, 1.0, "Jan-2015", "Current", p, "t") for lid, a, t, p in rows],
        "loan_id string, member_id string, loan_amount float, funded_amount float, loan_term_months string, "
        "interest_rate float, monthly_installment float, issue_date string, loan_status string, "
        "loan_purpose string, loan_title string")
    out = clean.clean_loans(df, "2024-01-01 00:00:00")
    got = sorted(((r.loan_id, r.loan_term_years, r.loan_purpose) for r in out.collect()), key=str)
    assert got == py_clean_loans(rows)
