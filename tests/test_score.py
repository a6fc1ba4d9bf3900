"""Rule bands on hand-made rows; expected points written from the rule tables."""

from decimal import Decimal

from pyspark.sql import functions as F

from lendscope.operators import score
from lendscope.rules import ScoreRules


def _col(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r.v for r in df.select(expr.alias("v")).collect()]


def test_last_payment_points(spark):
    df = spark.createDataFrame([(p, 100.0) for p in (49.0, 50.0, 99.0, 100.0, 101.0, 150.0, 151.0, None)],
                               "p float, i float")
    out = [r.v for r in df.select(score.last_payment_points(F.col("p"), F.col("i")).alias("v")).collect()]
    assert out == [100, 100, 100, 500, 650, 650, 800, 0]


def test_total_payment_points(spark):
    df = spark.createDataFrame([(t, 100.0) for t in (50.0, 49.0, 0.0, None, -1.0)], "t float, f float")
    out = [r.v for r in df.select(score.total_payment_points(F.col("t"), F.col("f")).alias("v")).collect()]
    assert out == [650, 500, 0, 0, None]


def test_counter_points(spark):
    vals = [0, 1, 2, 3, 5, 6, None]
    r = ScoreRules()
    assert _col(spark, vals, "c int", score.counter_points(F.col("c"), r.delinq_over_5)) == \
        [800, 250, 250, 100, 100, 750, 750]
    assert _col(spark, [0, 2, 5, 6, None], "c int", score.counter_points(F.col("c"), r.very_bad)) == \
        [800, 250, 100, 100, 100]
    assert _col(spark, [0, 2, 5, 6, None], "c int", score.counter_points(F.col("c"), r.unacceptable)) == \
        [800, 250, 100, 0, 0]


def test_loan_status_points(spark):
    vals = ["Fully Paid", "Does not meet the credit policy. Status:Fully Paid", "Current", "In Grace Period",
            "Late (16-30 days)", "Late (31-120 days)", "Charged Off", "Default", None]
    assert _col(spark, vals, "s string", score.loan_status_points(F.col("s"))) == \
        [800, 800, 500, 250, 100, 100, 0, 0, 0]


def test_home_points(spark):
    vals = ["OWN", "RENT", "MORTGAGE", "ANY", None, "OTHER"]
    assert _col(spark, vals, "s string", score.home_points(F.col("s"))) == [800, 500, 250, 100, 100, None]


def test_credit_limit_points(spark):
    rows = [(f, 1000.0) for f in (100.0, 200.0, 300.0, 500.0, 700.0, 701.0)] + [(100.0, None)]
    df = spark.createDataFrame(rows, "f float, l float")
    out = [r.v for r in df.select(score.credit_limit_points(F.col("f"), F.col("l")).alias("v")).collect()]
    assert out == [800, 650, 500, 250, 100, 0, 0]


def test_grade_points(spark):
    pairs = [("A", "A1"), ("A", "A5"), ("B", "B3"), ("E", "E5"), ("F", "F2"), ("H", "H1"), ("A", "A9"),
             ("A", "B1")]
    df = spark.createDataFrame(pairs, "g string, s string")
    out = [r.v for r in df.select(score.grade_points(F.col("g"), F.col("s")).alias("v")).collect()]
    assert out == [Decimal("800"), Decimal("640"), Decimal("585"), Decimal("80"), Decimal("0"), None, None, None]


def test_letter_grade(spark):
    vals = [Decimal("2500.01"), Decimal("2500"), Decimal("2000"), Decimal("1500"), Decimal("1000"),
            Decimal("750"), None]
    assert _col(spark, vals, "s decimal(17,4)", score.letter_grade(F.col("s"))) == \
        ["A", "B", "C", "D", "E", "F", None]


def test_weighted_score_exact_and_null_propagating(spark):
    ddl = ("member_id string, last_payment_pts int, total_payment_pts int, delinq_pts int, public_records_pts int, "
           "public_bankruptcies_pts int, enq_pts int, loan_status_pts int, home_pts int, credit_limit_pts int, "
           "grade_pts decimal(12,2)")
    df = spark.createDataFrame([
        ("best", 800, 650, 800, 800, 800, 800, 800, 800, 800, Decimal("800")),
        ("nullhome", 800, 650, 800, 800, 800, 800, 800, None, 800, Decimal("800")),
        ("mid", 100, 500, 250, 100, 100, 0, 500, 250, 650, Decimal("617.50")),
    ], ddl)
    out = {r.member_id: r for r in score.graded(score.weighted_score(df)).collect()}
    # .20 * 1450 + .45 * 3200 + .35 * 3200 = 2850, the maximum
    assert out["best"].loan_score == 2850.0 and out["best"].loan_final_grade == "A"
    assert out["nullhome"].financial_health_pts is None and out["nullhome"].loan_final_grade is None
    # .20*600 + .45*450 + .35*2017.5 = 120 + 202.5 + 706.125 = 1028.625 -> D
    assert out["mid"].loan_score == float(Decimal("1028.625")) and out["mid"].loan_final_grade == "D"


def test_rules_are_configurable(spark):
    r = ScoreRules(delinq_over_5=0)
    assert _col(spark, [6, None], "c int", score.counter_points(F.col("c"), r.delinq_over_5)) == [0, 0]


def test_rules_from_session_conf(spark):
    from lendscope.rules import ScoreRules
    spark.conf.set("spark.sql.excellent_rated_pts", "900")
    spark.conf.set("spark.sql.unacceptable_grade_pts", "700")
    try:
        r = ScoreRules.from_conf(spark)
    finally:
        spark.conf.unset("spark.sql.excellent_rated_pts")
        spark.conf.unset("spark.sql.unacceptable_grade_pts")
    assert r.excellent == 900 and r.unacceptable_grade == 700 and r.delinq_over_5 == 700
    assert r.grade_bases[0] == ("A", 900) and r.good == 500
    assert ScoreRules.from_conf(spark) == ScoreRules()


def test_rules_from_conf_parses_decimal_text(spark):
    import pytest
    from lendscope.rules import ScoreRules
    spark.conf.set("spark.sql.good_rated_pts", "550.0")
    try:
        assert ScoreRules.from_conf(spark).good == 550
        spark.conf.set("spark.sql.good_rated_pts", "550.5")
        with pytest.raises(ValueError):
            ScoreRules.from_conf(spark)
    finally:
        spark.conf.unset("spark.sql.good_rated_pts")


def test_a_band_without_points_is_refused():
    import pytest
    from lendscope.rules import ScoreRules
    with pytest.raises(ValueError, match="credit_limit_ratios"):
        ScoreRules(credit_limit_ratios=(0.1, 0.2, 0.3, 0.5, 0.7, 0.9))
    with pytest.raises(ValueError, match="home_patterns"):
        ScoreRules(home_patterns=("%own",))


def test_conf_rules_keep_the_callers_grade_bases(spark):
    from lendscope.rules import ScoreRules
    own = (("A", 1), ("B", 2))
    assert ScoreRules.from_conf(spark, base=ScoreRules(grade_bases=own)).grade_bases == own
    spark.conf.set("spark.sql.excellent_rated_pts", "900")
    try:
        assert ScoreRules.from_conf(spark).grade_bases[0] == ("A", 900)
        assert ScoreRules.from_conf(spark, base=ScoreRules(grade_bases=own)).grade_bases == own
    finally:
        spark.conf.unset("spark.sql.excellent_rated_pts")
