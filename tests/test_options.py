"""Options of the flow: optional de-duplication, left join to the delinquency table."""

from pyspark.sql import functions as F

from lendscope.operators import clean, score
from lendscope.operators.quarantine import duplicate_keys
from lendscope.plans.frames import LendingFrames


def test_dedup_drops_repeated_rows_of_each_table(spark, sf_small):
    f = LendingFrames(spark, sf_small)
    for raw, step in ((f.loans_raw, clean.clean_loans), (f.repayments_raw, clean.clean_repayments),
                      (f.defaulters_raw, clean.stamped_defaulters)):
        once = step(raw.distinct(), "2024-01-01 00:00:00")
        twice = raw.distinct().unionByName(raw.distinct())
        assert step(twice, "2024-01-01 00:00:00").count() == 2 * once.count()  # the flow's default
        got = step(twice, "2024-01-01 00:00:00", dedup=True)
        assert got.count() == once.count() and got.exceptAll(once).count() == 0


def test_dedup_changes_what_is_quarantined(spark):
    cols = "member_id string, " + ", ".join(f"{c} float" for c in (
        "delinq_2yrs", "delinq_amnt", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths", "total_rec_late_fee",
        "mths_since_last_delinq", "mths_since_last_record"))
    rows = [("same", *[1.0] * 8)] * 2 + [("other", *[1.0] * 8), ("other", *[1.0] * 7, 2.0), ("one", *[None] * 8)]
    raw = spark.createDataFrame(rows, cols)

    def ids(dedup):
        details = clean.defaulter_details(clean.stamped_defaulters(raw, "2024-01-01 00:00:00", dedup))
        return sorted(r.member_id for r in duplicate_keys(details).collect())
    assert ids(False) == ["other", "same"] and ids(True) == ["other"]


def test_left_join_keeps_members_without_a_delinquency(spark):
    ph = spark.createDataFrame([("a", 1, 2), ("b", 1, 2)], "member_id string, last_payment_pts int, total_payment_pts int")
    details = spark.createDataFrame([("a", 0, 0, 0), ("b", 0, 0, 0)],
                                    "member_id string, pub_rec int, pub_rec_bankruptcies int, inq_last_6mths int")
    delinq = spark.createDataFrame([("a", 1)], "member_id string, delinq_2yrs int")
    inner = {r.member_id: r.delinq_pts for r in score.defaulter_history(ph, details, delinq).collect()}
    left = {r.member_id: r.delinq_pts for r in score.defaulter_history(ph, details, delinq, delinq_join="left").collect()}
    assert inner == {"a": 250} and left == {"a": 250, "b": 750}  # the points of a NULL counter


def test_left_score_holds_the_inner_one(spark, sf_small):
    f = LendingFrames(spark, sf_small)
    g = LendingFrames(spark, sf_small, delinq_join="left")
    assert f.score.exceptAll(g.score).count() == 0
    more = g.score.exceptAll(f.score)
    assert more.count() > 0 and more.join(f.delinq_table, "member_id", "left_semi").count() == 0
    assert g.narrow.delinq_join == "left" and g.score.where(F.col("member_id").isNull()).count() == 0
