"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables (through the testbed) and runs over all of
their rows; a limit appears only in the top-k report.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope.operators import clean, profile, quarantine, score
from lendscope.plans.frames import FrameStore, LendingFrames
from lendscope.rules import ALL_NULL_MEMBER_KEY_PREFIX, ScoreRules
from lendscope.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
Build = Callable[[LendingFrames], DataFrame]


def frames(spark: SparkSession, sf_dir: str) -> LendingFrames:
    """A new frame graph, owned by the caller."""
    return LendingFrames(spark, sf_dir)


class _Narrow:
    """Marks a query that reads the wide rows once."""

    def __init__(self, build: Build):
        self.build = build


def _f(attr: str) -> Build:
    return lambda f: getattr(f, attr)


def _one(attr_or_build) -> _Narrow:
    return _Narrow(_f(attr_or_build) if isinstance(attr_or_build, str) else attr_or_build)


def quality_metrics(f: LendingFrames) -> dict[str, tuple[DataFrame, dict]]:
    """The tables whose quality is counted, each with its counts."""
    c = F.col
    return {
        "loans": (f.loans_raw, {
            "rows": F.count(F.lit(1)), "null_loan_amount": F.count_if(c("loan_amount").isNull())}),
        "loans_repayments": (f.repayments_raw, {
            "rows": F.count(F.lit(1)),
            "null_principal": F.count_if(c("total_principal_received").isNull()),
            "zero_payment_nonzero_principal": F.count_if(
                (c("total_payment_received") == 0.0) & (c("total_principal_received") != 0.0)),
        }),
        "loans_defaulters": (f.defaulters, {
            "rows": F.count(F.lit(1)),
            "delinquent": F.count_if((c("delinq_2yrs") > 0) | (c("mths_since_last_delinq") > 0)),
            "records_enq": F.count_if(
                (c("pub_rec") > 0) | (c("pub_rec_bankruptcies") > 0) | (c("inq_last_6mths") > 0)),
        }),
        "duplicate_member_ids": (quarantine.duplicate_counts(f.quarantine_sources), {
            **{f"in_{name}": F.count_if(c(f"n_{name}") > 1) for name in f.quarantine_sources},
            "rows": F.count(F.lit(1)),
        }),
    }


def _quality(f: LendingFrames) -> DataFrame:
    return profile.quality_counts(quality_metrics(f))


def _not_in_nations(f: LendingFrames) -> DataFrame:
    nations = read_table(f.spark, f.sf_dir, "nation").select("n_name")
    return quarantine.not_in(f.customers_raw, nations, "addr_state", "n_name")


def _credit_limit(f: LendingFrames) -> DataFrame:
    l = f.loans_q.select("loan_id", "member_id", "funded_amount")
    a = f.customers_c.select("member_id", "total_high_credit_limit")
    j = l.join(a, "member_id")
    return j.select(
        "loan_id", "member_id", "funded_amount", "total_high_credit_limit",
        score.credit_limit_points(F.col("funded_amount"), F.col("total_high_credit_limit"), f.rules)
        .alias("credit_limit_pts"))


def _not_in_states(f: LendingFrames, extra) -> DataFrame:
    """States not in the list of the nations' codes plus ``extra``."""
    codes = read_table(f.spark, f.sf_dir, "nation").select(F.substring("n_name", 1, 2).alias("v"))
    return quarantine.not_in(f.customers_raw, codes.unionByName(f.spark.range(1).select(extra.alias("v"))),
                             "addr_state", "v")


#: The parameters that ``score_with_conf_rules`` sets in the session conf
CONF_RULES = {"spark.sql.excellent_rated_pts": "900", "spark.sql.good_grade_pts": "2100",
              "spark.sql.unacceptable_grade_pts": "700"}


def _score_with_conf_rules(f: LendingFrames) -> DataFrame:
    """The graded score under rules named in a session's conf: a session of its own,
    so that other threads' queries never see them."""
    session = f.spark.newSession()
    for k, v in CONF_RULES.items():
        session.conf.set(k, v)
    return score.loan_score_grades(f.repayments, f.loans, f.details_table, f.delinq_table, f.customers, f.dup_ids,
                                   ScoreRules.from_conf(session))


def core_builds() -> dict[str, Build | _Narrow]:
    return {
        "member_key": _one(lambda f: f.keyed.select("id", F.col("name_sha2").alias("member_id"))),
        "split_customers": _one("customers_raw"),
        "split_loans": _one("loans_raw"),
        "split_repayments": _one("repayments_raw"),
        "split_defaulters": _one("defaulters_raw"),

        "clean_customers": _f("customers"),
        "avg_emp_length": _one(lambda f: clean.avg_emp_length(f.customers_income)),
        "impute_emp_length": _one(lambda f: clean.impute_emp_length(f.customers_income)),
        "normalise_state": _one(lambda f: clean.normalise_state(f.customers_renamed)),
        "dedup_rows": _one(lambda f: clean.dedup_rows(f.customers_raw)),
        "filter_not_null": _one(lambda f: clean.filter_not_null(f.customers_raw, "annual_inc")),
        "clean_loans": _one("loans"),
        "dropna_subset": _one(lambda f: clean.dropna_subset(f.loans_raw, clean.LOAN_REQUIRED)),
        "term_to_years": _one(lambda f: clean.term_to_years(f.loans_raw)),
        "categorise_purpose": _one(lambda f: clean.categorise_purpose(f.loans_raw)),
        "purpose_frequency": _one(lambda f: profile.frequency(
            clean.loans_before_categories(f.loans_raw, f.ingest_ts), "loan_purpose")),
        "clean_repayments": _one("repayments"),
        "repair_total_payment": _one(lambda f: clean.repair_total_payment(f.repayments_raw)),
        "nullify_zero_dates": _one(lambda f: clean.nullify_zero_dates(f.repayments_raw)),
        "fill_defaulter_counts": _one(lambda f: clean.fill_defaulter_counts(f.defaulters_raw)),
        "delinquent_members": _one("delinq"),
        "record_enquiry_members": _one("records_enq"),
        "defaulter_details": _one("details"),

        "profile_nulls": lambda f: profile.profile_nulls(f.customers),
        "profile_state_length": _one(lambda f: profile.profile_state_length(
            clean.impute_emp_length(f.customers_income))),
        "quality_counts": _quality,
        "top_members_by_count": _one(lambda f: profile.top_by_count(f.details_table)),
        "top_clean_members_by_count": lambda f: profile.top_by_count(f.customers_c),
        "counter_frequency": _one(lambda f: profile.frequency(f.defaulters, "delinq_2yrs", "totalCount")),
        "key_frequency": _one(lambda f: profile.key_frequency(f.keyed)),
        "count_distinct_keys": _one(lambda f: profile.count_distinct_keys(f.keyed)),
        "lookup_member": _one(lambda f: profile.lookup_member(f.keyed, ALL_NULL_MEMBER_KEY_PREFIX)),
        "lookup_duplicate_member": lambda f: profile.lookup_key(
            f.details_table, f.dup_ids.agg(F.min("member_id")).scalar()),

        "duplicate_keys_customers": _f("dup_customers"),
        "duplicate_keys_delinq": _one("dup_delinq"),
        "duplicate_keys_details": _one("dup_details"),
        "duplicate_member_ids": _f("dup_ids"),
        "quarantine_filter_customers": _f("customers_c"),
        "quarantine_filter_delinq": _f("delinq_c"),
        "quarantine_filter_details": _f("details_c"),
        "not_in_null_semantics": _one(_not_in_nations),

        "consolidated_view": _f("consolidated"),

        "score_payment_history": _f("payment_history"),
        "score_defaulter_pts": _f("defaulter_history"),
        "status_points": _one(lambda f: f.loans.select(
            "loan_id", "member_id", "loan_status",
            score.loan_status_points(F.col("loan_status"), f.rules).alias("loan_status_pts"))),
        "home_points": lambda f: f.customers.select(
            "member_id", "home_ownership",
            score.home_points(F.col("home_ownership"), f.rules).alias("home_pts")),
        "credit_limit_points": _credit_limit,
        "grade_points": lambda f: f.customers.select(
            "member_id", "grade", "sub_grade",
            score.grade_points(F.col("grade"), F.col("sub_grade"), f.rules).cast("double").alias("grade_pts")),
        "score_financial_health": lambda f: f.financial_health.withColumns(
            {"grade_pts": F.col("grade_pts").cast("double")}),
        "loan_score": lambda f: score.as_float(f.weighted),
        "loan_score_grades": _f("score"),
        "score_with_conf_rules": _score_with_conf_rules,
        "not_in_null_list": _one(lambda f: _not_in_states(f, F.lit(None).cast("string"))),
        "not_in_empty_list": _one(lambda f: quarantine.not_in(
            f.customers_raw, read_table(f.spark, f.sf_dir, "nation").where("n_name IS NULL").select("n_name"),
            "addr_state", "n_name")),
        "not_in_states": _one(lambda f: _not_in_states(f, F.lit("NA"))),
        "top_customers_by_count": lambda f: profile.top_by_count(f.customers),
        "top_delinq_by_count": _one(lambda f: profile.top_by_count(f.delinq_table)),
        "lookup_duplicate_customer": lambda f: profile.lookup_key(
            f.customers, f.dup_customers.agg(F.min("member_id")).scalar()),
        "lookup_duplicate_delinq": lambda f: profile.lookup_key(
            f.delinq_table, f.dup_delinq.agg(F.min("member_id")).scalar()),
    }


def core_queries(store: FrameStore) -> dict[str, Query]:
    def query(build: Build | _Narrow) -> Query:
        if isinstance(build, _Narrow):
            return lambda spark, sf_dir: build.build(store.frames(spark, sf_dir).narrow)
        return lambda spark, sf_dir: build(store.frames(spark, sf_dir))
    return {k: query(b) for k, b in core_builds().items()}


def all_queries(store: FrameStore | None = None) -> dict[str, Query]:
    """All registered queries over the frame graphs of ``store`` (the caller's; a
    new one by default)."""
    from lendscope.plans.io_queries import io_queries
    from lendscope.plans.lifecycle_queries import lifecycle_queries
    store = store or FrameStore()
    return core_queries(store) | io_queries(store) | lifecycle_queries(store)
