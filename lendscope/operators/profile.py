"""Data-quality profiles: counts, frequencies, key lookups.

Multi-count profiles are single-pass aggregates with ``count_if``; nothing is
counted by repeated actions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _n(cond) -> "F.Column":
    return F.count_if(cond)


def profile_nulls(customers: DataFrame) -> DataFrame:
    """NULL and 'NA' counts of a cleaned customers frame, in one pass."""
    s = F.col("address_state")
    return customers.agg(
        F.count(F.lit(1)).alias("n_rows"),
        _n(F.col("annual_income").isNull()).alias("n_null_income"),
        _n(F.col("emp_length").isNull()).alias("n_null_emp_length"),
        _n(s.isNull()).alias("n_null_state"),
        _n(s.like("NA")).alias("n_state_na"),
        _n(~s.like("NA")).alias("n_state_not_na"),
    )


def profile_state_length(customers: DataFrame, max_len: int = 2) -> DataFrame:
    """Number of non-NULL states longer than ``max_len`` characters."""
    s = F.col("address_state")
    return customers.where(F.length(s) > max_len).agg(F.count(s).alias("n_long_states"))


def metric_rows(df: DataFrame, table: str, metrics: dict[str, "F.Column"]) -> DataFrame:
    """One aggregate pass over ``df`` unpivoted to (table, metric, value) rows."""
    agg = df.agg(*[c.alias(name) for name, c in metrics.items()])
    return agg.unpivot([], list(metrics), "metric", "value").select(
        F.lit(table).alias("table_name"), "metric", F.col("value").cast("bigint").alias("value"))


def quality_counts(tables: dict[str, tuple[DataFrame, dict]]) -> DataFrame:
    """Union of per-table single-pass metric rows."""
    parts = [metric_rows(df, name, metrics) for name, (df, metrics) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def frequency(df: DataFrame, column: str, count_name: str = "total_count") -> DataFrame:
    """Rows per value, most frequent first (value as tie-break)."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(count_name).desc(), F.col(column).asc_nulls_first())
    )


def key_frequency(keyed: DataFrame, key: str = "name_sha2", count_name: str = "total_cnt") -> DataFrame:
    """Keys shared by more than one row, most shared first."""
    return (
        keyed.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
        .where(F.col(count_name) > 1)
        .orderBy(F.col(count_name).desc(), F.col(key))
    )


def top_by_count(df: DataFrame, key: str = "member_id", n: int = 10,
                 count_name: str = "totalCount") -> DataFrame:
    """Top-n keys by row count (a top-k report: partial aggregate, then
    TakeOrderedAndProject keeps n rows per task before the final merge)."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(count_name).desc(), F.col(key))
        .limit(n)
    )


def count_distinct_keys(keyed: DataFrame, key: str = "name_sha2") -> DataFrame:
    return keyed.agg(F.count_distinct(F.col(key)).alias("n_distinct_keys"))


def lookup_member(df: DataFrame, key_prefix: str, key: str = "name_sha2") -> DataFrame:
    """Rows whose key starts with ``key_prefix`` (a full key is an equality lookup)."""
    return df.where(F.col(key).startswith(key_prefix))


def lookup_key(df: DataFrame, value, key: str = "member_id") -> DataFrame:
    """Rows whose key equals ``value`` (a literal, or a scalar-subquery Column such
    as ``ids.agg(F.min("member_id")).scalar()``)."""
    return df.where(F.col(key) == value)


def key_collisions(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that rows with different ``columns`` share: key, n_rows.

    A key has one set of values exactly if the least and the greatest struct of
    them are equal, so nothing is collected and a hot key is one partial row per
    map task. (NULLs order first in a struct, and equal NULLs are equal.)"""
    values = F.struct(*columns)
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.min(values).alias("least"),
                                F.max(values).alias("most"))
            .where(~F.col("least").eqNullSafe(F.col("most"))).select(key, "n_rows"))


def key_audit(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: rows, keys, keys of several rows, keys of different rows, rows of those."""
    values = F.struct(*columns)
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                              (~F.min(values).eqNullSafe(F.max(values))).alias("differ"))
    return per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("n") > 1).alias("n_shared"), F.count_if("differ").alias("n_collisions"),
                   F.coalesce(F.sum(F.when(F.col("differ"), F.col("n"))), F.lit(0)).alias("n_colliding_rows"))
