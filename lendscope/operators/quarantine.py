"""Duplicate member-id detection and quarantine filtering.

Scale notes:

* ``duplicate_keys`` is ``groupBy(key).count() > 1``: the partial aggregate
  combines a hot key map-side, so even a key holding a third of all rows
  reaches the shuffle as one row per map task.
* ``duplicate_counts`` / ``quarantined_ids`` find the keys duplicated in any
  of several tables with one aggregation over their tagged union (one
  shuffle of partial counts), rather than one aggregation per table plus a
  union and a distinct.
* ``not_in`` keeps SQL ``NOT IN`` three-valued semantics without the
  null-aware anti join, which Spark always plans as a broadcast of the whole
  list. Here the list side is a plain ``left_anti`` join: AQE broadcasts it
  only when its materialised size is under the broadcast threshold, else it
  stays a sort-merge join whose skewed partitions AQE splits. The NULL rules
  are two scalar EXISTS subqueries over the list, evaluated once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(df: DataFrame, key: str = "member_id") -> DataFrame:
    """Keys occurring more than once (one column out)."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("totalCount"))
        .where(F.col("totalCount") > 1)
        .select(key)
    )


def duplicate_member_ids(*dup_lists: DataFrame, key: str = "member_id") -> DataFrame:
    """Union of duplicate-key lists, de-duplicated."""
    return reduce(lambda a, b: a.unionByName(b), [d.select(key) for d in dup_lists]).distinct()


def duplicate_counts(tables: dict[str, DataFrame], key: str = "member_id") -> DataFrame:
    """Keys duplicated in at least one of ``tables``, with their row count in each
    (columns ``n_<table>``).

    One aggregation over the union of the tables' keys tagged by source: a
    single shuffle of map-side partial counts, instead of one aggregation per
    table followed by a union and a distinct; none where the tables are all read
    from buckets of the key.
    """
    src, by = "__source", "__key"  # under a name of its own the key keeps the tables' partitioning by it
    tagged = reduce(lambda a, b: a.unionByName(b),
                    [df.select(F.col(key).alias(by), F.lit(name).alias(src)) for name, df in tables.items()])
    counts = [F.count_if(F.col(src) == name).alias(f"n_{name}") for name in tables]
    agg = tagged.groupBy(by).agg(*counts).withColumnRenamed(by, key)
    return agg.where(reduce(lambda a, b: a | b, [F.col(f"n_{name}") > 1 for name in tables]))


def quarantined_ids(tables: dict[str, DataFrame], key: str = "member_id") -> DataFrame:
    """Keys duplicated in any of ``tables`` (= union-distinct of their duplicate lists)."""
    return duplicate_counts(tables, key).select(key)


def not_in(probe: DataFrame, values: DataFrame, probe_key: str = "member_id",
           value_key: str = "member_id") -> DataFrame:
    """Rows of ``probe`` where ``probe_key NOT IN (SELECT value_key FROM values)``.

    SQL semantics: an empty list keeps every row (NULL keys too); a list that
    contains NULL keeps none; otherwise NULL probe keys are dropped.
    """
    v = F.col(value_key)
    list_has_null = values.where(v.isNull()).exists()
    list_non_empty = values.exists()
    kept = probe.join(
        values.where(v.isNotNull()).select(v.alias("__nin_key")).distinct(),
        F.col(probe_key) == F.col("__nin_key"),
        "left_anti",
    )
    return kept.where(~list_has_null & (F.col(probe_key).isNotNull() | ~list_non_empty))


def drop_quarantined(df: DataFrame, quarantined: DataFrame, key: str = "member_id",
                     keys_never_null: bool = True) -> DataFrame:
    """Remove quarantined ids.

    Member keys are SHA-256 digests of ``concat_ws`` (never NULL), so by
    default this is a plain ``left_anti`` join; pass ``keys_never_null=False``
    for the full NOT IN NULL rules of :func:`not_in`.
    """
    if not keys_never_null:
        return not_in(df, quarantined, key, key)
    return df.join(quarantined.select(key), key, "left_anti")
