"""First-match-wins band helpers that emit a single CASE expression."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, functions as F


def first_match(branches: Iterable[tuple[Column, object]], otherwise=None,
                has_otherwise: bool = False) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... [ELSE otherwise] END``.

    Without ``has_otherwise`` there is no ELSE, so unmatched rows are NULL.
    """
    expr = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    if has_otherwise:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


def like_any(col: Column, patterns: Iterable[str]) -> Column:
    """OR of ``col LIKE p`` over the patterns."""
    out = None
    for p in patterns:
        term = col.like(p)
        out = term if out is None else (out | term)
    return out
