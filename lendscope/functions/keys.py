"""Surrogate member key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lendscope.rules import MEMBER_KEY_COLUMNS, MEMBER_KEY_SEPARATOR


def member_key(*cols: str | Column, sep: str = MEMBER_KEY_SEPARATOR) -> Column:
    """SHA-256 (lower hex) of the columns joined by ``sep``.

    ``concat_ws`` skips NULLs, so rows differing only in where a NULL sits can
    share a key, and a row of all NULLs hashes the empty string. Non-string
    columns are cast to string by ``concat_ws``.
    """
    cols = cols or MEMBER_KEY_COLUMNS
    return F.sha2(F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cols]), 256)
