"""Parsing of dirty string columns. Every string-to-number step uses
``try_cast`` so malformed cells become NULL under ANSI mode as well."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from lendscope.rules import LOAN_TERM_SUFFIX, LONG_STATE_REPLACEMENT, STATE_CODE_MAX_LENGTH


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_to_double(col: str | Column) -> Column:
    """``try_cast`` to double for text that is often no number. A failed parse costs an
    exception, so only what can begin a number is parsed: a character up to '9'
    (blanks, signs, the point and digits among them) or the i and n of Infinity and NaN."""
    c = _c(col)
    first = F.lower(F.substring(c, 1, 1))
    return F.when((c < F.lit(":")) | first.isin("i", "n"), c.try_cast("double"))


def digits_to_int(col: str | Column) -> Column:
    """Drop every non-digit, then parse as int: '10+ years' -> 10, 'n/a' -> NULL."""
    return F.regexp_replace(_c(col), r"\D", "").try_cast("int")


def months_to_years(col: str | Column, suffix: str = LOAN_TERM_SUFFIX) -> Column:
    """' 36 months' -> 3: strip the suffix, parse (whitespace is trimmed), divide by 12, truncate."""
    months = F.regexp_replace(_c(col), suffix, "").try_cast("int")
    return (months / F.lit(12)).cast("int")


def cap_state_code(col: str | Column, max_len: int = STATE_CODE_MAX_LENGTH,
                   replacement: str = LONG_STATE_REPLACEMENT) -> Column:
    """Replace values longer than ``max_len`` characters; NULL stays NULL."""
    c = _c(col)
    return F.when(F.length(c) > max_len, F.lit(replacement)).otherwise(c)


def zero_sentinel_to_null(col: str | Column) -> Column:
    """Strings that read as the number 0 ('0.0', '0') become NULL; others are kept."""
    c = _c(col)
    return F.when(text_to_double(c) == F.lit(0.0), F.lit(None).cast("string")).otherwise(c)


def lit_timestamp(ts: _dt.datetime | str | None) -> Column:
    """Ingestion stamp: a fixed timestamp literal, or ``current_timestamp()`` when None."""
    if ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S")
    # string -> timestamp_ntz is time-zone independent
    return F.lit(str(ts)).cast("timestamp_ntz")
