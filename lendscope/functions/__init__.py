"""Column-level helpers. Each returns a ``pyspark.sql.Column`` built only from
built-in functions, so it stays inside whole-stage codegen."""

from lendscope.functions.keys import member_key  # noqa: F401
from lendscope.functions.text import (  # noqa: F401
    digits_to_int, months_to_years, cap_state_code, zero_sentinel_to_null, lit_timestamp,
)
from lendscope.functions.bands import first_match, like_any  # noqa: F401
