"""Column helpers on hand-made rows."""

import hashlib

from pyspark.sql import functions as F

from lendscope.functions import cap_state_code, digits_to_int, member_key, months_to_years, zero_sentinel_to_null
from lendscope.rules import MEMBER_KEY_COLUMNS

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def test_member_key_all_null_is_empty_digest(spark):
    schema = ", ".join(f"{c} string" for c in MEMBER_KEY_COLUMNS)
    df = spark.createDataFrame([tuple([None] * 9)], schema)
    assert df.select(member_key().alias("k")).first().k == EMPTY_SHA
    assert EMPTY_SHA.startswith("e3b0c44298fc1c149")


def test_member_key_null_position_collides(spark):
    schema = ", ".join(f"{c} string" for c in MEMBER_KEY_COLUMNS)
    a = ("a", None, "b") + (None,) * 6
    b = ("a", "b", None) + (None,) * 6
    df = spark.createDataFrame([a, b], schema)
    keys = [r.k for r in df.select(member_key().alias("k")).collect()]
    assert keys[0] == keys[1] == hashlib.sha256(b"a||b").hexdigest()


def test_member_key_matches_python_sha(spark):
    df = spark.createDataFrame([("x", 1.5)], "a string, b double")
    k = df.select(member_key("a", "b").alias("k")).first().k
    assert k == hashlib.sha256(b"x||1.5").hexdigest()


def test_digits_to_int(spark):
    df = spark.createDataFrame([("10+ years",), ("< 1 year",), ("n/a",), (None,), ("3 years",)], "s string")
    assert [r.v for r in df.select(digits_to_int("s").alias("v")).collect()] == [10, 1, None, None, 3]


def test_months_to_years(spark):
    df = spark.createDataFrame([(" 36 months",), (" 60 months",), (" 42 months",), ("36 months",), ("x",)],
                               "s string")
    assert [r.v for r in df.select(months_to_years("s").alias("v")).collect()] == [3, 5, 3, 3, None]


def test_cap_state_code(spark):
    df = spark.createDataFrame([("CA",), ("NATION_3",), (None,)], "s string")
    assert [r.v for r in df.select(cap_state_code("s").alias("v")).collect()] == ["CA", "NA", None]


def test_zero_sentinel_to_null(spark):
    df = spark.createDataFrame([("0.0",), ("0",), ("Mar-2019",), (None,)], "s string")
    assert [r.v for r in df.select(zero_sentinel_to_null("s").alias("v")).collect()] == \
        [None, None, "Mar-2019", None]
    assert df.select(zero_sentinel_to_null(F.col("s")).alias("v")).schema["v"].dataType.simpleString() == "string"


def test_text_to_double_parses_what_a_cast_does(spark):
    from lendscope.functions.text import text_to_double
    cells = ["0.0", " 1.5", "\t2", "-3", "+4", ".5", "1e3", "1d", "NaN", "nan", "Infinity", "-inf", "inf", "+Infinity",
             "Mar-2019", "n/a", "", " ", "none", "Iowa", " 1", "x", None, "0x1p3", "5."]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = df.select("i", text_to_double("c").cast("string").alias("a"), F.col("c").try_cast("double").cast("string").alias("b"))
    assert [r for r in got.collect() if r.a != r.b] == []
