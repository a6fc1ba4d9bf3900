"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck  # noqa: E402

from lendscope.plans.oracle_sql import oracle_queries  # noqa: E402
from lendscope.plans.registry import all_queries  # noqa: E402

SQL = oracle_queries()
QUERIES = all_queries()
#: Queries whose result is empty by definition
EMPTY = {"not_in_null_list"}


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, sf_small, key):
    r = compare(spark, con, key, QUERIES[key], SQL[key], sf_small)
    assert r["ok"], r["problems"]
    assert (r["rows"] > 0) == (key not in EMPTY)


@pytest.mark.parametrize("key", ["database_introspection", "catalog_tables"])
def test_listing_leaves_out_temporary_views(spark, con, sf_small, key):
    """SHOW TABLES lists the session's temporary views with every database."""
    spark.range(1).createOrReplaceTempView("of_another_query")
    try:
        r = compare(spark, con, key, QUERIES[key], SQL[key], sf_small)
    finally:
        spark.catalog.dropTempView("of_another_query")
    assert r["ok"], r["problems"]
