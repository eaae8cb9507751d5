import os, sys; sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
"""Every catalog query with an oracle SQL matches DuckDB on the sf0.001 tables."""
import pytest

from stratum.plans.catalog import REGISTRY
from oracle_harness import compare, duck

WITH_SQL = sorted(n for n, (_, sql) in REGISTRY.items() if sql)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, sf_dir, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, con, name, fn, sql, sf_dir)
    assert r["ok"], r
