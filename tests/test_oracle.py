"""Every registered operator equals its DuckDB oracle on the driver tables."""

import pytest
from oracle_harness import compare

from tallyspark.oracle import oracle_sql
from tallyspark.plans.registry import queries

QUERIES = queries()
ORACLE = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 90  # 91 operators of the reference; 93 reads no table (library function)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, sf_dir, key):
    ok, msg = compare(QUERIES[key](spark, sf_dir), con, ORACLE[key])
    assert ok, msg
