"""Every registered query against its DuckDB oracle (sf0.001), and the
queries without an oracle against their batch equivalents."""

import os

import pytest

import __spark_entry__ as E
from changelake.plans import registry
from oracle_check import compare, duck

# sf0.001 keeps the suite quick; ORACLE_SF_DIR=/root/testdata/sf0.01 reproduces
# the driver's correctness scale.
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registry.ORACLE}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert r["ok"], r
    assert r["spark_rows"] == r["oracle_rows"]


def test_every_query_has_an_oracle():
    # Queries of optional parts have tests of their own.
    assert set(registry.QUERIES) == set(registry.ORACLE)
