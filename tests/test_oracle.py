"""Every registered query against its DuckDB oracle on the smallest fixture."""

import pytest

from leadlens import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

registry.load_all()
QUERIES = dict(registry.QUERIES)
ORACLE = dict(registry.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLE)) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    msg, ok = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_SMALL, con)
    assert ok, msg
