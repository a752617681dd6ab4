"""Every registered query against its SQL; those without are run."""

import pytest

from gavelframe.plans import registry
from oracle import both, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    if name not in registry.ORACLE_SQL:
        assert registry.QUERIES[name](spark, SF).count() > 0
        return
    mine, theirs = both(spark, con, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)
    assert mine[1] == theirs[1]
    assert mine[0] == theirs[0]


@pytest.mark.parametrize("name", sorted(registry.CASES))
def test_case(spark, con, name):
    """Queries on invented rows, which show single cases."""
    run, sql = registry.CASES[name]
    mine, theirs = both(spark, con, run, sql, SF)
    assert mine == theirs
