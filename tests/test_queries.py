"""Every core query against its SQL; those without SQL must run."""

import pytest
from oracle import DATA, differences

from inkweir.plans import core_queries, edge_queries, time_queries

pytestmark = pytest.mark.skipif(not __import__("os").path.isdir(DATA), reason="no test tables here")
QUERIES = core_queries.registry.queries | edge_queries.registry.queries | time_queries.registry.queries
ORACLES = core_queries.registry.oracles | edge_queries.registry.oracles | time_queries.registry.oracles


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    only_here, only_there = differences(spark, QUERIES[name], ORACLES[name])
    assert not only_here and not only_there


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
