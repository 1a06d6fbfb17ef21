"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from sluice.plans import registry

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="session")
def duck(medium):
    return connect(medium)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, medium, name):
    df = QUERIES[name](spark, medium)
    assert differences(df, duck, ORACLE[name]) == []
    assert not df.isEmpty()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
