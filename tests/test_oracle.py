"""Every query that SQL can state gives exactly what its DuckDB statement gives."""

import __spark_entry__ as registry
import pytest
from check import differences


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_statement(spark, sf_dir, name):
    assert differences(spark, sf_dir, name) == []


def test_statements_belong_to_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() == 15
