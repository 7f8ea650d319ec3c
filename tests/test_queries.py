"""Every registered query equals its SQL form on the smallest test folder."""

import pytest
from compare import differences, duck

from strataflow.catalog import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
