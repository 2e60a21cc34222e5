"""Every registered query against its SQL on the smallest test tables."""

import oracle_check
import pytest

import __spark_entry__ as entry_module

SF_DIR = entry_module.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


def test_each_query_has_sql():
    # Queries that SQL cannot express have tests of their own.
    assert set(entry_module.queries()) - set(entry_module.TEXT_QUERIES) == set(
        entry_module.oracle_sql()
    ) - set(entry_module.TEXT_ORACLES)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    frame = entry_module.queries()[name](spark, SF_DIR)
    assert oracle_check.difference(frame, entry_module.oracle_sql()[name], con) is None


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
