"""Every registered query against its SQL counterpart on the driver's tables."""

import pytest

import __spark_entry__ as entry
from compare import database, differences
from conftest import SF_DIR


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_a_counterpart():
    assert entry.QUERIES.keys() == entry.ORACLE.keys()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert differences(entry.queries()[name](spark, SF_DIR), db, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
