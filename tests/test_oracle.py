"""Every registered query against its SQL on the supplied tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.support import compare, oracle
from tickloom.plans import catalog, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WITHOUT_SQL = {"clusters"}


@pytest.fixture(scope="module")
def db():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert compare(frame, db, oracles.SQL[name]) is None


def test_every_query_has_sql_or_is_known_not_to():
    assert set(catalog.registered()) - set(oracles.SQL) == WITHOUT_SQL
    assert set(catalog.registered()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_a_row_per_day(spark):
    assert contract.entry(spark).count() == 30
