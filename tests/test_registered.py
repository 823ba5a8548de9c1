"""Every registered query against its SQL, on the smallest provided tables."""

import os

import pytest

import __spark_entry__ as entry_module
from forumlake_checks.compare import database, differences
from forumlake_checks.oracle import ORACLE
from forumlake_checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(entry_module.queries()[name](spark, SF_DIR), con, entry_module.oracle_sql()[name]) == []
