"""Every registered query against its SQL, over the whole given tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(contract.REGISTRY) == set(contract.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.REGISTRY))
def test_same_rows_as_sql(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    assert differences(result, duck, contract.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
