"""Every registered query against its SQL on the smallest test data."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from checks.compare import differences, oracle
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_ten_categories(spark):
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    assert differences(spark, duck, name, SF_DIR) == []
