"""Every registered query against its SQL twin."""

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as entry
from catalog.oracles import all_oracles
from catalog.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, connection, name):
    frame = entry.queries()[name](spark, SF_DIR)
    assert differences(frame, connection, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
