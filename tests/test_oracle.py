"""Every registered query against its oracle on the driver's smallest tables."""

import pytest
from compare import compare, oracle_connection

from registry import all_oracles, all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, SF_DIR, name, con) is None


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_oracles())))
def test_query_without_oracle_has_rows(spark, name):
    assert not all_queries()[name](spark, SF_DIR).isEmpty()
