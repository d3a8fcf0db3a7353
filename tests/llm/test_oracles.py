"""Registered corpus queries against SQL, and the shape of all of them."""

import pytest
from llm_support import differs

from layerwell.llm.queries import QUERIES
from layerwell.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert differs(spark, SF_DIR, name) is None


def test_each_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
