"""Every registered query against the oracle, value for value."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from parity import compare, connect
from skyledger.plans import oracle as oracle_queries
from skyledger.plans import workload

SF = "/root/testdata/sf0.001"
QUERIES = workload.QUERIES
ORACLES = oracle_queries.ORACLES


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("key", QUERIES)
def test_parity(spark, oracle, key):
    ours, theirs, extra, missing = compare(QUERIES[key](spark, SF), oracle, ORACLES[key])
    assert (extra, missing) == ({}, {})
    assert ours == theirs > 0


def test_entry(spark):
    assert contract.entry(spark).columns[-1] == "risk_level"
