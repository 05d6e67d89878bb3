"""Registered queries against their SQL twins.

Every query by default; ``ORACLE_ONLY`` names some of them.
"""

import os

import pytest

from oracle_compare import connect, differences

import __spark_entry__ as contract
from spendlever import oracle, queries as registered

CORE = registered.registry()
NAMES = os.environ["ORACLE_ONLY"].split(",") if "ORACLE_ONLY" in os.environ else list(CORE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(CORE) == set(oracle.statements())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]) == []
