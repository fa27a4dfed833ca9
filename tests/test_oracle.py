"""Every registered query against its oracle SQL on whole tables of the smallest scale."""

from __future__ import annotations

import pytest

from gridloom.checks.catalog import all_oracles, all_queries
from tests.oracle import check, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_oracle(spark, oracle, name):
    problem, rows, _, _ = check(spark, oracle, SF_DIR, name, all_queries()[name], all_oracles().get(name))
    assert not problem
    assert rows >= 0


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
