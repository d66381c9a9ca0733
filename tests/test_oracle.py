"""Each registered query against its SQL."""

import pytest
from oracle_check import compare, connect

from tidemark.plans.oracle import ORACLE
from tidemark.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


# 90 forests; ``oracle_check.py`` runs it, and ``message_grid`` stands for it here.
LONG = {"message_grid_notebook"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LONG))
def test_same_as_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None
