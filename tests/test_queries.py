"""Every registered query of the reference operators against its SQL."""

import pytest

from oracle.sql import oracle_sql
from termfold.plans.queries import queries
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


QUERIES, ORACLE = queries(), oracle_sql()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""
