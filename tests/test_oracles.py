"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest
from compare import compare, oracle_connection

from headway import catalogue, oracles

SQL = oracles.all_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_oracle(spark, database, sf_dir, name):
    assert compare(spark, database, catalogue.QUERIES[name], SQL[name], sf_dir) == ""
