"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from brookmart.oracles import ORACLES
from brookmart.queries import QUERIES
from check import compare, connect


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, db, sf_dir, name):
    assert compare(spark, db, name, sf_dir).startswith("ok")


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
