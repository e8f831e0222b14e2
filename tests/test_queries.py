"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from feedlake.plans.oracles import ORACLES
from feedlake.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
