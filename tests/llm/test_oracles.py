"""Queries of the operators against their SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_oracles import compare, connect

from feedlake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name]) is None
