"""The text queries that SQL can say give the rows of their SQL."""

from __future__ import annotations

import os

import pytest
from compare import differences, oracle

from airtally.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_text_queries_equal_their_sql(spark):
    assert set(queries.ORACLES) == {"op5_topk", "op11_search", "op12_divergence"}
    assert differences(spark, oracle(FOLDER), FOLDER, queries.QUERIES, queries.ORACLES, list(queries.ORACLES)) == {}
