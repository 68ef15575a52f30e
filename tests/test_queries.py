"""Every registered query gives the rows of its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import differences, oracle

import __spark_entry__ as contract
from airtally.plans.registry import ORACLES, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(contract.SMALL), reason="no test tables here")


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries()) >= set(QUERIES)
    without = set(QUERIES) - set(ORACLES)
    assert without == {"limit_rows", "stratified_sample", "random_split", "text_model_scores",
                       "text_model_quality", "text_top_scored", "text_top_terms"}


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_all_queries(spark):
    assert differences(spark, oracle(contract.SMALL), contract.SMALL, QUERIES, ORACLES) == {}
