"""Catalogue queries against their SQL on the smallest tables. ``tests/check.py`` runs all of them on any size."""

import os

import pytest

import __spark_entry__ as entry
from check import differences, oracle_connection
from conftest import TINY

SLOW = ("stream_", "train_", "scored_", "training_labels", "score_rows", "feature_importance", "permutation", "stack_scores", "isotonic")
KEYS = [k for k in entry.oracle_sql() if os.environ.get("VIGIL_ALL") or not k.startswith(SLOW)]


@pytest.fixture(scope="module")
def con():
    return oracle_connection(TINY)


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, con, key):
    assert differences(entry.queries()[key](spark, TINY), con, entry.oracle_sql()[key]) == ""


def test_every_query_with_sql_is_known():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 15
