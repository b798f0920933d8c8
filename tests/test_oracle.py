"""Every registered query against its SQL on the smallest tables."""

import inspect
import os

import pytest
import test_fitted

import __spark_entry__ as entry
import check
from tamarack import plans

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(plans.all_oracles()))
def test_query_agrees_with_sql(spark, name):
    problem, n, _, _ = check.difference(spark, FOLDER, name)
    assert problem is None
    assert n >= 0


def test_every_query_has_sql_or_a_brute_force_test():
    assert set(plans.all_queries()) == set(plans.all_oracles()) | set(plans.learning.FITTED)
    assert not set(plans.all_oracles()) & set(plans.learning.FITTED)
    held = inspect.getsource(test_fitted)
    assert all(f'"{name}"' in held for name in plans.learning.FITTED)
    assert set(plans.all_queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
