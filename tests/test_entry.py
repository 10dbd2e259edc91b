"""The driver contract on the smallest tables."""

import pytest

import __spark_entry__ as entry
from ledgerloom.plans.registry import QUERIES
from oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_duckdb(spark, con, key):
    ok, note = compare(spark, con, FOLDER, key, entry.queries()[key], entry.oracle_sql().get(key))
    assert ok, note


@pytest.mark.parametrize("key", ["search_all"])
def test_limits_take_effect_on_a_larger_table(spark, key):
    folder = "/root/testdata/sf0.01"
    ok, note = compare(spark, duck(folder), folder, key, entry.queries()[key], entry.oracle_sql()[key])
    assert ok, note
