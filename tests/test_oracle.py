"""Every registered query equals its DuckDB oracle on the small test tables."""

import pytest

import __spark_entry__ as entry
from colloquy.plans.oracle import compare, duckdb_with_views

from colloquy.plans.registry import ORACLE_SQL as ORACLES
from colloquy.plans.registry import QUERIES

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duckdb_with_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert r["ok"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and df.columns[:2] == ["subset", "transcript_version"] and rows[-1]["subset"] == "ALL"
