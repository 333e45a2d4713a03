"""Every registered query against its DuckDB oracle, at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle_check import compare, duck
from twinrun.plans.fixture_queries import QUERIES
from twinrun.plans.fixture_sql import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF["0.001"])


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF["0.001"])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["intended", "unfixed", "regressed", "matched"]
    assert tuple(df.first()) == (57, 0, 0, 5885)
