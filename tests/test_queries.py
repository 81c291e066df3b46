"""Every registered query against its DuckDB oracle on the smallest test tables."""
import pytest

import __spark_entry__ as entry_mod
from ledgerlight.plans.registry import load_all
from oracle.compare import compare
from oracle.duck import connect
from tests.conftest import SF_SMALL

QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


def test_every_query_of_the_models_has_an_oracle():
    assert set(load_all()) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = compare(df, duck.execute(ORACLE[name]).fetchdf())
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "query_cost" in df.columns
