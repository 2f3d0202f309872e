"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest
from conftest import SF_MID, SF_SMALL
from oracle import compare, duck

import __spark_entry__ as E
from chirpstat.plans.registry import ORACLE_SQL, QUERIES

NAMES = list(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["author_id", "author_username", "tweet_sayisi"]
    assert df.count() > 0


@pytest.fixture(scope="module", params=[SF_SMALL, SF_MID])
def con(request):
    return request.param, duck(request.param)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sf, c = con
    ok, msg = compare(QUERIES[name](spark, sf), c, ORACLE_SQL[name])
    assert ok, f"{name} @ {sf}: {msg}"
