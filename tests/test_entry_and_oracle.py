"""Driver contract and the DuckDB oracle for every registered query (small scale factor)."""
import os

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert set(df.columns) == {"query_chain", "cath_id", "count"}
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    from foldframe.plans.registry import all_queries, all_sql

    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(E.queries()) and set(all_sql()) <= set(E.oracle_sql())
    assert len(all_queries()) >= 102


def _keys():
    from foldframe.plans.registry import all_queries

    return sorted(all_queries())


@pytest.fixture(scope="module")
def duck():
    from foldframe.plans.oracle import duck as make

    return make(SF_SMALL)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    from foldframe.plans.oracle import compare

    res = compare(spark, key, SF_SMALL, duck)
    assert res["equal"], res
