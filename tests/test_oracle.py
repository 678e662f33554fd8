
import pytest

import __spark_entry__ as E
from martforge.plans.catalog import ORACLE_SQL, QUERIES

from .conftest import ORACLE_SF
from .oracle import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(ORACLE_SF)


def test_every_query_has_oracle_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], ORACLE_SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["p_size", "p_partkey", "total_qty", "sales_rank"]
    assert df.count() > 0
