
import pytest

import __spark_entry__ as E
from rentlens.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

# The listings queries; the training-data operators have tests of their own.
QUERIES = {name: E.queries()[name] for name in registry.queries()}
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL.get(name), SF_SMALL, con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["number_of_beds", "avg_price", "n_listings"]
    assert df.count() > 0
