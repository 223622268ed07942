"""Every query against its SQL answer; the others must give rows."""

import pytest

from proclivity.plans.queries import ORACLES, QUERIES
from tests.compare import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, duck, key):
    assert spark_rows(QUERIES[key](spark, SF)) == duck_rows(duck, ORACLES[key])


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, SF).count() > 0
