"""Every query with an SQL form gives the same names, types and values in DuckDB."""

import pytest
from compare_engines import connect, differences
from conftest import SMALL

from lastmile.plans.oracles import ORACLES
from lastmile.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []
