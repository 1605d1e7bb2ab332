"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks import QUERIES, SQL
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, con, name):
    mine = QUERIES[name](spark, SF).toPandas()
    assert len(mine) > 0
    assert difference(mine, con.execute(SQL[name]).fetchdf()) is None


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)
