"""Every registered query beside its SQL on the smallest driver tables."""

from pathlib import Path

import pytest
from compare import compare, duck

from pulsegrid.catalog import load_all

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load_all()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    why = compare(spark, con, SF, name, QUERIES[name], SQL[name])
    assert why is None or why == "both empty", why


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
