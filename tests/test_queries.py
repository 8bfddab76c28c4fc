"""Every registered query against its SQL at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from clickloom import registered  # noqa: E402
from compare import difference, duck  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    oracle = entry.oracle_sql().get(name)
    if oracle is not None:
        assert difference(got, con.execute(oracle).df()) is None


def test_only_fitted_factors_have_no_sql():
    assert set(registered.QUERIES) - set(registered.ORACLES) == {"svd_item_factors"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
