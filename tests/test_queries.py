"""Every registered query against its SQL on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import difference, duck  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from riskflow.plans.catalog import QUERIES  # noqa: E402
from riskflow.plans.oracles import ORACLES  # noqa: E402

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[0] == "transaction_id" and frame.count() == 6_604


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLES[name]) is None
