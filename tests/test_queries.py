"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from flatspark.queries import ORACLES, load_all
from flatspark.queries import QUERIES as OWN
from oracle import compare, connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
load_all()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    with connection(SF) as c:
        yield c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) == set(ORACLES)


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
