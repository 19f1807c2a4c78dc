"""Every registered query against its reference SQL, all values compared."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SQLS = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_reference_sql():
    optional = {n for n in queries() if n == "pipeline" or n.startswith("op")}
    assert set(queries()) - optional == set(SQLS) - optional


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", [n for n in queries() if n in SQLS])
def test_query(spark, duck, name):
    assert differences(queries()[name](spark, SF_DIR), duck, SQLS[name]) == []
