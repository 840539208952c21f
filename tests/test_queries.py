"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__
from tests.oracle import differences, duck
from workload import ORACLE, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(df, connection, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_only_these_queries_have_no_sql():
    """Every query of the library has one."""
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
