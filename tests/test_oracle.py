"""Every registered query against its check SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import difference, duck

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
BUILDS, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(BUILDS))
def test_query(spark, con, name):
    df = BUILDS[name](spark, FOLDER)
    if name in CHECKS:
        assert difference(df, con, CHECKS[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1
