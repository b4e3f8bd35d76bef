"""Every registered query against its oracle on the smallest test tables."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from tests.oracle import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


# The text operators and their pipeline have tests of their own.
OWN_TESTS = re.compile(r"op\d+_|pipeline$")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not OWN_TESTS.match(n)))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLE:
        assert difference(df, con, ORACLE[name]) is None
    else:
        assert df.count() >= 0
