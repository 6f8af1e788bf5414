import os

import pytest

import __spark_entry__ as contract
import checks.oracles
import checks.queries
from tests.compare import oracle_rows, spark_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
NAMES = sorted(checks.queries.QUERIES)
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


def test_entry(spark):
    assert contract.entry(spark).count() == 3


def test_every_oracle_has_a_query():
    assert set(checks.oracles.ORACLES) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    columns, rows, _ = spark_rows(QUERIES[name](spark, SF_DIR))
    assert rows
    expected_columns, expected, _ = oracle_rows(ORACLES[name], SF_DIR)
    assert columns == expected_columns
    assert rows == expected
