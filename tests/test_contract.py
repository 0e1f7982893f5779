import pytest

import __spark_entry__ as contract
from checks import oracle
from checks.compare import compare, connect
from tests.conftest import SMALL

# Those of the separate subpackage have tests of their own.
STATEMENTS = oracle.statements()
QUERIES = {n: q for n, q in contract.queries().items() if n in STATEMENTS}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 15


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_statement(spark, duck, name):
    difference, note = compare(spark, duck, name, QUERIES[name], STATEMENTS[name], SMALL)
    assert difference is None, note
