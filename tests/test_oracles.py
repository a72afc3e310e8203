import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract  # noqa: E402
from quayside.bindings import oracles, queries  # noqa: E402
from check_oracles import connect, difference  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) == set(oracles.ORACLES)
    assert set(queries.QUERIES) <= set(contract.queries())
    assert set(oracles.ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", queries.QUERIES)
def test_same_as_sql(spark, con, sf_dir, name):
    problem = difference(spark, con, name, sf_dir)
    # The smallest tables leave some of the narrow queries empty.
    assert problem in (None, "no rows on either side")
