"""Operators that SQL can express, next to that SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

from check_oracles import connect, difference  # noqa: E402

from quayside.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", queries.ORACLES)
def test_same_as_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), name, sf_dir) is None
