"""Every query that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest
from oracle import connect, same

from quillbank.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_oracle(spark, con, name):
    same(spark, con, QUERIES[name], ORACLE_SQL[name])
