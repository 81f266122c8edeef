"""Every query with SQL, run in Spark and in DuckDB over the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from oracle import compare, duck
from shoptrail.checks import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name], ORACLES[name], spark, FOLDER, con) is None


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
