"""The queries with SQL, and that every operator and the pipeline are registered once."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__  # noqa: E402
from oracle import compare, duck  # noqa: E402
from shoptrail.llm import queries as text_queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are absent")
@pytest.mark.parametrize("name", sorted(text_queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(text_queries.QUERIES[name], text_queries.ORACLES[name], spark, FOLDER, duck(FOLDER)) is None
