"""Queries with a DuckDB twin, and all queries against brute force over sf0.001."""

from __future__ import annotations

import os

import duckdb
import pytest

from tidemark.llm import queries
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    out = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(out.columns)
    assert sorted(tuple(r[c] for c in columns) for r in out.collect()) == sorted(found.fetchall())
