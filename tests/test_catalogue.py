"""Every query with a DuckDB twin must return the twin's rows."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions import batches, text
from tidemark.plans import catalogue, feed_catalogue  # noqa: F401
from tests.conftest import SF


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows_of(columns, rows):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    return order, sorted((tuple(r[i] for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_twin(spark, twin, name):
    out = catalogue.QUERIES[name](spark, SF)
    found = twin.execute(catalogue.ORACLES[name])
    expected = rows_of([d[0] for d in found.description], found.fetchall())
    assert rows_of(out.columns, out.collect()) == expected


def test_by_source_counts_every_source(spark, tmp_path):
    rows = [(i, "a text", ["src3", "src20", "other", None][i % 4], 6) for i in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.source, r.label, r["count"]) for r in catalogue.QUERIES["by_source"](spark, str(tmp_path)).collect()]
    assert got == [("src3", "src3", 2), (None, None, 2), ("other", "other", 2), ("src20", "src20", 2)]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_texts_reach_python_in_bounded_batches(spark, tmp_path, monkeypatch):
    """Each text becomes the number of characters that came with it."""

    @F.pandas_udf("string")
    def sizes(values):
        return values.map(lambda _: str(int(values.str.len().sum())), na_action="ignore")

    spark.createDataFrame([(i, "é" * 100_000) for i in range(60)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.unset(batches.BATCH_KEY)
    monkeypatch.setattr(text, "strip_accents", sizes)
    found = [int(r.normal) for r in catalogue.QUERIES["normalized_text"](spark, str(tmp_path)).collect()]
    assert len(found) == 60 and max(found) * 2 < batches.BATCH_BYTES + 200_000
