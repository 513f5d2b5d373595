"""What all sources share: fetched bodies in, records out (S-01, S-07, U-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text


def records(rows: DataFrame, source: str, external_id: Column, payload: Column, error: Column, code: Column, raw: Column) -> DataFrame:
    """Rows of the RECORD schema from rows with task_key and pos; a record has a payload or a parse error, never both."""
    none = F.array().cast("array<string>")
    rows = text.once(rows, "_found", F.struct(payload.alias("payload"), error.alias("error")))
    return rows.select(
        "task_key",
        F.lit(source).alias("source"),
        F.col("pos").cast("bigint").alias("pos"),
        external_id.alias("external_id"),
        F.when(F.col("_found.error").isNull(), F.col("_found.payload")).alias("payload"),
        none.alias("extra_keys"),
        none.alias("missing_keys"),
        F.col("_found.error").alias("parse_error"),
        code.alias("error_code"),
        raw.alias("raw"),
    )


def fresh(landing: DataFrame) -> DataFrame:
    """Bodies to parse: those fetched, and changed since the last time."""
    return landing.filter("status = 200 AND error IS NULL")


def unchanged(landing: DataFrame) -> DataFrame:
    return landing.filter("status = 304")


def parse_all(landing: DataFrame) -> DataFrame:
    """Records of all sources over the changed bodies."""
    from tidemark.sources import REGISTRY

    own = fresh(landing)
    out = None
    for source in REGISTRY.values():
        part = source.parse(own)
        out = part if out is None else out.unionByName(part)
    return out


def problems(landing: DataFrame) -> DataFrame:
    """task_key, error of the bodies that no parser can read at all, and of those that weren't fetched."""
    from tidemark.sources import REGISTRY

    own = fresh(landing)
    out = landing.filter("error IS NOT NULL").select("task_key", "error")
    for source in REGISTRY.values():
        out = out.unionByName(source.problems(own))
    return out
