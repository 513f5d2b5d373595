"""The verdict on a run (H-01 to H-05, A-17 to A-22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_QUARANTINE_RATE = 0.25
PARSER_HEALTH_RATIO = 0.2
LEAST_BASELINE = 10
LOOKBACK = 10


def baselines(runs: DataFrame, tasks: DataFrame, lookback: int = LOOKBACK, count_unchanged: bool = False) -> DataFrame:
    """A-17, J-04, W-07: source, baseline: the median of valid items over the last good runs.

    Tasks answered "not modified" say nothing of a parser and are left out, unless ``count_unchanged``.
    """
    recent = runs.filter(F.col("status").isin("succeeded", "partial")).orderBy(F.desc("started_at"), F.desc("id")).limit(lookback).select(F.col("id").alias("run_id"))
    rows = tasks.join(F.broadcast(recent), "run_id", "left_semi")
    if not count_unchanged:
        rows = rows.filter(~F.coalesce("not_modified", F.lit(False)))
    sums = rows.groupBy("run_id", "source").agg(F.sum("items_valid").alias("n"))
    return sums.groupBy("source").agg(F.median("n").alias("baseline"))


def all_unchanged() -> Column:
    """A-19: of the tasks that went well, all were "not modified", and there was one at least."""
    return F.coalesce(F.expr("bool_and(not_modified) FILTER (WHERE ok)"), F.lit(False))


def checks(outcomes: DataFrame, base: DataFrame, planned: DataFrame | None = None, max_rate: float = MAX_QUARANTINE_RATE, ratio: float = PARSER_HEALTH_RATIO) -> DataFrame:
    """name, ok, value, threshold, detail of every check of a run.

    ``planned`` (source) restricts the parser checks to sources that the run meant to read.
    """
    whole = outcomes.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("items_seen", "items_valid", "items_quarantined")), all_unchanged().alias("unchanged")
    )
    rate = F.coalesce(F.try_divide("items_quarantined", "items_seen"), F.lit(0.0))
    line = lambda name, ok, value, threshold, detail: F.struct(name.alias("name"), ok.alias("ok"), value.cast("double").alias("value"), threshold.cast("double").alias("threshold"), detail.alias("detail"))
    none = F.lit(None)
    first = whole.select(
        F.inline(
            F.array(
                line(F.lit("quarantine_rate"), rate <= max_rate, F.round(rate, 4), F.lit(max_rate), F.format_string("%d out of %d records were set aside", "items_quarantined", "items_seen")),
                line(F.lit("non_empty"), (F.col("items_valid") > 0) | F.col("unchanged"), F.col("items_valid"), none,
                     F.when(F.col("unchanged"), "nothing has changed at any source").otherwise(F.format_string("%d records are good", "items_valid"))),
            )
        )
    )
    sources = outcomes.groupBy("source").agg(
        F.expr("bool_and(NOT ok)").alias("down"), all_unchanged().alias("unchanged"), F.coalesce(F.sum("items_valid"), F.lit(0)).alias("current"), F.count("*").alias("n"),
        F.substring(F.array_join(F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("error")))), "; "), 1, 300).alias("errors"),
    )
    down = sources.filter("down").select(
        F.concat(F.lit("source_reachable:"), "source").alias("name"), F.lit(False).alias("ok"), F.lit(0.0).alias("value"), F.lit(None).cast("double").alias("threshold"),
        F.format_string("%s: all tasks failed (%d): %s", "source", "n", "errors").alias("detail"),
    )
    if planned is not None:
        base = base.join(planned.select("source").distinct(), "source", "left_semi")
    floor = F.col("baseline") * ratio
    current = F.coalesce("current", F.lit(0))
    parser = base.filter(F.col("baseline") >= LEAST_BASELINE).join(sources, "source", "left").select(
        F.concat(F.lit("parser_health:"), "source").alias("name"), ((current >= floor) | F.coalesce("unchanged", F.lit(False))).alias("ok"),
        current.cast("double").alias("value"), F.round(floor, 1).alias("threshold"),
        F.format_string("%s: %d good records against a median of %.0f", F.col("source"), current, F.col("baseline")).alias("detail"),
    )
    return first.unionByName(down).unionByName(parser)


def status(checks_: DataFrame, outcomes: DataFrame) -> DataFrame:
    """H-05: one row: status, failed_checks."""
    bad = checks_.agg(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("name")))).alias("failed_checks"))
    some = outcomes.agg(F.count_if(~F.col("ok")).alias("failed_tasks"))
    word = F.when(F.size("failed_checks") > 0, "failed").when(F.col("failed_tasks") > 0, "partial").otherwise("succeeded")
    return bad.join(F.broadcast(some), F.lit(True)).select(word.alias("status"), "failed_checks", "failed_tasks")
