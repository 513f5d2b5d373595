"""State as a fold over observations (M-01, M-02, W-01, W-03, J-02, J-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W-01: the last row of each key; one aggregation, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return best.select(*keys, *(F.col(f"row.{c}").alias(c) for c in rest)).select(rows.columns)


def fold(observations: DataFrame, key: str = "dedup_key", commit: str = "seq", order: tuple[str, ...] = ("pos",), seen: str = "seen_at", content: str = "content_hash", run: str = "run_id", fixed: tuple[str, ...] = ("source", "external_id")) -> DataFrame:
    """The current rows: within a commit the last one counts; then first and last time seen, last values, revision.

    ``fixed`` columns keep their first value. revision is 1 and one more for each change of ``content``;
    last_changed_run is the run of the last change, or the first. first_content tells what a fold that follows a snapshot
    began with (see :func:`tidemark.plans.run.merge`).
    """
    rows = last_wins(observations, [key, commit], list(order))
    by = Window.partitionBy(key).orderBy(commit)
    before = F.lag(content).over(by)
    changed = before.isNull() | (F.col(content) != before)
    rows = rows.withColumn("_changed", F.when(changed, F.col(commit)))
    rest = [c for c in rows.columns if c not in (key, commit, seen, run, "_changed", *order, *fixed)]
    out = rows.groupBy(key).agg(
        *(F.min_by(c, commit).alias(c) for c in fixed),
        F.min(seen).alias("first_seen_at"),
        F.max(seen).alias("last_seen_at"),
        F.max_by(F.struct(*rest, run), commit).alias("_last"),
        F.count("_changed").alias("revision"),
        F.max_by(run, "_changed").alias("last_changed_run_id"),
        F.min_by(run, commit).alias("first_seen_run_id"),
        F.min(commit).alias("first_seq"),
        F.min_by(content, commit).alias("first_content"),
    )
    return out.select(key, *fixed, *(F.col(f"_last.{c}").alias(c) for c in rest), "first_seen_at", "last_seen_at", F.col(f"_last.{run}").alias("last_seen_run_id"), "first_seen_run_id", "last_changed_run_id", "revision", "first_seq", "first_content")


def upsert_actions(stored: DataFrame, incoming: DataFrame, key: str, content: str) -> DataFrame:
    """J-03: each key with its action: inserted, updated, unchanged or untouched."""
    old, new = stored.select(F.col(key), F.col(content).alias("_old")), incoming.select(F.col(key), F.col(content).alias("_new"))
    action = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "untouched").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("updated")
    return old.join(new, key, "full_outer").select(key, action.alias("action"))


def source_state(events: DataFrame) -> DataFrame:
    """M-02: the last state of each URL; a null count, etag or date keeps the one before."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("last_fetched_at")))
    return events.groupBy("url").agg(last("etag").alias("etag"), last("last_modified").alias("last_modified"), F.max("last_fetched_at").alias("last_fetched_at"), F.max_by("last_status", "last_fetched_at").alias("last_status"), last("last_item_count").alias("last_item_count"))


def task_states(ledger: DataFrame) -> DataFrame:
    """The tasks as the ledger's events leave them (M-04, M-05, M-09): claimed without an end is pending again."""
    event = lambda *names: F.col("event").isin(*names)
    done = F.max_by(F.struct("http_status", "not_modified", "items_seen", "items_valid", "items_quarantined"), F.when(event("done"), F.col("at")))
    out = ledger.filter(event("planned", "claimed", "done", "requeued", "failed")).groupBy("run_id", "task_key").agg(
        F.min("task_seq").alias("task_seq"),
        F.max(F.when(event("planned"), F.col("source"))).alias("source"),
        F.max(F.when(event("planned"), F.col("url"))).alias("url"),
        F.count_if(event("claimed")).alias("attempts"),
        F.min(F.when(event("claimed"), F.col("at"))).alias("started_at"),
        F.max(F.when(event("done", "failed"), F.col("at"))).alias("finished_at"),
        F.max_by("error", F.when(event("requeued", "failed"), F.col("at"))).alias("error"),
        done.alias("_done"),
        F.max(event("done")).alias("_is_done"),
        F.max(event("failed")).alias("_is_failed"),
    )
    state = F.when(F.col("_is_done"), "done").when(F.col("_is_failed"), "failed").otherwise("pending")
    counts = [F.coalesce(F.col(f"_done.{c}"), F.lit(0)).alias(c) for c in ("items_seen", "items_valid", "items_quarantined")]
    return out.select("run_id", "task_seq", "task_key", "source", "url", state.alias("state"), "attempts", "started_at", "finished_at", "error", F.col("_done.http_status").alias("http_status"), F.coalesce("_done.not_modified", F.lit(False)).alias("not_modified"), *counts)
