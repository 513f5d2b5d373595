"""The read side: each query is a function of tables and an explicit ``as_of`` (A-01 to A-23, T-01 to T-06, W-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.schema import SOURCE_LABELS, SOURCES

GOOD = ("succeeded", "partial")


def label_of(source: Column) -> Column:
    out = source
    for name, label in SOURCE_LABELS.items():
        out = F.when(source == name, label).otherwise(out)
    return out


def place_of(source: Column, sources: tuple[str, ...] = SOURCES) -> Column:
    """F-34: the position of a source in the fixed order; others come last."""
    out = F.lit(len(sources))
    for at, name in enumerate(sources):
        out = F.when(source == name, at).otherwise(out)
    return out


def latest_run(runs: DataFrame) -> DataFrame:
    """W-04."""
    return runs.orderBy(F.desc_nulls_last("started_at"), F.desc("id")).limit(1)


def totals(jobs: DataFrame, quarantine: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """A-01 to A-08 in one row: one pass over the jobs by fingerprint, one over the quarantine."""
    main = jobs.agg(
        F.count("*").alias("jobs"),
        F.countDistinct("company").alias("companies"),
        F.count("salary_min").alias("with_salary"),
        F.countDistinct("content_fingerprint").alias("distinct_groups"),
        F.count_if(F.col("first_seen_at") >= as_of - F.expr("INTERVAL 24 HOURS")).alias("added_24h"),
    )
    spans = jobs.groupBy("content_fingerprint").agg(F.countDistinct("source").alias("n")).agg(F.count_if(F.col("n") > 1).alias("cross_source_groups"))
    last = latest_run(runs).select(F.col("id").alias("_last"))
    bad = quarantine.join(last, F.col("run_id") == F.col("_last"), "left").agg(F.count("*").alias("quarantined"), F.count("_last").alias("quarantined_last_run"))
    out = main.join(F.broadcast(spans), F.lit(True)).join(F.broadcast(bad), F.lit(True))
    return out.withColumn("duplicates_collapsed", F.greatest(F.lit(0).cast("bigint"), F.col("jobs") - F.col("distinct_groups")))


def by_source(jobs: DataFrame, sources: tuple[str, ...] = SOURCES, others: bool = False) -> DataFrame:
    """A-09: the listed sources, in their order; those without jobs are left out. With ``others``, all other sources (null too) follow by name."""
    listed = jobs if others else jobs.filter(F.col("source").isin(*sources))
    out = listed.groupBy("source").agg(F.count("*").alias("count"))
    return out.select("source", label_of(F.col("source")).alias("label"), "count").orderBy(place_of(F.col("source"), sources), "source")


def daily(jobs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """A-10, A-11, J-05: day, source, n for each day of the axis and each source seen on it, zeros included."""
    today = F.to_date(as_of)
    seen = jobs.select(F.to_date("first_seen_at").alias("day"), "source").filter((F.col("day") > F.date_sub(today, days)) & (F.col("day") <= today))
    counts = seen.groupBy("day", "source").agg(F.count("*").alias("n"))
    sources = counts.select("source").distinct()
    axis = sources.withColumn("day", F.explode(F.sequence(F.date_sub(today, days - 1), today)))
    return axis.join(counts, ["day", "source"], "left").select("day", "source", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def daily_series(jobs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """A-11: source, label, series (one count for each day of the axis, in order)."""
    rows = daily(jobs, as_of, days).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("day", "n"))).alias("s"))
    return rows.select("source", label_of(F.col("source")).alias("label"), F.transform("s", lambda x: x["n"]).alias("series")).orderBy(place_of(F.col("source")))


def run_history(runs: DataFrame, limit: int = 30) -> DataFrame:
    """W-05: the last runs, the oldest first."""
    return runs.orderBy(F.desc_nulls_last("started_at"), F.desc("id")).limit(limit).orderBy("started_at", "id")


def top_companies(jobs: DataFrame, limit: int = 12) -> DataFrame:
    """A-12."""
    out = jobs.groupBy("company").agg(F.count("*").alias("count"), F.countDistinct("source").alias("sources"))
    return out.orderBy(F.desc("count"), "company").limit(limit)


def quarantine_breakdown(quarantine: DataFrame, limit: int = 10) -> DataFrame:
    """A-13; ties go by code and source."""
    out = quarantine.groupBy(F.col("reason_code").alias("code"), "source").agg(F.count("*").alias("count"), F.min("reason").alias("example"))
    return out.orderBy(F.desc("count"), "code", "source").limit(limit).select("code", "source", label_of(F.col("source")).alias("label"), "count", "example")


def recent_quarantine(quarantine: DataFrame, limit: int = 20) -> DataFrame:
    """T-02."""
    return quarantine.orderBy(F.desc("created_at"), F.desc("task_key"), F.desc("pos")).limit(limit)


def duplicate_groups(jobs: DataFrame, limit: int = 10, shown: int = 50) -> DataFrame:
    """A-14, A-15, J-01: the groups spanning most sources, then the largest, with the number of their rows and the first ``shown`` nested.

    One junk text may be repeated any number of times: ranks are limited before the shuffle, so no group is gathered whole.
    """
    size = jobs.groupBy("content_fingerprint").agg(F.countDistinct("source").alias("sources"), F.count("*").alias("n")).filter("n > 1")
    top = size.orderBy(F.desc("sources"), F.desc("n"), "content_fingerprint").limit(limit)
    row = F.struct("source", label_of(F.col("source")).alias("label"), "company", "title", "url")
    members = jobs.join(F.broadcast(top), "content_fingerprint").select("content_fingerprint", "sources", "n", row.alias("row"))
    first = members.withColumn("rank", F.row_number().over(Window.partitionBy("content_fingerprint").orderBy("row"))).filter(F.col("rank") <= shown)
    out = first.groupBy("content_fingerprint", "sources", "n").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    first, spans = F.element_at("rows", 1), F.col("sources") > 1
    return out.select(
        F.substring("content_fingerprint", 1, 12).alias("fingerprint"), first["company"].alias("company"), first["title"].alias("title"), "n", "rows",
        spans.alias("spans_sources"), F.when(spans, "across sources").otherwise("same source, repeated").alias("kind"),
    ).orderBy(F.desc("spans_sources"), "fingerprint")


def recent_jobs(jobs: DataFrame, limit: int = 40, source: str | None = None, search: str | None = None) -> DataFrame:
    """T-01, P-03, P-04."""
    if source:
        jobs = jobs.filter(F.col("source") == source)
    if search:
        pattern = text.like_pattern(search)
        jobs = jobs.filter(F.lower("title").like(pattern) | F.lower("company").like(pattern))
    return jobs.orderBy(F.desc("first_seen_at"), F.desc("first_seq"), F.desc("dedup_key")).limit(limit)


def task_timings(tasks: DataFrame, run_id: str) -> DataFrame:
    """T-03."""
    return tasks.filter(F.col("run_id") == run_id).orderBy("task_seq")


def task_histogram(tasks: DataFrame) -> DataFrame:
    """A-16."""
    return tasks.groupBy("state").agg(F.count("*").alias("n"))


def streak(days: DataFrame, today: Column) -> DataFrame:
    """W-02: how many days in a row, back from today, are among ``days`` (day); today may still be missing."""
    numbered = days.select(F.col("day")).distinct().filter(F.col("day") <= today)
    numbered = numbered.withColumn("island", F.date_add("day", F.row_number().over(Window.orderBy(F.desc("day"))).cast("int")))
    # Days in a row share an island; the one that matters is that of today, or of yesterday if today is missing.
    last = numbered.groupBy("island").agg(F.max("day").alias("end"), F.count("*").alias("n"))
    return last.filter(F.col("end") >= F.date_sub(today, 1)).agg(F.coalesce(F.max_by("n", "end"), F.lit(0).cast("bigint")).alias("consecutive_days"))


def health(runs: DataFrame, as_of: Column, stale_after_hours: int = 30) -> DataFrame:
    """H-06, F-28, A-23: one row: state, label, last success and its age, days in a row."""
    good = F.col("status").isin(*GOOD) & F.col("finished_at").isNotNull()
    last = runs.agg(
        F.max_by(F.struct("finished_at", "status"), F.when(good, F.struct("finished_at", "id"))).alias("ok"),
        F.max_by("status", F.struct("started_at", "id")).alias("last_status"),
    )
    hours = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ok.finished_at").cast("timestamp"))) / 3_600_000_000
    last = last.withColumn("age", hours)
    stale = F.col("age") > stale_after_hours
    state = F.when(F.col("ok").isNull() | stale, "critical").when((F.col("last_status") == "failed") | (F.col("ok.status") == "partial"), "warning").otherwise("good")
    label = (
        F.when(F.col("ok").isNull(), "No run has ended well yet")
        .when(stale, F.concat(F.lit("Out of date: last good run "), text.humanise_hours(F.col("age")), F.lit(" ago")))
        .when(F.col("last_status") == "failed", "The last run failed, what is there is recent")
        .when(F.col("ok.status") == "partial", "Some tasks of the last run failed")
        .otherwise(F.concat(F.lit("Up to date: last good run "), text.humanise_hours(F.col("age")), F.lit(" ago")))
    )
    days = streak(runs.filter(good).select(F.to_date("finished_at").alias("day")), F.to_date(as_of))
    out = last.select(state.alias("state"), label.alias("label"), F.col("ok.finished_at").alias("last_success_at"), F.col("age").alias("last_success_age_hours"), F.lit(stale_after_hours).alias("stale_after_hours"))
    return out.join(F.broadcast(days), F.lit(True))


def recount(jobs: DataFrame, run_id: str) -> DataFrame:
    """A-20: what a run did to the jobs, from the jobs themselves."""
    mine = F.col("last_seen_run_id") == run_id
    new = mine & (F.col("first_seen_run_id") == run_id)
    changed = mine & ~F.coalesce(new, F.lit(False)) & (F.col("last_changed_run_id") == run_id)
    return jobs.agg(F.count_if(mine).alias("touched"), F.count_if(new).alias("inserted"), F.count_if(changed).alias("updated"), (F.count_if(mine) - F.count_if(new) - F.count_if(changed)).alias("unchanged"))
