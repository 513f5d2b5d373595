"""A run: plan, claim, parse, validate, commit, judge, finish; resumable at every commit (M-03 to M-12, H-05).

Every function takes the landing rows as a DataFrame. All the bodies of a step are one plan; the driver only
decides what the next commit is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import requests
from tidemark.operators import fold, validate, verdict
from tidemark.plans.store import Store
from tidemark.sources import landing as landed

MAX_ATTEMPTS = 3
RESUME_WITHIN = timedelta(hours=12)
MAX_ERROR = 4000


@dataclass(frozen=True)
class Settings:
    """S-12."""

    max_attempts: int = MAX_ATTEMPTS
    max_quarantine_rate: float = verdict.MAX_QUARANTINE_RATE
    parser_health_ratio: float = verdict.PARSER_HEALTH_RATIO
    stale_after_hours: int = 30
    lease_seconds: float = 300
    requests_at_once: int = 8
    request_timeout: float = 30.0
    request_attempts: int = 5
    backoff_base: float = 1.0
    backoff_cap: float = 60.0
    heed_robots: bool = True
    agent: str = "tidemark/1"
    threads: int = 2
    sources: tuple[str, ...] = schema.SOURCES

    @classmethod
    def from_env(cls, env: dict[str, str]) -> Settings:
        n = requests.env_number
        return cls(
            n(env.get("MAX_ATTEMPTS"), cls.max_attempts), n(env.get("MAX_QUARANTINE_RATE"), cls.max_quarantine_rate, float), n(env.get("PARSER_HEALTH_RATIO"), cls.parser_health_ratio, float),
            n(env.get("STALE_AFTER_HOURS"), cls.stale_after_hours), n(env.get("LEASE_SECONDS"), cls.lease_seconds, float),
            n(env.get("REQUESTS_AT_ONCE"), cls.requests_at_once), n(env.get("REQUEST_TIMEOUT"), cls.request_timeout, float), n(env.get("REQUEST_ATTEMPTS"), cls.request_attempts),
            n(env.get("BACKOFF_BASE"), cls.backoff_base, float), n(env.get("BACKOFF_CAP"), cls.backoff_cap, float), requests.env_bool(env.get("HEED_ROBOTS"), cls.heed_robots),
            env.get("AGENT") or cls.agent, n(env.get("THREADS"), cls.threads), tuple(s.strip() for s in env.get("SOURCES", "").split(",") if s.strip()) or cls.sources,
        )

    def fetcher(self):
        """S-12: a fetcher by these settings."""
        from functools import partial

        from tidemark.sources import fetch

        return fetch.Fetcher(partial(fetch.over_http, timeout=self.request_timeout), attempts=self.request_attempts, base=self.backoff_base, cap=self.backoff_cap, at_once=self.requests_at_once, agent=self.agent, heed_robots=self.heed_robots)


def _events(store: Store, rows: list[dict]) -> DataFrame:
    return store.spark.createDataFrame([{f: r.get(f) for f in schema.LEDGER.names} for r in rows], schema.LEDGER)


# -- views over the log -----------------------------------------------------------


def jobs(store: Store) -> DataFrame:
    """The current postings: a fold over the log, from the last snapshot on."""
    upto, snapshot = store.last_snapshot()
    new = fold.fold(store.read("observations", upto))
    return new if snapshot is None else merge(snapshot, new)


def merge(snapshot: DataFrame, new: DataFrame) -> DataFrame:
    """A snapshot and the fold of what came after it; both have one row for each key."""
    old = snapshot.select("dedup_key", F.struct(*snapshot.columns).alias("o"))
    now = new.select("dedup_key", F.struct(*new.columns).alias("n"))
    o, n = lambda c: F.col(f"o.{c}"), lambda c: F.col(f"n.{c}")
    both = old.join(now, "dedup_key", "full_outer")
    # The first of the new revisions isn't one if it began with the snapshot's content.
    same = F.when(o("content_hash") == n("first_content"), -1).otherwise(0)
    special = {
        "first_seen_at": F.least(o("first_seen_at"), n("first_seen_at")),
        "last_seen_at": F.greatest(o("last_seen_at"), n("last_seen_at")),
        "revision": F.coalesce(o("revision"), F.lit(0)) + F.coalesce(n("revision") + same, F.lit(0)),
        "first_seq": F.least(o("first_seq"), n("first_seq")),
        "source": F.coalesce(o("source"), n("source")),
        "external_id": F.coalesce(o("external_id"), n("external_id")),
        "first_seen_run_id": F.coalesce(o("first_seen_run_id"), n("first_seen_run_id")),
        "first_content": F.coalesce(o("first_content"), n("first_content")),
        "last_changed_run_id": F.when(n("revision") + same == 0, o("last_changed_run_id")).otherwise(F.coalesce(n("last_changed_run_id"), o("last_changed_run_id"))),
    }
    present = F.col("n").isNotNull()
    return both.select("dedup_key", *(special.get(c, F.when(present, n(c)).otherwise(o(c))).alias(c) for c in snapshot.columns if c != "dedup_key"))


def tasks(store: Store) -> DataFrame:
    return fold.task_states(store.read("ledger"))


def quarantine(store: Store) -> DataFrame:
    return store.read("quarantine")


def source_state(store: Store) -> DataFrame:
    return fold.source_state(store.read("source_state"))


def runs(store: Store) -> DataFrame:
    """One row for each run; counters are sums over its tasks, so they can't drift from them."""
    events = store.read("ledger")
    is_ = lambda e: F.col("event") == e
    mine = events.groupBy(F.col("run_id").alias("id")).agg(
        F.min(F.when(is_("started"), F.col("at"))).alias("started_at"), F.max(F.when(is_("finished"), F.col("at"))).alias("finished_at"),
        F.max_by("detail", F.when(is_("finished"), F.col("at"))).alias("status"), F.max_by("error", F.when(is_("finished"), F.col("at"))).alias("error"),
    )
    counts = fold.task_states(events).groupBy(F.col("run_id").alias("id")).agg(
        F.count("*").alias("tasks_total"), F.count_if(F.col("state") == "done").alias("tasks_done"), F.count_if(F.col("state") == "failed").alias("tasks_failed"),
        *(F.sum(c).alias(c) for c in ("items_seen", "items_valid", "items_quarantined")),
    )
    return mine.join(counts, "id", "left").withColumn("status", F.coalesce("status", F.lit("running")))


def view_status(runs_: DataFrame, as_of: datetime) -> DataFrame:
    """Runs left running for longer than one may be resumed are abandoned, in the view."""
    old = (F.col("status") == "running") & (F.col("started_at") < F.lit(as_of - RESUME_WITHIN))
    return runs_.withColumn("status", F.when(old, "abandoned").otherwise(F.col("status")))


# -- steps ------------------------------------------------------------------------


def resumable(store: Store, now: datetime) -> str | None:
    """T-06, T-07: the newest run that is still running and not too old."""
    row = runs(store).filter((F.col("status") == "running") & (F.col("started_at") >= F.lit(now - RESUME_WITHIN))).orderBy(F.desc("started_at"), F.desc("id")).first()
    return row["id"] if row else None


def start(store: Store, planned: DataFrame, now: datetime, run_id: str | None = None) -> str:
    """M-03: the run and all its tasks in one commit, before anything is fetched.

    ``planned``: task_key, source, url, and maybe params, meta (maps), conditional. No tasks at all is an error.
    """
    if planned.isEmpty():
        raise ValueError("no tasks planned")
    run_id = run_id or uuid.uuid4().hex
    extra = {"params": "map<string,string>", "meta": "map<string,string>", "conditional": "boolean"}
    for name, kind in extra.items():
        if name not in planned.columns:
            planned = planned.withColumn(name, F.lit(None).cast(kind))
    numbered = planned.dropDuplicates(["task_key"]).withColumn("task_seq", F.row_number().over(Window.orderBy("task_key")).cast("bigint"))
    filled = {"run_id": F.lit(run_id), "event": F.lit("planned"), "at": F.lit(now)}
    events = numbered.select(*((filled[f.name] if f.name in filled else F.col(f.name) if f.name in numbered.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.LEDGER.fields))
    store.commit({"ledger": events.unionByName(_events(store, [{"run_id": run_id, "event": "started", "at": now}]))})
    return run_id


def open_tasks(store: Store, run_id: str) -> DataFrame:
    """J-08: what is left to do; tasks claimed by a dead run count."""
    return tasks(store).filter((F.col("run_id") == run_id) & (F.col("state") == "pending")).orderBy("task_seq")


def claim(store: Store, run_id: str, keys: list[str], now: datetime) -> None:
    """M-04."""
    store.commit({"ledger": _events(store, [{"run_id": run_id, "task_key": k, "event": "claimed", "at": now} for k in keys])})


def absorb(store: Store, run_id: str, landing: DataFrame, now: datetime, settings: Settings = Settings()) -> int:
    """M-05 to M-07, M-12: what landed for open tasks, in one commit: postings, quarantine, source states, ledger.

    Landing rows of tasks that are done are left out, so absorbing twice changes nothing.
    """
    left = open_tasks(store, run_id).select("task_key", "url", "task_seq", "attempts")
    rows = landing.join(left.select("task_key"), "task_key", "left_semi")
    as_of = F.lit(now).cast("timestamp")
    # Read by four outputs; kept for the length of this commit (a lost part is computed again).
    judged = validate.judged(landed.parse_all(rows), as_of).persist()
    stamp = {"run_id": F.lit(run_id)}
    good = validate.postings(judged).withColumns(stamp | {"seen_at": as_of})
    bad = validate.quarantine(judged).withColumns(stamp | {"created_at": as_of})

    broken = landed.problems(rows).groupBy("task_key").agg(F.min("error").alias("problem"))
    counts = judged.groupBy("task_key").agg(F.count("*").alias("seen"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("bad"))
    ends = rows.join(broken, "task_key", "left").join(counts, "task_key", "left").join(left.select("task_key", "attempts", F.col("url").alias("planned_url")), "task_key").persist()
    # A body that can't be read won't get better; a fetch that failed may, until attempts run out.
    permanent = F.col("error").isNull() | ~F.coalesce(F.col("status").isin(*requests.RETRYABLE), F.col("status").isNull()) | (F.col("attempts") >= settings.max_attempts)
    event = F.when(F.col("problem").isNull(), "done").when(permanent, "failed").otherwise("requeued")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    ledger = ends.select(
        F.lit(run_id).alias("run_id"), F.lit(None).cast("bigint").alias("task_seq"), "task_key", "source", F.col("planned_url").alias("url"), event.alias("event"), as_of.alias("at"),
        F.col("status").alias("http_status"), (F.col("status") == 304).alias("not_modified"), number("seen").alias("items_seen"), number("valid").alias("items_valid"),
        number("bad").alias("items_quarantined"), F.substring("problem", 1, MAX_ERROR).alias("error"), F.lit(None).cast("string").alias("detail"),
        F.lit(None).cast("map<string,string>").alias("params"), F.col("meta"), F.lit(None).cast("boolean").alias("conditional"),
    )
    state = ends.filter("problem IS NULL").select(
        F.col("planned_url").alias("url"), F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("last_modified"), as_of.alias("last_fetched_at"),
        F.col("status").alias("last_status"), F.when(F.col("status") != 304, number("seen")).alias("last_item_count"),
    )
    ok = ends.filter("problem IS NULL").select("task_key")
    try:
        return store.commit({"observations": good.join(ok, "task_key", "left_semi"), "quarantine": bad.join(ok, "task_key", "left_semi"), "source_state": state, "ledger": ledger})
    finally:
        judged.unpersist()
        ends.unpersist()


def outcomes(store: Store, run_id: str) -> DataFrame:
    """A-18, U-04: of all tasks of the run that ended, in this process or in one before it."""
    ended = tasks(store).filter((F.col("run_id") == run_id) & F.col("state").isin("done", "failed"))
    return ended.select("task_key", "source", (F.col("state") == "done").alias("ok"), "not_modified", "items_seen", "items_valid", "items_quarantined", "error")


def finish(store: Store, run_id: str, now: datetime, settings: Settings = Settings()) -> dict:
    """M-10: judge the run against its own history, and commit the verdict; it is returned, too."""
    ended, every = outcomes(store, run_id), tasks(store)
    before = runs(store).filter(F.col("id") != run_id)
    base = verdict.baselines(before, every.filter(F.col("run_id") != run_id))
    planned = every.filter(F.col("run_id") == run_id).select("source")
    found = verdict.checks(ended, base, planned, settings.max_quarantine_rate, settings.parser_health_ratio)
    word = verdict.status(found, ended).first()
    report = {"run_id": run_id, "status": word["status"], "checks": [r.asDict() for r in found.orderBy("name").collect()], "failed_checks": list(word["failed_checks"])}
    error = "; ".join(report["failed_checks"]) or None
    store.commit({"ledger": _events(store, [{"run_id": run_id, "event": "finished", "at": now, "detail": word["status"], "error": error}])})
    return report


def run(store: Store, planned: DataFrame, fetch, now: datetime, holder: str, settings: Settings = Settings()) -> dict:
    """3.1: a whole run, or the rest of one. ``fetch(open tasks) -> landing`` is called until no task is open."""
    with store.lease(holder, settings.lease_seconds):
        run_id = resumable(store, now) or start(store, planned, now)
        for _ in range(settings.max_attempts):
            left = open_tasks(store, run_id)
            keys = [r["task_key"] for r in left.select("task_key").collect()]
            if not keys:
                break
            claim(store, run_id, keys, now)
            store.renew(holder, settings.lease_seconds)
            absorb(store, run_id, fetch(left), now, settings)
        return finish(store, run_id, now, settings)
