"""The edge: JSON files, a page, an API by functions, status text and a command line (K-02 to K-10, H-07)."""

from __future__ import annotations

import argparse
import html
import json
import os
import pathlib
from datetime import UTC, date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import analytics
from tidemark.plans import run
from tidemark.plans.store import LeaseHeld, Store

PAGE_JOBS, API_JOBS, EXCERPT = 30, 500, 280
MAX_API = 500
STEPS = (1, 2, 2.5, 5, 10)


def plain(value):
    """K-10: rows to dicts, times to ISO text, all the way down."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return float(value) if isinstance(value, Decimal) else value


def rows(df: DataFrame) -> list[dict]:
    return [plain(r) for r in df.collect()]


def nice_ceiling(n: float) -> int:
    """K-09: the top of an axis: the least round number that isn't below ``n``."""
    if n <= 1:
        return 1
    power = 10 ** (len(str(int(n))) - 1)
    return next(int(s * power) for s in STEPS if s * power >= n and s * power == int(s * power))


def stacked_days(series: list[dict], width: int = 600, height: int = 120) -> str:
    """K-09: an SVG of one stacked bar for each day, scaled to the axis' ceiling."""
    days = list(zip(*(s["series"] for s in series), strict=True))
    top = nice_ceiling(max(map(sum, days), default=1))
    step, out = width / max(len(days), 1), []
    for x, day in enumerate(days):
        floor = float(height)
        for layer, n in enumerate(day):
            tall = height * n / top
            floor -= tall
            if n:
                out.append(f'<rect class="s{layer}" x="{x * step:.1f}" y="{floor:.1f}" width="{step * 0.8:.1f}" height="{tall:.1f}"><title>{html.escape(str(series[layer]["label"]))}: {n}</title></rect>')
    return f'<svg viewBox="0 0 {width} {height}" data-ceiling="{top}" role="img">{"".join(out)}</svg>'


def bars(items: list[tuple[str, float]], width: int = 600, row: int = 18) -> str:
    """K-09: an SVG of horizontal bars, the longest as wide as the axis' ceiling allows."""
    top = nice_ceiling(max((n for _, n in items), default=1))
    out = [f'<rect x="0" y="{i * row}" width="{width * n / top:.1f}" height="{row - 4}"></rect><text x="4" y="{i * row + row - 7}">{html.escape(str(name))}: {n:g}</text>' for i, (name, n) in enumerate(items)]
    return f'<svg viewBox="0 0 {width} {max(len(items), 1) * row}" data-ceiling="{top}" role="img">{"".join(out)}</svg>'


def snapshot(store: Store, now: datetime, settings: run.Settings = run.Settings()) -> dict:
    """All that the page shows; every query is one plan over the log, and only its result is collected."""
    as_of = F.lit(now).cast("timestamp")
    jobs, runs, bad = run.jobs(store), run.runs(store), run.quarantine(store)
    return {
        "generated_at": now.isoformat(),
        "health": rows(analytics.health(runs, as_of, settings.stale_after_hours))[0],
        "totals": rows(analytics.totals(jobs, bad, runs, as_of))[0],
        "by_source": rows(analytics.by_source(jobs)),
        "daily": rows(analytics.daily_series(jobs, as_of)),
        "runs": rows(analytics.run_history(runs)),
        "top_companies": rows(analytics.top_companies(jobs)),
        "quarantine_breakdown": rows(analytics.quarantine_breakdown(bad)),
        "recent_quarantine": rows(analytics.recent_quarantine(bad)),
        "duplicates": rows(analytics.duplicate_groups(jobs)),
    }


def slim(jobs: DataFrame) -> DataFrame:
    """K-04: an excerpt in place of the description."""
    return jobs.withColumn("description_excerpt", text.excerpt(F.col("description_text"), EXCERPT)).drop("description_text")


def api_health(store: Store, now: datetime, settings: run.Settings = run.Settings()) -> tuple[int, dict]:
    """K-08: 503 when critical."""
    found = rows(analytics.health(run.runs(store), F.lit(now).cast("timestamp"), settings.stale_after_hours))[0]
    age = found["last_success_age_hours"]
    body = found | {"last_success_age_hours": None if age is None else round(age, 2), "generated_at": now.isoformat()}
    return 503 if found["state"] == "critical" else 200, body


def api_jobs(store: Store, limit: int = 40, source: str | None = None, q: str | None = None) -> tuple[int, dict]:
    if not 1 <= limit <= MAX_API:
        return 422, {"error": f"limit must be between 1 and {MAX_API}"}
    found = rows(slim(analytics.recent_jobs(run.jobs(store), limit, source, q)))
    return 200, {"count": len(found), "jobs": found}


def api_stats(store: Store, now: datetime, settings: run.Settings = run.Settings()) -> tuple[int, dict]:
    """K-08: all that the page shows, as JSON."""
    return 200, snapshot(store, now, settings)


def index(store: Store, now: datetime, settings: run.Settings = run.Settings(), jobs: int = 25) -> tuple[int, str]:
    """K-08: the page itself, over the state of the store."""
    newest = analytics.recent_jobs(run.jobs(store), jobs)
    return 200, page(snapshot(store, now, settings), rows(slim(newest).withColumn("salary", text.salary_label(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")))))


def page(snap: dict, jobs: list[dict]) -> str:
    """K-05: one self-contained page."""
    e = lambda v: html.escape(str(v if v is not None else "—"))
    tiles = "".join(f"<li><b>{e(v)}</b> {e(k.replace('_', ' '))}</li>" for k, v in snap["totals"].items())
    table = lambda head, body: f"<table><tr>{''.join(f'<th>{e(h)}</th>' for h in head)}</tr>{''.join('<tr>' + ''.join(f'<td>{e(c)}</td>' for c in r) + '</tr>' for r in body)}</table>"
    link = lambda u: e(u) if str(u).lower().startswith(("http://", "https://")) else "#"
    listed = "".join(f'<li><a href="{link(j["url"])}">{e(j["title"])}</a> — {e(j["company"])}, {e(j["location"])}, {e(j["salary"])}</li>' for j in jobs)
    legend = "".join(f"<li>{e(s['label'])}: {e(sum(s['series']))}</li>" for s in snap["daily"])
    health = snap["health"]
    return (
        f'<!doctype html><html lang="en"><head><meta charset="utf-8"><title>Postings</title></head><body data-state="{e(health["state"])}">'
        f"<h1>{e(health['label'])}</h1><p>{e(health['consecutive_days'])} days in a row; generated {e(snap['generated_at'])}</p><ul id=\"totals\">{tiles}</ul>"
        f'<h2>Daily</h2>{stacked_days(snap["daily"])}<ul id="daily">{legend}</ul>'
        f"<h2>Sources</h2>{bars([(s['label'], s['count']) for s in snap['by_source']])}"
        f"<h2>Companies</h2>{table(('company', 'postings', 'sources'), [(c['company'], c['count'], c['sources']) for c in snap['top_companies']])}"
        f"<h2>Quarantine</h2>{table(('code', 'source', 'n', 'example'), [(c['code'], c['label'], c['count'], c['example']) for c in snap['quarantine_breakdown']])}"
        f"<h2>Found twice</h2>{table(('company', 'title', 'kind', 'n'), [(g['company'], g['title'], g['kind'], g['n']) for g in snap['duplicates']])}"
        f"<h2>Runs</h2>{table(('run', 'status', 'started'), [(r['id'], r['status'], r['started_at']) for r in snap['runs']])}"
        f'<h2>Newest</h2><ul id="jobs">{listed}</ul></body></html>'
    )


def export(store: Store, out: str, now: datetime, settings: run.Settings = run.Settings()) -> dict[str, int]:
    """Write the site; returns bytes by file."""
    snap = snapshot(store, now, settings)
    newest = analytics.recent_jobs(run.jobs(store), API_JOBS)
    shown = rows(slim(newest).withColumn("salary", text.salary_label(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"))))
    files = {
        "index.html": page(snap, shown[:PAGE_JOBS]),
        "api/health.json": json.dumps(api_health(store, now, settings)[1], indent=2),
        "api/stats.json": json.dumps(snap, indent=2),
        "api/jobs.json": json.dumps({"count": len(shown), "note": "Descriptions are excerpts; follow a posting's url for all of it.", "jobs": shown}, indent=2),
        "_redirects": "".join(f"/api/{n} /api/{n}.json 200\n" for n in ("health", "stats", "jobs")),
        "_headers": "/api/*\n  Access-Control-Allow-Origin: *\n  Cache-Control: public, max-age=300\n",
    }
    written = {}
    for name, body in files.items():
        path = pathlib.Path(out, name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body, encoding="utf-8")
        written[name] = len(body.encode())
    return written


def summary(report: dict) -> str:
    """K-07: a run in Markdown."""
    lines = [f"## Run {report['run_id']}: {report['status']}", "", "| check | ok | value | detail |", "|---|---|---|---|"]
    lines += [f"| {c['name']} | {'yes' if c['ok'] else 'no'} | {c['value']:g} | {c['detail']} |" for c in report["checks"]]
    return "\n".join(lines) + "\n"


def exit_code(status: str) -> int:
    """H-07: a failed run is an error; a partial one isn't."""
    return int(status == "failed")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--store", default=os.environ.get("TIDEMARK_STORE", "warehouse"))
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("init")
    sub.add_parser("status").add_argument("--json", action="store_true")
    r = sub.add_parser("run")
    r.add_argument("landing", help="Parquet folder of landed bodies")
    sub.add_parser("compact")
    x = sub.add_parser("export")
    x.add_argument("out")
    x.add_argument("--allow-empty", action="store_true")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store, now, settings = Store(spark, args.store), datetime.now(UTC), run.Settings.from_env(dict(os.environ))
    if args.command == "run":
        from tidemark import schema

        landing = spark.read.schema(schema.LANDING).parquet(args.landing)
        try:
            report = run.run(store, landing.select("task_key", "source", "url").distinct(), lambda _: landing, now, f"cli/{os.getpid()}", settings)
        except LeaseHeld as held:
            print(held)
            return 0
        print(summary(report))
        return exit_code(report["status"])
    if args.command == "compact":  # later folds start from here; nobody may commit meanwhile
        with store.lease(f"cli/{os.getpid()}", settings.lease_seconds):
            if done := store.commits():
                store.write_snapshot(run.jobs(store), done[-1])
                print(f"snapshot up to commit {done[-1]}")
    if args.command == "status":
        snap = {"jobs": run.jobs(store).count(), "quarantined": run.quarantine(store).count(), "tasks": rows(analytics.task_histogram(run.tasks(store))), "health": api_health(store, now, settings)[1]}
        print(json.dumps(snap, indent=2) if args.json else f"{snap['jobs']} postings, {snap['quarantined']} quarantined; {snap['health']['label']}")
    if args.command == "export":
        if not args.allow_empty and run.jobs(store).isEmpty():
            print("nothing to export")
            return 1
        print("\n".join(f"{n}: {size} bytes" for n, size in export(store, args.out, now, settings).items()))
    return 0
