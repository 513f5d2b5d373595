"""Sources, validation, and whole runs over landed bodies."""

from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import batches
from tidemark.operators import analytics, fold, validate
from tidemark.plans import export, run
from tidemark.plans.store import LeaseHeld, Store
from tidemark.sources import html_thread, json_feed, landing, rss_feed
from tidemark.streaming import ingest

NOW = datetime(2026, 9, 4, 12, tzinfo=UTC)


def job(i, **more):
    return {"id": str(i), "url": f"https://example.com/{i}", "company": f"Company {i}", "position": f"Engineer {i}", "tags": ["a", "b"], "date": "2026-09-01T00:00:00+00:00", "description": "<p>Hello</p>"} | more


def landed(spark, *rows):
    filled = [{"task_key": r[0], "source": r[1], "url": f"https://{r[0]}", "status": r[3] if len(r) > 3 else 200, "body": r[2], "headers": {"etag": "x"}, "meta": {}, "error": r[4] if len(r) > 4 else None} for r in rows]
    return spark.createDataFrame([tuple(r[f] for f in schema.LANDING.names) for r in filled], schema.LANDING)


def feed(spark, jobs, key="remoteok:t0", **kw):
    return landed(spark, (key, "remoteok", json.dumps([{"legal": "x"}, *jobs]), *kw.values()))


def judged(spark, rows):
    return validate.judged(rows, F.lit(NOW).cast("timestamp"))


# -- sources ----------------------------------------------------------------------


def test_json_feed(spark):
    jobs = [
        job(1, salary_min=120000, salary_max=170000), job(2, salary_min=0), job(3, url=None, slug="abc"), {k: v for k, v in job(4).items() if k != "id"},
        job(5, company=""), job(6, salary_min=200, salary_max=100), job(7, date="2199-01-01"), "text", job(8, company="H&amp;amp;M", date=None, epoch=1788489225),
    ]
    rows = judged(spark, json_feed.parse(feed(spark, jobs)))
    good = {r.external_id: r for r in validate.postings(rows).collect()}
    assert set(good) == {"1", "2", "3", "8"}
    assert (good["1"].salary_min, good["1"].salary_max, good["1"].salary_currency) == (120000, 170000, "USD")
    assert good["2"].salary_min is None and good["2"].salary_currency is None
    assert good["3"].url.endswith("/abc") and good["8"].company == "H&M" and good["8"].posted_at.year == 2026
    bad = validate.quarantine(rows).collect()
    assert sorted(r.reason_code for r in bad) == sorted(["no_stable_identity", "company:string_too_short", "<root>:value_error", "posted_at:value_error", "element_not_an_object"])
    assert all("description" not in json.loads(r.raw) for r in bad if r.reason_code != "element_not_an_object")
    assert rows.count() == len(jobs)


@pytest.mark.parametrize("body", ["{}", "not json", "<html></html>", "3"])
def test_json_shape(spark, body):
    rows = landed(spark, ("t", "remoteok", body))
    assert json_feed.problems(rows).count() == 1 and json_feed.parse(rows).count() == 0


RSS = """<?xml version="1.0"?><rss><channel>
<item><title>Acme: Systems: Staff Platform Engineer</title><region>Europe</region><state></state><country>Germany</country><category>Dev</category><type>Full-Time</type>
<description>&lt;p&gt;Hi&lt;/p&gt;</description><pubDate>Tue, 01 Sep 2026 10:00:00 +0000</pubDate><guid>https://example.com/a</guid><link>https://example.com/a</link></item>
<item><title>H&amp;amp;M: Designer</title><pubDate>Tue, 01 Sep 2026 10:00:00 +0000</pubDate><link>https://example.com/b</link></item>
<item><title>No colon here</title><guid>https://example.com/c</guid></item><item><title>A: B</title></item><item><guid>https://example.com/d</guid></item></channel></rss>"""


def test_rss(spark):
    rows = judged(spark, rss_feed.parse(landed(spark, ("w", "weworkremotely", RSS))))
    good = {r.external_id: r for r in validate.postings(rows).collect()}
    a = good["https://example.com/a"]
    assert (a.company, a.title, a.location, a.tags, a.description_text) == ("Acme", "Systems: Staff Platform Engineer", "Europe, Germany", ["Dev"], "Hi")
    assert a.posted_at.isoformat().startswith("2026-09-01T10:00") and good["https://example.com/b"].company == "H&M"
    assert {r.reason_code for r in validate.quarantine(rows).collect()} == {"title_not_company_colon_role", "no_stable_identity", "missing_title"}


def test_rss_shapes(spark):
    assert rss_feed.problems(landed(spark, ("w", "weworkremotely", "<rss><channel>"))).count() == 1
    empty = landed(spark, ("w", "weworkremotely", "<rss><channel></channel></rss>"))
    assert rss_feed.problems(empty).count() == 0 and rss_feed.parse(empty).count() == 0


def comment(i, body, indent=0):
    inner = "" if body is None else f'<div class="commtext c00">{body}</div>'
    return f'<tr class="athing comtr" id="{i}"><td class="ind" indent="{indent}"></td><td><span class="age" title="2026-09-01T02:33:45.000000Z 1788489225">x</span>{inner}</td></tr>'


THREAD = "<table>" + "".join(
    [
        comment(1, "Acme | Backend Engineer | Berlin, Germany | Full-time<p>Come and work"), comment(2, 'Snout <a href="https://snout.com">https://snout.com</a> | Data Engineer | Remote'),
        comment(3, "QUOBYTE | Berlin, Germany | ONSITE<p>Site Reliability Engineer: https://q.com"), comment(4, "a reply", 1), comment(5, None), comment(6, "We are hiring"), comment(7, "Acme | Berlin, Germany | Full-time"),
    ]
) + "</table>"


def test_thread(spark):
    rows = judged(spark, html_thread.parse(landed(spark, ("h", "hackernews", THREAD))))
    good = {r.external_id: r for r in validate.postings(rows).collect()}
    assert set(good) == {"1", "2", "3"}
    assert good["2"].company == "Snout" and good["2"].title == "Data Engineer"
    assert good["3"].title == "Site Reliability Engineer" and "title-from-body" in good["3"].tags
    assert {r.external_id: r.reason_code for r in validate.quarantine(rows).collect()} == {"6": "header_not_pipe_delimited", "7": "no_role_identified"}
    assert html_thread.problems(landed(spark, ("h", "hackernews", "<p>changed</p>"))).count() == 1


def test_threads(spark):
    body = json.dumps({"hits": [{"title": "Ask: Who is hiring? (Sept)", "objectID": "9"}, {"title": "Who wants to be hired", "objectID": "8"}, {"title": "WHO IS HIRING", "objectID": "7"}]})
    assert [r.thread_id for r in html_thread.threads(spark.createDataFrame([(body,)], "body string"), 1).collect()] == ["9"]


# -- validation -------------------------------------------------------------------

CASES = [
    ({}, None), ({"source": "monster"}, "source:literal_error"), ({"external_id": ""}, "external_id:string_too_short"), ({"external_id": "x" * 201}, "external_id:string_too_long"),
    ({"url": "ftp://example.com"}, "url:value_error"), ({"url": "http:/"}, "url:string_too_short"), ({"company": " "}, "company:string_too_short"), ({"company": None}, "company:string_type"),
    ({"company": "N/A"}, "company:value_error"), ({"title": "x"}, "title:string_too_short"), ({"title": "a\nb"}, "title:value_error"), ({"title": "TBD"}, "title:value_error"),
    ({"location": "x" * 301}, "location:string_too_long"), ({"salary_min": "-5"}, "salary_min:value_error"), ({"salary_min": "abc"}, "salary_min:value_error"), ({"salary_min": "NaN"}, "salary_min:value_error"),
    ({"salary_max": "20000000"}, "salary_max:value_error"), ({"salary_min": "12.7"}, None), ({"salary_min": "5", "salary_max": "4"}, "<root>:value_error"), ({"posted_at": "yesterday"}, "posted_at:value_error"),
    ({"posted_at": "2026-09-05"}, None), ({"posted_at": "2026-09-08T00:00:00Z"}, "posted_at:value_error"), ({"posted_at": "1999-01-01"}, "posted_at:value_error"), ({"posted_at": "2026"}, "posted_at:value_error"),
    ({"posted_at": "Tue, 01 Sep 2026 10:00:00 GMT"}, None), ({"posted_at": "20260901"}, None), ({"extra_keys": ["salary"]}, "salary:extra_forbidden"), ({"missing_keys": ["title"], "title": None}, "title:missing"),
]


def posting(**more):
    base = dict.fromkeys(schema.ALLOWED) | {"source": "remoteok", "external_id": "1", "url": "https://example.com", "company": "Acme", "title": "Engineer", "tags": [" a ", "", "b"]}
    extra, missing = more.pop("extra_keys", []), more.pop("missing_keys", [])
    values = base | more
    return ("t", "remoteok", 0, values["external_id"], tuple(values[k] for k in schema.ALLOWED), extra, missing, None, None, "{}")


def test_validation(spark):
    rows = spark.createDataFrame([posting(**c) for c, _ in CASES], schema.RECORD).withColumn("n", F.monotonically_increasing_id())
    out = judged(spark, rows).select("n", F.when(F.size("errors") > 0, validate.reason_code(F.lit(None), F.col("errors"), F.lit(None))).alias("code")).orderBy("n").collect()
    assert [r.code for r in out] == [code for _, code in CASES]


def test_all_errors_are_reported(spark):
    rows = judged(spark, spark.createDataFrame([posting(company="", title="x", url="ftp://example.com")], schema.RECORD))
    bad = validate.quarantine(rows).first()
    assert bad.error_count == 3 and "company: String should have at least 1 character (got '')" in bad.reason and "title" in bad.reason
    long = validate.quarantine(judged(spark, spark.createDataFrame([posting(**{f: "x" * 3000 for f in ("external_id", "url", "company", "title", "location", "employment_type", "salary_currency", "salary_min", "salary_max", "posted_at")})], schema.RECORD))).first()
    assert len(long.reason) == 1000 and long.reason.endswith("...")


# -- runs -------------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def one_run(store, landing_rows, now=NOW, **kw):
    return run.run(store, landing_rows.select("task_key", "source", "url"), lambda _: landing_rows, now, "me", **kw)


def test_runs_are_idempotent(spark, store):
    first = one_run(store, feed(spark, [job(i) for i in range(5)]))
    assert first["status"] == "succeeded" and run.jobs(store).count() == 5
    one_run(store, feed(spark, [job(i, position="Changed") if i == 0 else job(i) for i in range(5)]), NOW + timedelta(days=1))
    rows = {r.external_id: r for r in run.jobs(store).collect()}
    assert len(rows) == 5 and rows["0"].revision == 2 and rows["1"].revision == 1 and rows["0"].title == "Changed"
    assert rows["0"].first_seen_at < rows["0"].last_seen_at and rows["0"].first_seen_run_id == first["run_id"] != rows["0"].last_changed_run_id
    counts = analytics.recount(run.jobs(store), rows["0"].last_seen_run_id).first()
    assert (counts.touched, counts.inserted, counts.updated, counts.unchanged) == (5, 0, 1, 4)


def test_last_wins_in_a_batch(spark, store):
    one_run(store, feed(spark, [job(1), job(1, position="Later")]))
    assert [r.title for r in run.jobs(store).collect()] == ["Later"]


def test_resume(spark, store):
    rows = landed(spark, ("remoteok:t0", "remoteok", json.dumps([job(1)])), ("remoteok:t1", "remoteok", json.dumps([job(2)])))
    run_id = run.start(store, rows.select("task_key", "source", "url"), NOW)
    run.claim(store, run_id, ["remoteok:t0", "remoteok:t1"], NOW)
    run.absorb(store, run_id, rows.filter("task_key = 'remoteok:t0'"), NOW)
    assert {r.task_key: r.state for r in run.tasks(store).collect()} == {"remoteok:t0": "done", "remoteok:t1": "pending"}
    assert run.resumable(store, NOW + timedelta(hours=1)) == run_id and run.resumable(store, NOW + timedelta(hours=13)) is None
    run.absorb(store, run_id, rows, NOW)  # t0 again: nothing of it is taken
    assert run.jobs(store).agg(F.sum("revision")).first()[0] == 2 and run.finish(store, run_id, NOW)["status"] == "succeeded"
    assert store.read("observations").count() == 2


def test_nothing_shows_of_a_commit_that_fails(spark, store):
    before = store.commits()
    broken = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(Exception):
        store.commit({"ledger": run._events(store, [{"run_id": "x", "event": "started", "at": NOW}]), "quarantine": broken})
    assert store.commits() == before and store.read("ledger").count() == 0


def test_lease(store):
    store.acquire("a", 60)
    with pytest.raises(LeaseHeld, match="a"):
        store.acquire("b", 60)
    store.renew("a", -1)
    store.acquire("b", 60)
    with pytest.raises(LeaseHeld):
        store.renew("a")
    store.release("a")
    with pytest.raises(LeaseHeld):
        store.acquire("c")
    store.release("b")


def test_failures(spark, store):
    bad = landed(spark, ("t0", "remoteok", None, 503, "HTTP 503"), ("t1", "remoteok", json.dumps([job(1)])), ("t2", "weworkremotely", "<rss>"))
    report = one_run(store, bad)
    states = {r.task_key: (r.state, r.attempts) for r in run.tasks(store).collect()}
    assert states == {"t0": ("failed", 3), "t1": ("done", 1), "t2": ("failed", 1)}
    assert report["status"] == "failed" and report["failed_checks"] == ["source_reachable:weworkremotely"]


def test_verdicts(spark, store):
    assert one_run(store, feed(spark, [job(i) for i in range(20)]))["status"] == "succeeded"
    quiet = one_run(store, feed(spark, [job(1)]), NOW + timedelta(hours=20))
    assert quiet["failed_checks"] == ["parser_health:remoteok"]
    unchanged = one_run(store, landed(spark, ("remoteok:t0", "remoteok", None, 304)), NOW + timedelta(hours=40))
    assert unchanged["status"] == "succeeded"
    mostly_bad = one_run(store, feed(spark, [job(i, company="") for i in range(9)] + [job(9)]), NOW + timedelta(hours=60))
    assert "quarantine_rate" in mostly_bad["failed_checks"]
    state = {r.url: r for r in run.source_state(store).collect()}["https://remoteok:t0"]
    assert state.last_item_count == 10 and state.etag == "x"


def test_snapshot_and_export(spark, store, tmp_path):
    one_run(store, feed(spark, [job(1), job(2, company="")]))
    upto = store.commits()[-1]
    whole = run.jobs(store)
    store.write_snapshot(whole, upto)
    one_run(store, feed(spark, [job(1, position="New"), job(3)]), NOW + timedelta(hours=20))
    rows = {r.external_id: r for r in run.jobs(store).collect()}
    assert set(rows) == {"1", "3"} and rows["1"].revision == 2 and rows["1"].title == "New"
    written = export.export(store, str(tmp_path / "site"), NOW + timedelta(hours=21))
    assert set(written) >= {"index.html", "api/jobs.json", "api/health.json", "api/stats.json"}
    assert json.loads((tmp_path / "site/api/jobs.json").read_text())["count"] == 2
    assert 'data-state="good"' in (tmp_path / "site/index.html").read_text() or 'data-state="warning"' in (tmp_path / "site/index.html").read_text()
    status, stats = export.api_stats(store, NOW + timedelta(hours=21))
    assert status == 200 and stats["totals"]["jobs"] == 2 and json.dumps(stats) and export.index(store, NOW + timedelta(hours=21))[1].count("<svg") == 2
    assert export.main(["--store", store.root, "compact"], spark) == 0 and store.last_snapshot()[0] == store.commits()[-1] and {r.revision for r in run.jobs(store).collect()} == {1, 2}
    assert export.api_jobs(store, 0)[0] == 422 and export.api_jobs(store, 5, "remoteok", "new")[1]["count"] == 1
    assert export.api_health(store, NOW + timedelta(days=9))[0] == 503 and "Run" in export.summary({"run_id": "r", "status": "partial", "checks": []}) and export.exit_code("partial") == 0


def test_a_delta_that_begins_with_the_snapshots_content_adds_only_its_changes(spark, store):
    one_run(store, feed(spark, [job(1)]))
    store.write_snapshot(run.jobs(store), store.commits()[-1])
    one_run(store, feed(spark, [job(1)]), NOW + timedelta(hours=20))
    last = one_run(store, feed(spark, [job(1, position="New")]), NOW + timedelta(hours=40))
    row = run.jobs(store).first()
    assert (row.revision, row.last_changed_run_id) == (2, last["run_id"])


def test_a_commit_never_lands_inside_another(spark, store, monkeypatch):
    events = spark.createDataFrame([], schema.LEDGER)
    store.commit({"ledger": events})
    monkeypatch.setattr(store, "commits", lambda: [])  # as a second writer that listed before the first was done
    with pytest.raises(Exception, match="[Ee]xist"):
        store.commit({"ledger": events})
    monkeypatch.undo()
    assert store.commits() == [1]


def test_the_stream_keeps_other_writers_out(spark, store, tmp_path):
    folder, mark = str(tmp_path / "landing"), str(tmp_path / "mark")
    feed(spark, [job(1)]).write.mode("append").parquet(folder)
    store.acquire("another")
    with pytest.raises(LeaseHeld):
        ingest.drain(store, folder, mark, NOW)
    assert store.commits() == []
    store.release("another")
    ingest.drain(store, folder, mark, NOW)
    store.acquire("another")


def test_tags_in_one_string_and_times_as_numbers(spark):
    jobs = [job(1, tags="a, ,b", date=None, epoch=86400 * 13000), job(2, date="1700000000"), job(3, date=12345), job(4, tags=7)]
    rows = judged(spark, json_feed.parse(feed(spark, jobs)))
    good = {r.external_id: r for r in validate.postings(rows).collect()}
    assert good["1"].tags == ["a", "b"] and good["1"].posted_at.year == 2005 and good["4"].tags == []
    assert {r.external_id: r.reason_code for r in validate.quarantine(rows).collect()} == {"2": "posted_at:value_error", "3": "posted_at:value_error"}


def test_stream(spark, store, tmp_path):
    folder, mark = str(tmp_path / "landing"), str(tmp_path / "mark")
    feed(spark, [job(1), job(2)]).write.mode("append").parquet(folder)
    ingest.drain(store, folder, mark, NOW)
    n = len(store.commits())
    ingest.drain(store, folder, mark, NOW)
    assert len(store.commits()) == n and run.jobs(store).count() == 2
    feed(spark, [job(3)], "remoteok:t1").write.mode("append").parquet(folder)
    ingest.drain(store, folder, mark, NOW + timedelta(hours=1))
    assert run.jobs(store).count() == 3


def test_unchanged_bodies_are_not_parsed(spark):
    rows = landed(spark, ("a", "remoteok", None, 304), ("b", "remoteok", json.dumps([job(1)])))
    assert landing.parse_all(rows).count() == 1 and landing.unchanged(rows).count() == 1


def test_fold_is_idempotent(spark):
    rows = [("k1", 1, 0, "r1", 1, "h1"), ("k1", 2, 0, "r2", 2, "h1"), ("k1", 3, 0, "r3", 3, "h2"), ("k2", 2, 0, "r2", 2, "h"), ("k2", 2, 1, "r2", 2, "g")]
    df = spark.createDataFrame(rows, "dedup_key string, seq int, pos int, run_id string, seen_at int, content_hash string")
    once = {r.dedup_key: r for r in fold.fold(df, fixed=()).collect()}
    assert (once["k1"].revision, once["k1"].last_changed_run_id, once["k1"].first_seen_at) == (2, "r3", 1) and once["k2"].content_hash == "g"
    again = spark.createDataFrame([("k1", 4, 0, "r4", 4, "h2")], df.schema).unionAll(df)
    assert {r.dedup_key: r.revision for r in fold.fold(again, fixed=()).collect()} == {"k1": 2, "k2": 1}


def test_charts():
    svg = export.stacked_days([{"label": "a", "series": [1, 0, 3]}, {"label": "b<", "series": [2, 0, 5]}])
    assert svg.count("<rect") == 4 and 'data-ceiling="10"' in svg and "b&lt;" in svg and export.stacked_days([]).count("<rect") == 0
    assert export.bars([("x", 3), ("y", 1)]).count("<rect") == 2 and export.bars([]).count("<rect") == 0


# -- what Python gets at once -------------------------------------------------------


def test_pages_of_a_thread_reach_python_in_bounded_batches(spark, monkeypatch):
    """The id of each comment is the number of characters that came with its page."""

    @F.pandas_udf(html_thread.comments.returnType)
    def sizes(pages):
        return pages.map(lambda _: [{"id": str(int(pages.str.len().sum())), "indent": "0", "posted_at": None, "lines": ["Acme | Engineer"], "plain": "x"}])

    spark.conf.unset(batches.BATCH_KEY)
    monkeypatch.setattr(html_thread, "comments", sizes)
    pages = landed(spark, *((f"hackernews:{i}", "hackernews", "x" * 300_000) for i in range(30)))
    found = [int(r.external_id) for r in html_thread.parse(pages.coalesce(1)).collect()]
    assert len(found) == 30 and max(found) < batches.BATCH_BYTES + 300_000
