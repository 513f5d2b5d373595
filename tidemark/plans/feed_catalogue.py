"""Queries that run the feed engine itself: bodies written from the driver's tables, parsed, judged and hashed.

Each has a DuckDB twin that says what the records must be from the rows that the bodies were written from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import headers, text
from tidemark.operators import fold, validate, verdict
from tidemark.plans import run
from tidemark.plans.catalogue import AS_OF, outcomes, query, runs, table, tasks
from tidemark.sources import html_thread, json_feed, landing, rss_feed

#: Records of one body; a body is what one fetch of a feed gives.
BODY = 500


def _bodies(rows: DataFrame, source: str, item: Column, key: Column, around: tuple[str, str], between: str) -> DataFrame:
    """Landing rows: ``item`` of each row, in the order of ``key``, BODY to a body."""
    cut = rows.select(F.expr(f"{key._jc.toString()} div {BODY}").alias("part"), key.alias("k"), item.alias("item"))
    whole = cut.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("items"))
    body = F.concat(F.lit(around[0]), F.array_join(F.transform("items", lambda x: x["item"]), between), F.lit(around[1]))
    none = F.create_map().cast("map<string,string>")
    return whole.select(F.concat(F.lit(source + ":"), F.col("part").cast("string")).alias("task_key"), F.lit(source).alias("source"), F.lit("https://example.com/feed").alias("url"), F.lit(200).alias("status"), body.alias("body"), none.alias("headers"), F.create_map(F.lit("thread_id"), F.lit("1")).alias("meta"), F.lit(None).cast("string").alias("error"))


def _when(k: int, rest: int = 0) -> Column:
    return F.col("k") % k == rest


def json_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey"))
    fields = {
        "id": F.when(~_when(10), F.col("k")), "url": F.when(~_when(3), F.concat(F.lit("https://example.com/"), F.col("k").cast("string"))), "slug": F.concat(F.lit("job-"), F.col("k").cast("string")),
        "company": F.when(_when(7), " TBD ").otherwise(F.concat(F.lit("H&amp;amp;M "), "p_brand")), "position": F.when(_when(11), "x").otherwise(F.col("p_name")),
        "salary_min": F.when(_when(4), 0).otherwise(F.col("p_size") * 1000), "salary_max": F.when(_when(13), 1).otherwise(F.col("p_size") * 2000),
        "date": F.when(_when(5, 1), "2199-01-01").when(~_when(5), "2024-05-06T07:08:09Z"), "epoch": F.when(_when(5), 1_700_000_000 + F.col("k")),
        "description": F.concat(F.lit("<p>Use <b>"), "p_name", F.lit("</b> &amp; more</p>")),
    }
    plain = F.regexp_replace(F.to_json(F.struct(*(c.alias(n) for n, c in fields.items()))), r"\}$", "")
    tags = F.when(_when(2), F.concat(F.lit(',"tags":["a"," ","'), "p_type", F.lit('"]}'))).otherwise(F.concat(F.lit(',"tags":"a, ,'), "p_type", F.lit('"}')))
    return _bodies(rows, "remoteok", F.concat(plain, tags), F.col("k"), ("[", "]"), ",")


_JSON_SQL = """part_ AS (SELECT *, p_partkey AS k FROM part), feed AS (SELECT k, CASE WHEN k % 3 = 0 THEN 'https://remoteok.com/remote-jobs/job-' || k ELSE 'https://example.com/' || k END AS url,
    CASE WHEN k % 7 = 0 THEN 'TBD' ELSE 'H&M ' || p_brand END AS company, CASE WHEN k % 11 = 0 THEN 'x' ELSE p_name END AS title, CASE WHEN k % 4 <> 0 THEN p_size * 1000 END AS low, CASE WHEN k % 13 = 0 THEN 1 ELSE p_size * 2000 END AS high,
    p_type AS kind, CASE WHEN k % 5 = 0 THEN make_timestamp((1700000000 + k) * 1000000) WHEN k % 5 > 1 THEN TIMESTAMP '2024-05-06 07:08:09' END AS posted, 'Use ' || p_name || ' & more' AS description FROM part_)"""


@query(f"""WITH {_JSON_SQL} SELECT 'remoteok:' || (k // {BODY}) AS task_key, k % {BODY} AS pos, CASE WHEN k % 10 = 0 THEN 'no_stable_identity' END AS error_code,
    CASE WHEN k % 10 > 0 THEN CAST(k AS VARCHAR) END AS external_id, CASE WHEN k % 10 > 0 THEN url END AS url, CASE WHEN k % 10 > 0 THEN company END AS company, CASE WHEN k % 10 > 0 THEN title END AS title,
    CASE WHEN k % 10 > 0 THEN 'USD' END AS currency, CASE WHEN k % 10 > 0 THEN description END AS description FROM feed""")
def json_feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-01, S-05, P-01, P-21, P-22, P-23: every record of the bodies, or why it has none."""
    p = lambda f: F.col(f"payload.{f}")
    rows = json_feed.parse(json_bodies(spark, sf_dir))
    return rows.select("task_key", "pos", "error_code", p("external_id").alias("external_id"), p("url").alias("url"), text.strip(p("company")).alias("company"), p("title").alias("title"), p("salary_currency").alias("currency"), p("description_text").alias("description"))


_CODE_SQL = """CASE WHEN k % 10 = 0 THEN 'no_stable_identity' WHEN k % 7 = 0 THEN 'company:value_error' WHEN k % 11 = 0 THEN 'title:string_too_short' WHEN k % 5 = 1 THEN 'posted_at:value_error'
    WHEN low > high THEN '<root>:value_error' ELSE 'valid' END"""


@query(f"""WITH {_JSON_SQL}, c AS (SELECT *, {_CODE_SQL} AS code FROM feed) SELECT k % {BODY} AS pos, 'remoteok:' || (k // {BODY}) AS task_key, code,
    CASE WHEN code IN ('valid', 'no_stable_identity', '<root>:value_error') THEN 1 ELSE (k % 7 = 0)::INT + (k % 11 = 0)::INT + (k % 5 = 1)::INT END AS n FROM c""")
def valid_and_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-02, P-06 to P-21 over the bodies: each record is a posting or a row of the quarantine, with its code."""
    rows = validate.judged(json_feed.parse(json_bodies(spark, sf_dir)), F.lit("2026-02-14 12:00:00").cast("timestamp"))
    good = validate.postings(rows).select("task_key", "pos", F.lit("valid").alias("code"), F.lit(1).alias("n"))
    return good.unionByName(validate.quarantine(rows).select("task_key", "pos", F.col("reason_code").alias("code"), F.col("error_count").alias("n")))


_MARK = "' || chr(31) || '"


@query(rf"""WITH {_JSON_SQL}, c AS (SELECT *, {_CODE_SQL} AS code FROM feed) SELECT CAST(k AS VARCHAR) AS external_id, sha256('v1{_MARK}remoteok{_MARK}' || k) AS dedup_key,
    sha256('v1{_MARK}' || trim(regexp_replace(lower(company), '[^a-z0-9]+', ' ', 'g')) || '{_MARK}' || trim(regexp_replace(lower(regexp_replace(title, '(?i)\b({text.TITLE_NOISE})\b', ' ', 'g')), '[^a-z0-9]+', ' ', 'g')) || '{_MARK}') AS fingerprint,
    sha256('v1{_MARK}company=' || company || '{_MARK}description_text=' || description || '{_MARK}employment_type={_MARK}location={_MARK}posted_at=' || strftime(posted, '%Y-%m-%dT%H:%M:%S.%f') || '{_MARK}salary_currency=USD{_MARK}salary_max=' || high
        || '{_MARK}salary_min=' || coalesce(CAST(low AS VARCHAR), '') || '{_MARK}tags=' || CASE WHEN kind < 'a' THEN kind || ',a' ELSE 'a,' || kind END || '{_MARK}title=' || title || '{_MARK}url=' || url) AS content_hash
FROM c WHERE code = 'valid'""")
def posting_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-07 to F-10, P-12 to P-14: the hashes of every posting of the bodies, by way of its values."""
    rows = validate.judged(json_feed.parse(json_bodies(spark, sf_dir)), F.lit("2026-02-14 12:00:00").cast("timestamp"))
    return validate.postings(rows).select("external_id", "dedup_key", F.col("content_fingerprint").alias("fingerprint"), "content_hash")


@query(f"""WITH {_JSON_SQL}, c AS (SELECT *, {_CODE_SQL} AS code FROM feed) SELECT code, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM c) AS share FROM c WHERE code <> 'valid' GROUP BY 1""")
def quarantine_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-13, A-21, P-20: what the quarantine of the bodies holds, and its share of all records."""
    rows = validate.judged(json_feed.parse(json_bodies(spark, sf_dir)), F.lit("2026-02-14 12:00:00").cast("timestamp"))
    every = rows.agg(F.count("*").alias("every"))
    found = validate.quarantine(rows).groupBy(F.col("reason_code").alias("code")).agg(F.count("*").alias("n"))
    return found.join(F.broadcast(every), F.lit(True)).select("code", "n", (F.col("n") / F.col("every")).alias("share"))


def rss_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").withColumn("k", F.col("s_suppkey"))
    number, nation = F.col("k").cast("string"), F.concat(F.lit("Land "), F.col("s_nationkey").cast("string"))
    tag = lambda name, value: F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")))
    link = F.concat(F.lit("https://example.com/"), number)
    item = F.concat(
        F.lit("<item>"), tag("title", F.when(_when(6), "No role here").when(_when(7), "  ").otherwise(F.concat(F.lit("R&amp;amp;D "), "s_name", F.lit(": Lead: Team "), number))),
        tag("region", nation), tag("country", F.when(_when(2), "Earth")), tag("state", F.when(_when(4, 1), nation)), tag("skills", F.when(_when(3), "Go")), tag("category", F.lit("Work")), tag("type", F.lit("Full-Time")),
        tag("description", F.lit("&lt;p&gt;Do &lt;i&gt;it&lt;/i&gt;&lt;/p&gt;")), tag("pubDate", F.lit("Mon, 06 May 2024 07:08:09 +0000")), tag("guid", F.when(~_when(5), F.concat(F.lit("g"), number))), tag("link", F.when(~_when(9), link)), F.lit("</item>"),
    )
    return _bodies(rows, "weworkremotely", item, F.col("k"), ("<rss><channel>", "</channel></rss>"), "")


@query(f"""WITH s AS (SELECT *, s_suppkey AS k, 'Land ' || s_nationkey AS land, CASE WHEN s_suppkey % 5 > 0 THEN 'g' || s_suppkey WHEN s_suppkey % 9 > 0 THEN 'https://example.com/' || s_suppkey END AS id FROM supplier),
c AS (SELECT *, CASE WHEN id IS NULL THEN 'no_stable_identity' WHEN k % 6 = 0 THEN 'title_not_company_colon_role' WHEN k % 7 = 0 THEN 'missing_title' END AS error_code FROM s)
SELECT 'weworkremotely:' || (k // {BODY}) AS task_key, k % {BODY} AS pos, error_code, CASE WHEN error_code IS NULL THEN id END AS external_id, CASE WHEN error_code IS NULL THEN CASE WHEN k % 9 > 0 THEN 'https://example.com/' || k ELSE id END END AS url,
    CASE WHEN error_code IS NULL THEN 'R&D ' || s_name END AS company, CASE WHEN error_code IS NULL THEN 'Lead: Team ' || k END AS title, CASE WHEN error_code IS NULL THEN land || CASE WHEN k % 2 = 0 THEN ', Earth' ELSE '' END END AS location,
    CASE WHEN error_code IS NULL THEN 'Work' || CASE WHEN k % 3 = 0 THEN ',Go' ELSE '' END END AS tags, CASE WHEN error_code IS NULL THEN 'Do it' END AS description FROM c""")
def rss_feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-04, F-11 to F-13, F-23, U-03, P-21: every item of the bodies, or why it is no posting."""
    p = lambda f: F.col(f"payload.{f}")
    rows = rss_feed.parse(rss_bodies(spark, sf_dir))
    return rows.select("task_key", "pos", "error_code", p("external_id").alias("external_id"), p("url").alias("url"), p("company").alias("company"), p("title").alias("title"), p("location").alias("location"), F.array_join(p("tags"), ",").alias("tags"), p("description_text").alias("description"))


#: Header lines by the remainder of a key, with its number in place of {k}, and a second line.
HEADERS = (
    ("Acme {k} | Backend Engineer | Berlin, Germany | Full-time", "We make things."),
    ("Acme {k} | Engineer | Remote | $80-120k", "Apply."),
    ("Acme {k} <a href='https://x.io/'>https://x.io/</a> | Remote Infrastructure Engineer | Paris", "x"),
    ("We are hiring {k}", "Engineer"),
    ("Acme {k} | Berlin, Germany | Full-time", "Site Reliability Engineer"),
    ("Acme {k} | &pound;90k-&pound;110k | https://acme.example | Contract Counsel | Visa", "x"),
    ("Acme {k} | Oslo | jobs@acme.example", "Nothing to see."),
)


def thread_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey"))
    number = F.col("k").cast("string")
    shown = F.lit("")
    for at, (header, more) in enumerate(HEADERS):
        before, after = header.split("{k}")
        shown = F.when(F.col("k") % len(HEADERS) == at, F.concat(F.lit(before), number, F.lit(f"{after}<p>{more}"))).otherwise(shown)
    row = lambda name, indent, body: F.concat(F.lit('<tr class="athing comtr" id="'), name, F.lit(f'"><td class="ind" indent="{indent}"></td><td><span class="age" title="2024-05-06T07:08:09 1714979289"></span><div class="commtext c00">'), body, F.lit("</div></td></tr>"))
    reply = F.when(_when(4), row(F.concat(F.lit("r"), number), 1, F.lit("Acme | Engineer | Remote"))).otherwise("")
    return _bodies(rows, "hackernews", F.concat(row(number, 0, shown), reply), F.col("k"), ("<table>", "</table>"), "\n")


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 7 AS f, 'Acme ' || c_custkey AS acme FROM customer)
SELECT CAST(k AS VARCHAR) AS external_id, CASE f WHEN 3 THEN 'header_not_pipe_delimited' WHEN 6 THEN 'no_role_identified' END AS error_code, CASE WHEN f NOT IN (3, 6) THEN acme END AS company,
    CASE f WHEN 0 THEN 'Backend Engineer' WHEN 1 THEN 'Engineer' WHEN 2 THEN 'Remote Infrastructure Engineer' WHEN 4 THEN 'Site Reliability Engineer' WHEN 5 THEN 'Contract Counsel' END AS title,
    CASE f WHEN 0 THEN 'Berlin, Germany' WHEN 1 THEN 'Remote' WHEN 2 THEN 'Paris' WHEN 4 THEN 'Berlin, Germany' END AS location, CASE WHEN f IN (0, 4) THEN 'Full-time' END AS employment_type,
    CASE f WHEN 1 THEN 80000 WHEN 5 THEN 90000 END AS low, CASE f WHEN 1 THEN 120000 WHEN 5 THEN 110000 END AS high, CASE f WHEN 1 THEN 'USD' WHEN 5 THEN 'GBP' END AS currency,
    CASE f WHEN 3 THEN NULL WHEN 6 THEN NULL WHEN 4 THEN 'hn-who-is-hiring,title-from-body' ELSE 'hn-who-is-hiring' END AS tags FROM c""")
def thread_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-03, F-14 to F-24, W-06, U-02, P-21: top-level comments as postings, by every form of the header."""
    p = lambda f: F.col(f"payload.{f}")
    rows = html_thread.parse(thread_bodies(spark, sf_dir))
    return rows.select("external_id", "error_code", p("company").alias("company"), p("title").alias("title"), p("location").alias("location"), p("employment_type").alias("employment_type"), p("salary_min").cast("int").alias("low"), p("salary_max").cast("int").alias("high"), p("salary_currency").alias("currency"), F.array_join(p("tags"), ",").alias("tags"))


@query("SELECT 'remoteok' AS source, count(*) AS n FROM part UNION ALL SELECT 'weworkremotely', count(*) FROM supplier UNION ALL SELECT 'hackernews', count(*) FROM customer")
def parse_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-01, U-01: the bodies of all sources in one relation, each read by its own parser."""
    landed = json_bodies(spark, sf_dir).unionByName(rss_bodies(spark, sf_dir)).unionByName(thread_bodies(spark, sf_dir))
    return landing.parse_all(landed).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT doc_id, nullif(substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 8000), '') AS plain FROM documents")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-11: documents written as markup with their special characters escaped, read back; the cut at 8,000 characters is the function's own."""
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return table(spark, sf_dir, "documents").select("doc_id", text.html_to_text(F.concat(F.lit("<div><p>"), escaped, F.lit("</p><br></div>"))).alias("plain"))


@query("SELECT doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS plain FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-02, F-12: documents escaped twice, read back."""
    once = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.replace(once, F.lit("&"), F.lit("&amp;"))).alias("plain"))


@query("""SELECT p_partkey, CASE p_partkey % 8 WHEN 2 THEN CAST(p_size AS BIGINT) WHEN 3 THEN CAST(p_size AS BIGINT) WHEN 5 THEN -CAST(p_size AS BIGINT) WHEN 6 THEN p_size * 10000000000 WHEN 7 THEN 1200 END AS amount,
    CASE WHEN p_partkey % 8 >= 4 AND p_partkey % 8 < 7 THEN true ELSE false END AS bad FROM part""")
def salary_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-13: empty, zero, whole, with a fraction, words, below zero, beyond reason, with an exponent."""
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    given = F.when(k == 0, "").when(k == 1, "0").when(k == 2, n).when(k == 3, F.concat(n, F.lit(".75"))).when(k == 4, "lots").when(k == 5, F.concat(F.lit("-"), n)).when(k == 6, F.concat(n, F.lit("e10"))).otherwise(" 1.2e3 ")
    amount = validate.salary(given)
    return table(spark, sf_dir, "part").select("p_partkey", amount.alias("amount"), validate.salary_error(given, amount).isNotNull().alias("bad"))


@query(f"""SELECT o_orderkey, d > TIMESTAMP '{AS_OF}' + INTERVAL 2 DAY OR d < TIMESTAMP '2005-01-01' AS bad FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderdate + INTERVAL 11350 DAY WHEN 1 THEN o_orderdate ELSE o_orderdate + INTERVAL 5000 DAY END AS d FROM orders)""")
def posted_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-15: times before 2005, or more than two days ahead, are errors."""
    d = F.col("o_orderdate").cast("timestamp") + F.when(F.col("o_orderkey") % 3 == 0, F.expr("INTERVAL 11350 DAYS")).when(F.col("o_orderkey") % 3 == 1, F.expr("INTERVAL 0 DAYS")).otherwise(F.expr("INTERVAL 5000 DAYS"))
    given = F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf_dir, "orders").select("o_orderkey", validate.timestamp_error(given, d, F.lit(AS_OF).cast("timestamp")).isNotNull().alias("bad"))


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN 'company:string_too_long' ELSE CASE p_partkey % 4 WHEN 0 THEN 'title:value_error' WHEN 1 THEN 'url:string_too_short' WHEN 2 THEN 'source:literal_error' ELSE 'foo:extra_forbidden' END END AS code FROM part
WHERE p_size <= 25 OR p_partkey % 4 IN (0, 3)""")
def field_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-06, P-07, P-11, P-17, P-19: a title with a line break, a short address, an unknown source, an unknown key, a long company."""
    k, none = F.col("p_partkey") % 4, F.lit(None).cast("string")
    values = {f: none for f in schema.ALLOWED} | {
        "source": F.when(k == 2, "elsewhere").otherwise("remoteok"), "external_id": F.col("p_partkey").cast("string"), "url": F.when(k == 1, "http:").otherwise("https://example.com"),
        "company": F.when(F.col("p_size") > 25, F.repeat(F.lit("x"), F.lit(301))).otherwise("Acme"), "title": F.when(k == 0, "Lead\nof more").otherwise("Lead"), "tags": F.array().cast("array<string>"),
    }
    empty = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "part").filter("p_size <= 25 OR p_partkey % 4 IN (0, 3)").select("p_partkey", F.struct(*(values[f].alias(f) for f in schema.ALLOWED)).alias("payload"), F.when(k == 3, F.array(F.lit("foo"))).otherwise(empty).alias("extra_keys"), empty.alias("missing_keys"))
    rows = validate.judged(rows, F.lit(AS_OF).cast("timestamp"))
    return rows.select("p_partkey", validate.reason_code(none, F.col("errors"), none).alias("code"))


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, struct_pack(ts := ts, event_id := event_id)) AS h FROM events GROUP BY ALL),
w AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY day) AS before FROM d)
SELECT CAST(user_id AS VARCHAR) AS dedup_key, CAST(min(day) AS VARCHAR) AS first_seen, CAST(max(day) AS VARCHAR) AS last_seen, max_by(h, day) AS content, count(*) FILTER (WHERE before IS NULL OR h <> before) AS revision,
    CAST(max(day) FILTER (WHERE before IS NULL OR h <> before) AS VARCHAR) AS last_changed, CAST(min(day) AS VARCHAR) AS first_run FROM w GROUP BY 1""")
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-01: a snapshot in the middle of the log, merged with the fold of what came after it, is the fold of all of it."""
    day = F.to_date("ts")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("dedup_key"), F.lit("s").alias("source"), F.lit("x").alias("external_id"), day.alias("seq"), day.cast("string").alias("run_id"), day.alias("seen_at"), F.col("ts").alias("at"), F.col("event_id").alias("pos"), F.col("event_type").alias("content_hash"))
    middle = F.lit("2024-01-15").cast("date")
    part = lambda some: fold.fold(some, order=("at", "pos"))
    out = run.merge(part(rows.filter(F.col("seq") <= middle)), part(rows.filter(F.col("seq") > middle)))
    return out.select("dedup_key", F.col("first_seen_at").cast("string").alias("first_seen"), F.col("last_seen_at").cast("string").alias("last_seen"), F.col("content_hash").alias("content"), "revision", F.col("last_changed_run_id").alias("last_changed"), F.col("first_seen_run_id").alias("first_run"))


@query("""SELECT user_id AS url, arg_max('e' || event_id, ts) FILTER (WHERE event_type = 'view') AS etag, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_fetched_at, arg_max(CAST(user_id % 2 * 100 + 200 AS INTEGER), ts) AS last_status, arg_max(event_id, ts) FILTER (WHERE value > 20) AS last_item_count
FROM (SELECT * REPLACE ('u' || user_id AS user_id), user_id % 2 AS odd FROM events) GROUP BY 1""".replace("CAST(user_id % 2 * 100", "CAST(odd * 100"))
def source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-02: the last state of each address; what an answer doesn't say stays as it was."""
    events = table(spark, sf_dir, "events")
    rows = events.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.when(F.col("event_type") == "view", F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.col("ts").alias("last_fetched_at"), (F.col("user_id") % 2 * 100 + 200).cast("int").alias("last_status"), F.when(F.col("value") > 20, F.col("event_id")).alias("last_item_count"))
    out = fold.source_state(rows)
    return out.select("url", "etag", F.date_format("last_fetched_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_fetched_at"), "last_status", "last_item_count")


@query("SELECT l_returnflag AS source, l_returnflag || ': all tasks failed (' || count(*) || '): HTTP 503' AS detail FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag = 'R')")
def failure_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H-03, A-22: the distinct errors of a source that failed as a whole, in one line."""
    none = verdict.baselines(runs(spark, sf_dir).filter("false"), tasks(spark, sf_dir).filter("false"))
    found = verdict.checks(outcomes(spark, sf_dir), none).filter("name LIKE 'source_reachable:%'")
    return found.select(F.substring_index("name", ":", -1).alias("source"), "detail")


@query("""SELECT event_id, CASE WHEN s < 90 THEN s || 's ago' WHEN s < 5400 THEN s // 60 || 'm ago' WHEN s < 172800 THEN s // 3600 || 'h ago' ELSE s // 86400 || 'd ago' END AS ago, regexp_replace(CAST(s AS VARCHAR), '(\\d)(\\d{3})$', '\\1,\\2') AS shown
FROM (SELECT event_id, (event_id * 97) % 900000 AS s FROM events)""")
def ago_and_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-30: ages and whole numbers as the page shows them."""
    s = (F.col("event_id") * 97) % 900000
    return table(spark, sf_dir, "events").select("event_id", text.ago(s).alias("ago"), text.thousands(s).alias("shown"))


@query("""SELECT event_id, CASE WHEN h < 1 THEN CAST(floor(h * 60) AS BIGINT) || ' min' WHEN h < 48 THEN CAST(round_even(h, 0) AS BIGINT) || ' h' ELSE CAST(round_even(h / 24, 0) AS BIGINT) || ' days' END AS age FROM (SELECT event_id, event_id % 400 / 4.0::DOUBLE AS h FROM events)""")
def humanised_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-28."""
    return table(spark, sf_dir, "events").select("event_id", text.humanise_hours(F.col("event_id") % 400 / 4).alias("age"))


@query("SELECT page_id, replace(url, '://', '://***@') AS url FROM pages")
def redacted_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-32: addresses with a login written into them, masked."""
    return table(spark, sf_dir, "pages").select("page_id", text.redact_login(F.replace("url", F.lit("://"), F.lit("://user:pass@"))).alias("url"))


@query("SELECT doc_id, split_part(text, ':', 1) AS company, substr(text, strpos(text, ':') + 1) AS role FROM documents WHERE contains(text, ':')")
def colon_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-13: at the first colon only."""
    rows = table(spark, sf_dir, "documents").filter(F.contains("text", F.lit(":")))
    return rows.select("doc_id", text.before_colon(F.col("text")).alias("company"), text.after_colon(F.col("text")).alias("role"))


@query("SELECT l_orderkey AS run_id, l_linenumber AS task_seq, l_quantity AS n FROM lineitem WHERE l_orderkey = 7")
def task_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-03: the tasks of one run."""
    from tidemark.operators import analytics

    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("task_seq"), F.col("l_quantity").alias("n"))
    return analytics.task_timings(rows, 7)


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN true ELSE false END AS place FROM part")
def place_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-17, U-02: names of places among words."""
    k = F.col("p_partkey") % 3
    shown = F.when(k == 0, F.element_at(F.array(*map(F.lit, ("Berlin", "based in Tokyo", "Hybrid (Oslo)", "Springfield, Ohio", "Kenya"))), (F.col("p_partkey") % 5 + 1).cast("int"))).when(k == 1, F.col("p_name")).otherwise("Series B")
    return table(spark, sf_dir, "part").select("p_partkey", headers.looks_like_place(shown).alias("place"))
