"""Every read query over the driver's tables, with its DuckDB twin.

Tables stand in for those of the engine: documents for postings, pages for postings in HTML, events for
observations, orders for runs, lineitem for tasks of runs. Times are fixed or taken from the table, never from the clock.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import headers, identity, text
from tidemark.functions.batches import small_batches
from tidemark.operators import analytics, fold, validate, verdict

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2026-02-14 12:00:00"
DOC_SOURCES = tuple(f"src{i}" for i in range(20))

JOBS_SQL = """jobs AS (SELECT doc_id, source, split_part(text, ' ', 1) AS company, text AS title, 'https://example.com/' || doc_id AS url,
    CASE WHEN n_chars % 3 = 0 THEN n_chars END AS salary_min, sha256(text) AS content_fingerprint,
    TIMESTAMP '2026-01-01' + to_days(CAST(doc_id % 45 AS INTEGER)) AS first_seen_at FROM documents)"""
RUNS_SQL = """runs AS (SELECT o_orderkey AS id, o_orderdate AS started_at, o_orderdate + INTERVAL 2 HOUR AS finished_at,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'succeeded' ELSE 'partial' END AS status FROM orders)"""



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.substring_index("text", " ", 1).alias("company"), F.col("text").alias("title"),
        F.concat(F.lit("https://example.com/"), F.col("doc_id").cast("string")).alias("url"), F.when(F.col("n_chars") % 3 == 0, F.col("n_chars")).alias("salary_min"),
        F.sha2("text", 256).alias("content_fingerprint"), F.expr("TIMESTAMP_NTZ'2026-01-01 00:00:00' + make_dt_interval(CAST(doc_id % 45 AS INT))").alias("first_seen_at"),
    )


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "succeeded").otherwise("partial")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("started_at"), (F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS")).alias("finished_at"), status.alias("status"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_returnflag").alias("source"), F.col("l_quantity").cast("bigint").alias("items_valid"), F.lit(False).alias("not_modified"))


def query(sql: str | None) -> Callable[[Query], Query]:
    """Registers a function under its name, without the trailing underscore, and its twin; what it sends to Python is bounded."""

    def add(f: Query) -> Query:
        @functools.wraps(f)
        def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return f(spark, sf_dir)

        name = f.__name__.rstrip("_")
        QUERIES[name] = bounded
        if sql:
            ORACLES[name] = sql
        return bounded

    return add


@query(f"""WITH {JOBS_SQL}, g AS (SELECT count(DISTINCT source) AS n FROM jobs GROUP BY content_fingerprint)
SELECT count(*) AS jobs, count(DISTINCT company) AS companies, count(salary_min) AS with_salary, count(DISTINCT content_fingerprint) AS distinct_groups,
    count(*) FILTER (WHERE first_seen_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) AS added_24h, (SELECT count(*) FROM g WHERE n > 1) AS cross_source_groups,
    (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O') AS quarantined,
    (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O' AND l_orderkey = (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)) AS quarantined_last_run,
    greatest(0, count(*) - count(DISTINCT content_fingerprint)) AS duplicates_collapsed FROM jobs""")
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-01 to A-08."""
    bad = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'").select(F.col("l_orderkey").alias("run_id"))
    return analytics.totals(jobs(spark, sf_dir), bad, runs(spark, sf_dir), as_of())


@query("SELECT doc_id, sha256(concat_ws(chr(31), 'v1', lower(trim(source)), CAST(doc_id AS VARCHAR))) AS dedup_key FROM documents")
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-07, F-08."""
    return table(spark, sf_dir, "documents").select("doc_id", identity.dedup_key(F.col("source"), F.col("doc_id")).alias("dedup_key"))


@query("""SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS normal FROM documents""")
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-01 to F-03, over whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("normal"))


@query(f"WITH {JOBS_SQL} SELECT content_fingerprint, count(*) AS n, count(DISTINCT source) AS sources FROM jobs GROUP BY 1 HAVING count(DISTINCT source) > 1")
def fingerprint_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-05."""
    out = jobs(spark, sf_dir).groupBy("content_fingerprint").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))
    return out.filter("sources > 1")


@query(f"""WITH {JOBS_SQL}, top AS (SELECT content_fingerprint AS f, count(DISTINCT source) AS s FROM jobs GROUP BY 1 HAVING count(*) > 1 ORDER BY s DESC, count(*) DESC, f LIMIT 10)
SELECT substr(f, 1, 12) AS fingerprint, min(company) AS company, min(title) AS title, max(n) AS n, s > 1 AS spans_sources,
    CASE WHEN s > 1 THEN 'across sources' ELSE 'same source, repeated' END AS kind, string_agg(source, ',' ORDER BY source, url) AS sources
FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY source, url) AS r, count(*) OVER (PARTITION BY f) AS n FROM jobs JOIN top ON content_fingerprint = f) WHERE r <= 50 GROUP BY f, s""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-14, A-15, J-01, T-05, T-06: the ten groups, and the rows shown of each, are the feature."""
    out = analytics.duplicate_groups(jobs(spark, sf_dir))
    return out.select("fingerprint", "company", "title", "n", "spans_sources", "kind", F.array_join(F.transform("rows", lambda r: r["source"]), ",").alias("sources"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-01."""
    return fold.last_wins(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]).drop("ts")


_HALVES = "SELECT user_id || ' ' || CAST(ts AS DATE) AS key, max_by(event_type, struct_pack(ts := ts, event_id := event_id)) AS event_type FROM events WHERE event_id {op} (SELECT max(event_id) / 2 FROM events) GROUP BY 1"


@query(f"""WITH old AS ({_HALVES.format(op="<")}), new AS ({_HALVES.format(op=">=")})
SELECT key, CASE WHEN old.event_type IS NULL THEN 'inserted' WHEN new.event_type IS NULL THEN 'untouched' WHEN old.event_type = new.event_type THEN 'unchanged' ELSE 'updated' END AS action
FROM old FULL JOIN new USING (key)""")
def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-02, J-03, M-01: what a batch does to what is stored; both sides are the last row of each key, a user's day."""
    key = F.concat_ws(" ", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    events = table(spark, sf_dir, "events").select(key.alias("key"), "ts", "event_id", "event_type")
    half = events.agg((F.max("event_id") / 2).alias("half"))
    cut = events.join(F.broadcast(half), F.lit(True))
    old = fold.last_wins(cut.filter("event_id < half").drop("half"), ["key"], ["ts", "event_id"])
    new = fold.last_wins(cut.filter("event_id >= half").drop("half"), ["key"], ["ts", "event_id"])
    return fold.upsert_actions(old, new, "key", "event_type")


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, struct_pack(ts := ts, event_id := event_id)) AS h FROM events GROUP BY ALL),
w AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY day) AS before FROM d)
SELECT user_id, CAST(min(day) AS VARCHAR) AS first_seen, CAST(max(day) AS VARCHAR) AS last_seen, max_by(h, day) AS content, count(*) FILTER (WHERE before IS NULL OR h <> before) AS revision,
    CAST(max(day) FILTER (WHERE before IS NULL OR h <> before) AS VARCHAR) AS last_changed FROM w GROUP BY 1""")
def change_tracking_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-01, W-03: the fold over commits, one a day."""
    rows = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("seq"), F.to_date("ts").cast("string").alias("run_id"), F.to_date("ts").alias("seen_at"), F.col("ts").alias("at"), F.col("event_id").alias("pos"), F.col("event_type").alias("content_hash"))
    out = fold.fold(rows, key="user_id", order=("at", "pos"), fixed=())
    return out.select("user_id", F.col("first_seen_at").cast("string").alias("first_seen"), F.col("last_seen_at").cast("string").alias("last_seen"), F.col("content_hash").alias("content"), "revision", F.col("last_changed_run_id").alias("last_changed"))


@query(f"""WITH {JOBS_SQL}, c AS (SELECT CAST(first_seen_at AS DATE) AS day, source, count(*) AS n FROM jobs GROUP BY ALL),
axis AS (SELECT CAST(unnest(generate_series(DATE '{AS_OF[:10]}' - 29, DATE '{AS_OF[:10]}', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT CAST(day AS VARCHAR) AS day, source, coalesce(n, 0) AS n FROM axis CROSS JOIN (SELECT DISTINCT source FROM c WHERE day > DATE '{AS_OF[:10]}' - 30 AND day <= DATE '{AS_OF[:10]}') LEFT JOIN c USING (day, source)""")
def daily_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-10, A-11, J-05."""
    return analytics.daily(jobs(spark, sf_dir), as_of()).select(F.col("day").cast("string").alias("day"), "source", "n")


@query(f"""WITH {JOBS_SQL}, c AS (SELECT CAST(first_seen_at AS DATE) AS day, source, count(*) AS n FROM jobs GROUP BY ALL),
axis AS (SELECT CAST(unnest(generate_series(DATE '{AS_OF[:10]}' - 29, DATE '{AS_OF[:10]}', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT source, source AS label, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY day) AS series FROM axis CROSS JOIN (SELECT DISTINCT source FROM c WHERE day > DATE '{AS_OF[:10]}' - 30 AND day <= DATE '{AS_OF[:10]}') LEFT JOIN c USING (day, source) GROUP BY 1""")
def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-11: one series for each source."""
    return analytics.daily_series(jobs(spark, sf_dir), as_of()).withColumn("series", F.array_join("series", ","))


@query("SELECT source, source AS label, count(*) AS count FROM documents GROUP BY 1")
def by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-09, for every source of the table; the list gives the order only."""
    return analytics.by_source(jobs(spark, sf_dir), DOC_SOURCES, others=True)


@query(f"""WITH {RUNS_SQL}, d AS (SELECT DISTINCT CAST(finished_at AS DATE) AS day FROM runs WHERE status <> 'failed'), t AS (SELECT max(day) + 1 AS today FROM d),
g AS (SELECT day, day + CAST(row_number() OVER (ORDER BY day DESC) AS INTEGER) AS island FROM d)
SELECT count(*) AS consecutive_days FROM g WHERE island = (SELECT max(island) FROM g WHERE day >= (SELECT today FROM t) - 1)""")
def streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-02, A-23; today is the day after the last good run."""
    days = runs(spark, sf_dir).filter("status <> 'failed'").select(F.to_date("finished_at").alias("day"))
    last = days.agg(F.max("day").alias("last")).scalar()
    return analytics.streak(days, F.date_add(last, 1))


@query("SELECT 'user' || user_id AS company, count(*) AS count, count(DISTINCT event_type) AS sources FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12")
def top_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-12, T-05: the twelve are the feature."""
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("company"), F.col("event_type").alias("source"))
    return analytics.top_companies(rows)


@query("""WITH q AS (SELECT source, CASE WHEN n_chars < 200 THEN 'text:string_too_short' WHEN n_chars > 4000 THEN 'text:string_too_long' END AS code, text AS reason FROM documents)
SELECT code, source, source AS label, count(*) AS count, min(reason) AS example FROM q WHERE code IS NOT NULL GROUP BY ALL ORDER BY 4 DESC, 1, 2 LIMIT 10""")
def quarantine_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-13, P-07, P-19: the ten are the feature."""
    code = F.when(F.col("n_chars") < 200, "text:string_too_short").when(F.col("n_chars") > 4000, "text:string_too_long")
    bad = table(spark, sf_dir, "documents").select("source", code.alias("reason_code"), F.col("text").alias("reason"))
    return analytics.quarantine_breakdown(bad.filter("reason_code IS NOT NULL"))


@query("SELECT doc_id, source FROM documents WHERE n_chars < 200 ORDER BY n_chars DESC, doc_id DESC LIMIT 20")
def recent_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-02: the twenty are the feature."""
    rows = table(spark, sf_dir, "documents").filter("n_chars < 200").select("doc_id", "source", F.col("n_chars").alias("created_at"), F.lit("").alias("task_key"), F.col("doc_id").alias("pos"))
    return analytics.recent_quarantine(rows).select("doc_id", "source")


_BASE = """recent AS (SELECT id FROM runs WHERE status <> 'failed' ORDER BY started_at DESC, id DESC LIMIT {n}),
sums AS (SELECT l_orderkey, l_returnflag AS source, sum(CAST(l_quantity AS BIGINT)) AS n FROM lineitem WHERE l_orderkey IN (SELECT id FROM recent) GROUP BY ALL),
base AS (SELECT source, median(n) AS baseline FROM sums GROUP BY 1)"""


@query(f"WITH {RUNS_SQL}, {_BASE.format(n=10)} SELECT source, CAST(baseline AS DOUBLE) AS baseline FROM base")
def baseline_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-17, J-04, W-07."""
    return verdict.baselines(runs(spark, sf_dir), tasks(spark, sf_dir))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks that ended: those of line status O have quarantined items; return flag R stands for failed ones."""
    rows = table(spark, sf_dir, "lineitem")
    n = F.col("l_quantity").cast("bigint")
    bad = F.when(F.col("l_linestatus") == "O", F.floor(n / 10)).otherwise(F.lit(0)).cast("bigint")
    ok = F.col("l_returnflag") != "R"
    return rows.select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("task_key"), F.col("l_returnflag").alias("source"), ok.alias("ok"), F.lit(False).alias("not_modified"), n.alias("items_seen"), F.when(ok, n - bad).otherwise(F.lit(0)).alias("items_valid"), bad.alias("items_quarantined"), F.when(~ok, F.lit("HTTP 503")).alias("error"))


_OUTCOMES = """o AS (SELECT l_returnflag AS source, l_returnflag <> 'R' AS ok, CAST(l_quantity AS BIGINT) AS seen, CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) // 10 ELSE 0 END AS bad FROM lineitem),
p AS (SELECT *, CASE WHEN ok THEN seen - bad ELSE 0 END AS valid FROM o)"""


@query(f"""WITH {_OUTCOMES}, rate AS (SELECT sum(bad)::DOUBLE / sum(seen) AS r, sum(valid) AS valid FROM p), down AS (SELECT count(*) AS n FROM (SELECT source FROM p GROUP BY 1 HAVING bool_and(NOT ok)))
SELECT CASE WHEN r > 0.25 OR valid = 0 OR down.n > 0 THEN 'failed' WHEN EXISTS (SELECT 1 FROM p WHERE NOT ok) THEN 'partial' ELSE 'succeeded' END AS status, round(r, 4) AS quarantine_rate FROM rate, down""")
def run_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H-01, H-02, H-03, H-05, A-18, A-21."""
    rows = outcomes(spark, sf_dir)
    none = verdict.baselines(runs(spark, sf_dir).filter("false"), tasks(spark, sf_dir).filter("false"))
    found = verdict.checks(rows, none)
    rate = found.filter("name = 'quarantine_rate'").select(F.col("value").alias("quarantine_rate"))
    return verdict.status(found, rows).select("status").join(F.broadcast(rate), F.lit(True))


@query("SELECT event_type AS source, coalesce(bool_and(value < 50) FILTER (WHERE user_id % 2 = 0), false) AS unchanged FROM events GROUP BY 1")
def all_not_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-19."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), (F.col("value") < 50).alias("not_modified"), (F.col("user_id") % 2 == 0).alias("ok"))
    return rows.groupBy("source").agg(verdict.all_unchanged().alias("unchanged"))


@query("SELECT source, round(coalesce(count(*) FILTER (WHERE n_chars < 200 OR n_chars > 4000)::DOUBLE / nullif(count(*), 0), 0), 4) AS rate FROM documents GROUP BY 1")
def quarantine_rate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-21."""
    bad = F.count_if((F.col("n_chars") < 200) | (F.col("n_chars") > 4000))
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.round(F.coalesce(F.try_divide(bad, F.count("*")), F.lit(0.0)), 4).alias("rate"))


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-04, J-07."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("started_at"), F.col("o_orderstatus").alias("status"))
    return analytics.latest_run(rows).select("id", "status")


@query(f"""WITH {JOBS_SQL} SELECT doc_id, source, title FROM jobs WHERE source = 'src3' AND (lower(title) LIKE '%the%' OR lower(company) LIKE '%the%') ORDER BY first_seen_at DESC, doc_id DESC LIMIT 40""")
def recent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-03, P-04, T-01, K-08: the limit is the feature."""
    rows = jobs(spark, sf_dir).withColumn("first_seq", F.col("doc_id")).withColumn("dedup_key", F.lit(""))
    return analytics.recent_jobs(rows, 40, "src3", "The").select("doc_id", "source", "title")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') IS NULL AS absent FROM events")
def json_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a VARIANT, and whether a key is there, as the JSON source reads them."""
    v = F.try_parse_json("props")
    rows = table(spark, sf_dir, "events").withColumn("v", v)
    return rows.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.try_variant_get("v", "$.missing", "variant").isNull().alias("absent"))


@query("SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def unlabeled_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-08."""
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query(r"SELECT doc_id, len(p) AS n_parts, p[1] AS company FROM (SELECT doc_id, list_filter(list_transform(string_split(text, '|'), lambda x: regexp_replace(x, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g')), lambda x: x <> '') AS p FROM documents) WHERE len(p) > 1")
def split_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-15: texts in the ``Company | Role`` form."""
    rows = table(spark, sf_dir, "documents").select("doc_id", headers.parts_of(F.col("text")).alias("p")).filter(F.size("p") > 1)
    return rows.select("doc_id", F.size("p").cast("bigint").alias("n_parts"), F.element_at("p", 1).alias("company"))


_NOISE = f"({text.TITLE_NOISE})"


@query(rf"""SELECT p_partkey, trim(regexp_replace(lower(strip_accents(regexp_replace('New ' || p_name || ' (Remote)', '[\(\[\{{][^)\]\}}]*[\)\]\}}]', ' ', 'g').regexp_replace('(?i)\b{_NOISE}\b', ' ', 'g'))), '[^a-z0-9]+', ' ', 'g')) AS title FROM part""")
def title_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-05."""
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_title(F.concat(F.lit("New "), "p_name", F.lit(" (Remote)"))).alias("title"))


_SUFFIX = "|".join(text.COMPANY_SUFFIXES)


@query(rf"""WITH n AS (SELECT s_suppkey, trim(regexp_replace(lower(s_name || CASE s_suppkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' GmbH Co' WHEN 2 THEN ' Holding' ELSE ' LTD (Europe)' END), '[^a-z0-9]+', ' ', 'g')) AS a,
    trim(regexp_replace(lower(regexp_replace(s_name || CASE s_suppkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' GmbH Co' WHEN 2 THEN ' Holding' ELSE ' LTD (Europe)' END, '\([^)]*\)', ' ', 'g')), '[^a-z0-9]+', ' ', 'g')) AS b FROM supplier)
SELECT s_suppkey, regexp_replace(b, '( ({_SUFFIX}))+$', '') AS company FROM n""")
def company_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-04."""
    k = F.col("s_suppkey") % 4
    name = F.concat("s_name", F.when(k == 0, ", Inc.").when(k == 1, " GmbH Co").when(k == 2, " Holding").otherwise(" LTD (Europe)"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.normalize_company(name).alias("company"))


_ALIASES = ", ".join(f"'{a}'" for a in text.REMOTE_ALIASES)


@query(rf"""WITH n AS (SELECT n_nationkey, trim(regexp_replace(lower(CASE n_nationkey % 3 WHEN 0 THEN ' Anywhere in the World! ' WHEN 1 THEN '100% Remote' ELSE n_name END), '[^a-z0-9]+', ' ', 'g')) AS l FROM nation)
SELECT n_nationkey, CASE WHEN l IN ({_ALIASES}) THEN 'remote' ELSE l END AS location FROM n""")
def location_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-06."""
    k = F.col("n_nationkey") % 3
    return table(spark, sf_dir, "nation").select("n_nationkey", text.normalize_location(F.when(k == 0, " Anywhere in the World! ").when(k == 1, "100% Remote").otherwise(F.col("n_name"))).alias("location"))


@query("""SELECT p_partkey, CAST(30 + p_size AS INTEGER) * 1000 AS low, CAST(130 + p_size AS INTEGER) * 1000 AS high, CASE p_partkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' ELSE 'EUR' END AS currency FROM part""")
def salary_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-19: amounts written into part names, one form for each remainder, the order reversed in some."""
    k, low, high = F.col("p_partkey") % 3, (30 + F.col("p_size")).cast("string"), (130 + F.col("p_size")).cast("string")
    sign = F.when(k == 0, "$").when(k == 1, "£").otherwise("€")
    written = F.when(k == 0, F.concat(sign, low, F.lit("-"), high, F.lit("k"))).when(k == 1, F.concat(sign, high, F.lit("k – "), sign, low, F.lit("k"))).otherwise(F.concat(sign, low, F.lit(",000 to "), high, F.lit(",000")))
    rows = table(spark, sf_dir, "part").select("p_partkey", headers.money(F.concat("p_name", F.lit(" "), written)).alias("m"))
    return rows.select("p_partkey", "m.low", "m.high", "m.currency")


@query(f"""WITH {RUNS_SQL}, l AS (SELECT max(finished_at) AS at, max_by(status, struct_pack(f := finished_at, i := id)) AS st FROM runs WHERE status <> 'failed'), a AS (SELECT max_by(status, struct_pack(s := started_at, i := id)) AS st FROM runs),
k AS (SELECT unnest([1, 20, 40]) AS hours)
SELECT hours, CASE WHEN (epoch_us(now_) - epoch_us(l.at)) / 3600000000 > 30 THEN 'critical' WHEN a.st = 'failed' OR l.st = 'partial' THEN 'warning' ELSE 'good' END AS state
FROM (SELECT hours, (SELECT max(finished_at) FROM runs) + to_hours(hours) AS now_ FROM k), l, a""")
def health_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H-06 at three distances from the last run."""
    rows = runs(spark, sf_dir)
    last = rows.agg(F.max("finished_at").alias("last")).scalar()
    out = None
    for hours in (1, 20, 40):
        now = last + F.expr(f"INTERVAL {hours} HOURS")
        own = analytics.health(rows, now).select(F.lit(hours).alias("hours"), "state")
        out = own if out is None else out.unionAll(own)
    return out


@query("SELECT l_returnflag AS source, bool_and(l_returnflag = 'R') AS down, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def source_reachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H-03, A-22."""
    none = verdict.baselines(runs(spark, sf_dir).filter("false"), tasks(spark, sf_dir).filter("false"))
    rows = outcomes(spark, sf_dir)
    down = verdict.checks(rows, none).filter("name LIKE 'source_reachable:%'").select(F.substring_index("name", ":", -1).alias("source"), F.lit(True).alias("down"))
    return rows.groupBy("source").agg(F.count("*").alias("n")).join(down, "source", "left").select("source", F.coalesce("down", F.lit(False)).alias("down"), "n")


@query(f"""WITH {RUNS_SQL}, {_BASE.format(n=50)}, cur AS (SELECT l_returnflag AS source, sum(CAST(l_quantity AS BIGINT)) AS n FROM lineitem WHERE l_orderkey = (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) GROUP BY 1)
SELECT 'parser_health:' || source AS name, coalesce(n, 0) >= baseline * 0.2 AS ok, CAST(coalesce(n, 0) AS DOUBLE) AS value, round(baseline * 0.2, 1) AS threshold FROM base LEFT JOIN cur USING (source) WHERE baseline >= 10""")
def parser_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H-04, J-06: the latest run against the median of the last fifty."""
    last = analytics.latest_run(runs(spark, sf_dir)).select(F.col("id").alias("run_id"))
    now = tasks(spark, sf_dir).join(F.broadcast(last), "run_id", "left_semi").select(F.lit("").alias("task_key"), "source", F.lit(True).alias("ok"), "not_modified", F.col("items_valid").alias("items_seen"), "items_valid", F.lit(0).cast("bigint").alias("items_quarantined"), F.lit(None).cast("string").alias("error"))
    base = verdict.baselines(runs(spark, sf_dir), tasks(spark, sf_dir), 50)
    return verdict.checks(now, base).filter("name LIKE 'parser_health:%'").select("name", "ok", "value", "threshold")


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max_by(event_type, struct_pack(ts := ts, event_id := event_id)) AS h FROM events GROUP BY ALL), w AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY day) AS before FROM d),
f AS (SELECT user_id, min(day) AS first_, max(day) AS last_, max(day) FILTER (WHERE before IS NULL OR h <> before) AS changed FROM w GROUP BY 1), r AS (SELECT max(day) AS day FROM d)
SELECT count(*) FILTER (WHERE last_ = r.day) AS touched, count(*) FILTER (WHERE last_ = r.day AND first_ = r.day) AS inserted, count(*) FILTER (WHERE last_ = r.day AND first_ < r.day AND changed = r.day) AS updated,
    count(*) FILTER (WHERE last_ = r.day AND first_ < r.day AND changed < r.day) AS unchanged FROM f, r""")
def run_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-20: the last day's run, recounted from the state."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    rows = events.select("user_id", day.alias("seq"), day.cast("string").alias("run_id"), day.alias("seen_at"), F.col("ts").alias("at"), F.col("event_id").alias("pos"), F.col("event_type").alias("content_hash"))
    last = events.agg(F.max(day).cast("string").alias("last")).scalar()
    return analytics.recount(fold.fold(rows, key="user_id", order=("at", "pos"), fixed=()), last)


@query("SELECT l_linestatus || l_returnflag AS state, count(*) AS n FROM lineitem GROUP BY 1")
def task_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-16."""
    return analytics.task_histogram(table(spark, sf_dir, "lineitem").select(F.concat("l_linestatus", "l_returnflag").alias("state")))


@query(f"WITH {RUNS_SQL} SELECT id, status FROM runs ORDER BY started_at DESC, id DESC LIMIT 30")
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-05, T-04: the thirty are the feature."""
    return analytics.run_history(runs(spark, sf_dir)).select("id", "status")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O' ANTI JOIN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F') USING (l_orderkey, l_linenumber)".replace("FROM lineitem WHERE l_linestatus = 'O' ANTI", "FROM (SELECT * FROM lineitem WHERE l_linestatus = 'O') ANTI"))
def resume_open_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-08, M-09: line status O stands for claims, F for ends; what was claimed and not ended is open."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("r").alias("run_id"), F.col("l_orderkey").alias("task_seq"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("task_key"), F.lit("").alias("source"), F.lit("").alias("url"),
        F.when(F.col("l_linestatus") == "F", "done").otherwise("claimed").alias("event"), F.col("l_shipdate").alias("at"), F.lit(200).alias("http_status"), F.lit(False).alias("not_modified"),
        F.lit(0).cast("bigint").alias("items_seen"), F.lit(0).cast("bigint").alias("items_valid"), F.lit(0).cast("bigint").alias("items_quarantined"), F.lit(None).cast("string").alias("error"),
    )
    parts = F.split("task_key", ":")
    return fold.task_states(rows).filter("state = 'pending'").select(parts[0].cast("bigint").alias("l_orderkey"), parts[1].cast("int").alias("l_linenumber"))


@query("""WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN CAST(epoch(o_orderdate)::BIGINT AS VARCHAR) WHEN 2 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S +0000') ELSE 'soon' END AS s, o_orderdate AS d FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(d, '%Y-%m-%d %H:%M:%S') END AS posted_at FROM s""")
def timestamp_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-14: order dates written in each of the forms that feeds use, read back."""
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate").cast("timestamp")
    mail = F.concat(F.date_format(d, "EEE"), F.lit(", "), F.date_format(d, "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    written = F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.concat(F.lit(schema.EPOCH), F.unix_timestamp(d).cast("string"))).when(k == 2, mail).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(validate.timestamp(written), "yyyy-MM-dd HH:mm:ss").alias("posted_at"))


@query("""WITH d AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN ' TBD ' ELSE 'Acme' END AS company, CASE doc_id % 5 WHEN 0 THEN 'x' ELSE 'Engineer' END AS title, CASE doc_id % 3 WHEN 0 THEN 'ftp://example.com' ELSE 'https://example.com' END AS url, doc_id % 11 = 0 AS swapped FROM documents),
e AS (SELECT doc_id, list_filter([CASE WHEN url LIKE 'ftp%' THEN 'url:value_error' END, CASE WHEN company = '' THEN 'company:string_too_short' WHEN company = ' TBD ' THEN 'company:value_error' END, CASE WHEN title = 'x' THEN 'title:string_too_short' END], lambda x: x IS NOT NULL) AS f, swapped FROM d)
SELECT doc_id, CASE WHEN len(f) > 0 THEN f[1] WHEN swapped THEN '<root>:value_error' ELSE 'valid' END AS code, CASE WHEN len(f) > 0 THEN len(f) WHEN swapped THEN 1 ELSE 0 END AS n_errors FROM e""")
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-06 to P-19: postings built from document ids; all errors of a field after the first are skipped, all fields are judged."""
    k = lambda n: F.col("doc_id") % n
    none = F.lit(None).cast("string")
    values = {
        "source": F.lit("remoteok"), "external_id": F.col("doc_id").cast("string"), "url": F.when(k(3) == 0, "ftp://example.com").otherwise("https://example.com"),
        "company": F.when(k(7) == 0, "").when(k(7) == 1, " TBD ").otherwise("Acme"), "title": F.when(k(5) == 0, "x").otherwise("Engineer"), "location": none, "employment_type": none,
        "salary_min": F.when(k(11) == 0, "90000").otherwise("10000"), "salary_max": F.lit("20000"), "salary_currency": none, "tags": F.array().cast("array<string>"), "description_text": none, "posted_at": none,
    }
    empty = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.struct(*(c.alias(n) for n, c in values.items())).alias("payload"), empty.alias("extra_keys"), empty.alias("missing_keys"))
    rows = validate.judged(rows, F.lit(AS_OF).cast("timestamp"))
    code = F.when(F.size("errors") == 0, "valid").otherwise(validate.reason_code(F.lit(None), F.col("errors"), F.lit(None)))
    return rows.select("doc_id", code.alias("code"), F.size("errors").cast("bigint").alias("n_errors"))


@query(r"SELECT doc_id, strftime(date_trunc('day', first_seen_at), '%Y-%m-%d') AS day, count(*) OVER (PARTITION BY date_trunc('day', first_seen_at)) AS that_day FROM jobs".join([f"WITH {JOBS_SQL} ", ""]))
def day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-25, F-26."""
    rows = jobs(spark, sf_dir).select("doc_id", F.date_format(F.to_date("first_seen_at"), "yyyy-MM-dd").alias("day"))
    return rows.join(rows.groupBy("day").agg(F.count("*").alias("that_day")), "day")


@query("SELECT p_partkey, '$' || CAST((100000 + p_size * 1000) // 1000 AS VARCHAR) || CASE WHEN p_partkey % 2 = 0 THEN 'k–$' || CAST((150000 + p_size * 1000) // 1000 AS VARCHAR) || 'k' ELSE 'k+' END AS label FROM part")
def salary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-29."""
    low, high = 100000 + F.col("p_size") * 1000, F.when(F.col("p_partkey") % 2 == 0, 150000 + F.col("p_size") * 1000)
    return table(spark, sf_dir, "part").select("p_partkey", text.salary_label(low, high, F.lit("USD")).alias("label"))


@query("SELECT n_nationkey, 'https://example.com/feed?a=' || n_nationkey || '&b=x%26y' AS url FROM nation")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-27: parameters in order, encoded."""
    from tidemark.functions import requests

    params = F.create_map(F.lit("b"), F.lit("x&y"), F.lit("a"), F.col("n_nationkey").cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", requests.canonical_url(F.lit("https://example.com/feed"), params).alias("url"))
