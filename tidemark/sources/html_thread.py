"""S-03: a discussion thread in HTML whose top-level comments are postings; S-02: which threads to read."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.functions import headers, text
from tidemark.functions.batches import small_batches
from tidemark.schema import ALLOWED, PAYLOAD
from tidemark.sources.landing import records

SOURCE = "hackernews"
ITEM_URL = "https://news.ycombinator.com/item?id="
_COMMENT = StructType([StructField("id", StringType()), StructField("indent", StringType()), StructField("posted_at", StringType()), StructField("lines", ArrayType(StringType())), StructField("plain", StringType())])


class _Thread(HTMLParser):
    """Comments in page order; the body of each is followed by depth of its ``div``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.comments: list[dict] = []
        self.depth = 0  # inside a comment's body

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        names = a.get("class", "").split()
        if tag == "tr" and "athing" in names and "comtr" in names:
            self.comments.append({"id": a.get("id", "").strip(), "indent": "0", "posted_at": None, "parts": None})
            self.depth = 0
        if not self.comments:
            return
        now = self.comments[-1]
        if self.depth:
            if tag == "div":
                self.depth += 1
            if tag in ("br", "p"):
                now["parts"].append("\n")
        elif tag == "div" and "commtext" in names and now["parts"] is None:
            now["parts"], self.depth = [], 1
        elif tag == "td" and "ind" in names:
            now["indent"] = a.get("indent") or "0"
        elif tag == "span" and "age" in names and a.get("title"):
            now["posted_at"] = a["title"].split()[0]

    def handle_endtag(self, tag: str) -> None:
        if self.depth and tag == "div":
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.depth:
            self.comments[-1]["parts"].append(data)


def comments_of(page: str | None) -> list[dict]:
    parser = _Thread()
    parser.feed(page or "")
    parser.close()
    out = []
    for c in parser.comments:
        body = None if c["parts"] is None else "".join(c["parts"])
        lines = None if body is None else [x.strip() for x in body.split("\n") if x.strip()]
        out.append({"id": c["id"], "indent": c["indent"], "posted_at": c["posted_at"], "lines": lines, "plain": None if body is None else (" ".join(body.split())[: text.MAX_DESCRIPTION] or None)})
    return out


@F.pandas_udf(ArrayType(_COMMENT))
def comments(pages: pd.Series) -> pd.Series:
    return pages.map(comments_of)


def problems(landing: DataFrame) -> DataFrame:
    """Pages without comment rows: the markup has changed, which is worse than a few bad postings."""
    own = landing.filter((F.col("source") == SOURCE) & F.col("body").isNotNull())
    return own.filter(~F.col("body").rlike(r"(?s)<tr[^>]*class\s*=\s*['\"][^'\"]*\bcomtr\b")).select("task_key", F.lit("a thread without a row of comments: the page is built in another way now").alias("error"))


def parse(landing: DataFrame) -> DataFrame:
    small_batches(landing.sparkSession)
    own = landing.filter((F.col("source") == SOURCE) & F.col("body").isNotNull())
    rows = own.select("task_key", F.col("meta")["thread_id"].alias("thread_id"), F.posexplode(comments("body")).alias("pos", "c"))
    rows = rows.select("task_key", "thread_id", "pos", *(F.col(f"c.{f}").alias(f) for f in _COMMENT.names))
    rows = rows.filter("indent = '0' AND lines IS NOT NULL AND id <> ''")
    header = F.coalesce(F.try_element_at(F.col("lines"), F.lit(1)), F.lit(""))
    rows = text.once(rows.withColumn("header", header), "role", headers.role_from_body(F.col("lines")))
    rows = headers.parsed(rows, "h", F.col("header"), F.col("role"))
    code = F.col("h.error_code")
    shown = F.concat(F.lit(" in '"), F.substring("header", 1, 120), F.lit("'"))
    error = F.when(code == "header_not_pipe_delimited", F.concat(F.lit("no bars part the first line"), shown)).when(
        code == "no_role_identified", F.concat(F.lit("neither the first line nor those behind it name a role"), shown)
    )
    tags = F.when(F.col("h.from_body"), F.array(F.lit("hn-who-is-hiring"), F.lit("title-from-body"))).otherwise(F.array(F.lit("hn-who-is-hiring")))
    payload = {
        "source": F.lit(SOURCE),
        "external_id": F.col("id"),
        "url": F.concat(F.lit(ITEM_URL), F.col("id")),
        "company": text.clean_text(F.col("h.company")),
        "title": text.clean_text(F.col("h.title")),
        "location": text.clean_text(F.col("h.location")),
        "employment_type": F.col("h.employment_type"),
        "salary_min": F.col("h.salary_min").cast("string"),
        "salary_max": F.col("h.salary_max").cast("string"),
        "salary_currency": F.col("h.salary_currency"),
        "tags": tags,
        "description_text": F.col("plain"),
        "posted_at": F.col("posted_at"),
    }
    struct = F.struct(*(payload[k].alias(k) for k in ALLOWED)).cast(PAYLOAD)
    raw = F.to_json(F.struct(F.col("id").alias("comment_id"), "header", "thread_id", "posted_at", F.substring(F.array_join("lines", "\n"), 1, 500).alias("text_preview")), {"ignoreNullFields": "false"})
    return records(rows, SOURCE, F.col("id"), struct, error, code, raw)


def threads(search: DataFrame, n: int) -> DataFrame:
    """S-02: thread_id, title of the first ``n`` hits of a search answer (a ``body``) that ask who is hiring; none is an error."""
    own = search.select(F.parse_json("body").alias("v"))
    hits = own.lateralJoin(own.sparkSession.tvf.variant_explode(F.variant_get("v", "$.hits", "variant").outer()))
    hits = hits.select("pos", F.try_variant_get("value", "$.title", "string").alias("title"), F.try_variant_get("value", "$.objectID", "string").alias("thread_id"))
    found = hits.filter(F.contains(F.lower("title"), F.lit("who is hiring")) & (F.coalesce("thread_id", F.lit("")) != "")).orderBy("pos").limit(n)
    some = found.agg(F.assert_true(F.count("*") > 0, F.lit("no thread found")).alias("ok"))
    return found.join(F.broadcast(some), F.lit(True)).filter("ok IS NULL").orderBy("pos").select("thread_id", "title")
