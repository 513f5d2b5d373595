"""S-04: an RSS feed of postings, read with ``from_xml``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.batches import small_batches
from tidemark.schema import ALLOWED, PAYLOAD
from tidemark.sources.landing import records

SOURCE = "weworkremotely"
_FIELDS = ("title", "region", "country", "state", "skills", "category", "type", "description", "pubDate", "guid", "link")
SCHEMA = f"channel struct<item array<struct<{', '.join(f'{f}: string' for f in _FIELDS)}>>>, _corrupt_record string"
RAW = ("title", "region", "country", "state", "category", "type", "pubDate", "link")


def _read(landing: DataFrame) -> DataFrame:
    own = landing.filter((F.col("source") == SOURCE) & F.col("body").isNotNull())
    return own.withColumn("x", F.from_xml("body", SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))


def problems(landing: DataFrame) -> DataFrame:
    return _read(landing).filter("x._corrupt_record IS NOT NULL").select("task_key", F.lit("feed is not well-formed XML").alias("error"))


def _field(name: str) -> Column:
    """The element's text, stripped; empty ones are null."""
    v = text.strip(F.col(f"item.{name}"))
    return F.when(v != "", v)


def parse(landing: DataFrame) -> DataFrame:
    small_batches(landing.sparkSession)
    rows = _read(landing).filter("x._corrupt_record IS NULL").select("task_key", F.posexplode("x.channel.item").alias("pos", "item"))
    identity = F.coalesce(_field("guid"), _field("link"))
    title = _field("title")
    code = F.when(identity.isNull(), "no_stable_identity").when(title.isNull(), "missing_title").when(~F.contains(title, F.lit(":")), "title_not_company_colon_role")
    error = (
        F.when(identity.isNull(), "nothing to tell it by: guid and link are missing")
        .when(title.isNull(), "the title is missing")
        .when(~F.contains(title, F.lit(":")), F.concat(F.lit("no colon parts a company from a role in '"), F.substring(title, 1, 120), F.lit("'")))
    )
    place = F.array_join(F.array_distinct(F.array_compact(F.array(_field("region"), _field("state"), _field("country")))), ", ")
    payload = {
        "source": F.lit(SOURCE),
        "external_id": identity,
        "url": F.coalesce(_field("link"), identity),
        "company": text.clean_text(text.before_colon(title)),
        "title": text.clean_text(text.after_colon(title)),
        "location": text.clean_text(F.substring(place, 1, 300)),
        "employment_type": _field("type"),
        "tags": F.array_compact(F.array(_field("category"), _field("skills"))),
        "description_text": text.html_to_text(_field("description")),
        "posted_at": _field("pubDate"),
    }
    struct = F.struct(*(payload.get(k, F.lit(None).cast("string")).alias(k) for k in ALLOWED)).cast(PAYLOAD)
    raw = F.to_json(F.struct(identity.alias("guid"), *(_field(f).alias(f) for f in RAW)), {"ignoreNullFields": "false"})
    return records(rows, SOURCE, identity, struct, error, code, raw)
