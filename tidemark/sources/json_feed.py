"""S-05: a JSON array of postings, read as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.batches import small_batches
from tidemark.schema import ALLOWED, EPOCH, PAYLOAD
from tidemark.sources.landing import records

SOURCE = "remoteok"
PAGE = "https://remoteok.com/remote-jobs/"


def _get(path: str) -> Column:
    return F.try_variant_get("value", f"$.{path}", "string")


def _filled(path: str) -> Column:
    """The value as text unless it is null, an empty string, the number 0 or false."""
    v = _get(path)
    return F.when((v != "") & (_is(path, "STRING") | ~v.isin("0", "0.0", "false")), v)


def _is(path: str, kind: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("value", f"$.{path}", "variant")) == kind


def _time(path: str) -> Column:
    """A filled value, marked if it is a number."""
    return F.when(_is(path, "STRING"), _filled(path)).otherwise(F.concat(F.lit(EPOCH), _filled(path)))


def problems(landing: DataFrame) -> DataFrame:
    """task_key, error of the bodies whose shape isn't an array: the task fails as a whole."""
    v = F.try_parse_json("body")
    kind = F.schema_of_variant(v)
    error = F.when(v.isNull(), "the body isn't JSON").when(~F.startswith(kind, F.lit("ARRAY")), F.concat(F.lit("an array was expected, this is "), kind))
    return landing.filter(F.col("source") == SOURCE).select("task_key", error.alias("error")).filter("error IS NOT NULL")


def parse(landing: DataFrame) -> DataFrame:
    small_batches(landing.sparkSession)
    own = landing.filter((F.col("source") == SOURCE) & F.col("body").isNotNull()).withColumn("v", F.try_parse_json("body"))
    own = own.filter(F.startswith(F.schema_of_variant("v"), F.lit("ARRAY"))).select("task_key", "v")
    rows = own.lateralJoin(own.sparkSession.tvf.variant_explode(F.col("v").outer())).select("task_key", "pos", "value")
    kind = F.schema_of_variant("value")
    is_object = F.startswith(kind, F.lit("OBJECT"))
    # A key that is present holds a variant, maybe a JSON null; an absent one gives SQL NULL.
    absent = lambda k: F.try_variant_get("value", f"$.{k}", "variant").isNull()
    rows = rows.filter(~F.coalesce(is_object & absent("id") & ~absent("legal"), F.lit(False)))
    external = text.strip(F.coalesce(_filled("id"), F.lit("")))
    code = F.when(~is_object, "element_not_an_object").when(external == "", "no_stable_identity")
    error = F.when(~is_object, F.concat(F.lit("element is "), kind, F.lit(" where an object belongs"))).when(external == "", "nothing to tell it by: 'id' is missing")
    low, high = _get("salary_min"), _get("salary_max")
    slug = _filled("slug")
    payload = {
        "source": F.lit(SOURCE),
        "external_id": external,
        "url": F.coalesce(_filled("url"), _filled("apply_url"), F.concat(F.lit(PAGE), slug), F.lit("")),
        "company": F.coalesce(text.clean_text(_get("company")), F.lit("")),
        "title": F.coalesce(text.clean_text(_get("position")), F.lit("")),
        "location": text.clean_text(_get("location")),
        "employment_type": F.lit(None).cast("string"),
        "salary_min": low,
        "salary_max": high,
        "salary_currency": F.when(_filled("salary_min").isNotNull() | _filled("salary_max").isNotNull(), "USD"),
        "tags": F.coalesce(F.try_variant_get("value", "$.tags", "array<string>"), F.when(_is("tags", "STRING"), text.tags_of_text(_get("tags"))), F.array().cast("array<string>")),
        "description_text": text.html_to_text(_get("description")),
        "posted_at": F.coalesce(_time("date"), _time("epoch")),
    }
    raw = F.when(is_object, raw_without_description(F.col("value"))).otherwise(F.substring(F.to_json("value"), 1, 300))
    struct = F.struct(*(payload[k].alias(k) for k in ALLOWED)).cast(PAYLOAD)
    return records(rows, SOURCE, F.when(external != "", external), struct, error, code, raw)


def raw_without_description(value: Column) -> Column:
    """K-11: the object as JSON, its description cut to an excerpt."""
    entries = F.from_json(F.to_json(value), "map<string,string>")
    kept = F.map_filter(entries, lambda k, _: k != "description")
    short = F.when(F.element_at(entries, "description").isNotNull(), F.create_map(F.lit("description_excerpt"), F.substring(F.element_at(entries, "description"), 1, 300)))
    return F.to_json(F.map_concat(kept, F.coalesce(short, F.create_map().cast("map<string,string>"))))
