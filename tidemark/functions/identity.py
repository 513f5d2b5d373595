"""Identity hashes (F-07 to F-10). Parts are joined by a unit separator and null counts as ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import text

#: The fields whose change is a revision of a posting; tags come with them, sorted.
MUTABLE = ("company", "description_text", "employment_type", "location", "posted_at", "salary_currency", "salary_max", "salary_min", "title", "url")


def sha256_of(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def dedup_key(source: Column, external_id: Column) -> Column:
    """F-08: identity within a source."""
    return sha256_of(F.lit("v1"), F.lower(text.strip(source)), text.strip(external_id.cast("string")))


def fingerprint(company: Column, title: Column, location: Column) -> Column:
    """F-09: advisory identity across sources; it groups, it never discards."""
    return sha256_of(F.lit("v1"), text.normalize_company(company), text.normalize_title(title), text.normalize_location(location))


def content_hash(fields: dict[str, Column], tags: Column) -> Column:
    """F-10: of the mutable fields, by name, and the sorted tags; a null equals an empty field."""
    named = dict(fields) | {"tags": F.array_join(F.array_sort(tags), ",")}
    shown = []
    for name in sorted(named):
        value = F.date_format(named[name], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if name == "posted_at" else named[name].cast("string")
        shown.append(F.concat(F.lit(name + "="), F.coalesce(value, F.lit(""))))
    return sha256_of(F.lit("v1"), *shown)
