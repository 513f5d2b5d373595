"""Validation of parsed records, and the split into postings and quarantine (P-02 to P-21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identity, text
from tidemark.functions.batches import small_batches
from tidemark.schema import ALLOWED, EPOCH, REQUIRED, SOURCES

# Names that say nothing (P-10).
PLACEHOLDERS = ("", "-", "--", "n/a", "na", "none", "null", "unknown", "tbd", "confidential", "?")
#: Least and most code points by field (P-07).
LENGTHS = {"external_id": (1, 200), "url": (8, 2000), "company": (1, 300), "title": (2, 400), "location": (0, 300), "employment_type": (0, 60), "salary_currency": (0, 8)}
MAX_SALARY = 10_000_000
MAX_TAGS = 40
EARLIEST = "2005-01-01 00:00:00"
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?( ?(Z|[+-]\d{2}(:?\d{2})?))?)?$"


def _value(name: str) -> Column:
    return F.col(f"payload.{name}")


def _stripped(name: str) -> Column:
    return F.col(f"v.{name}")


def shown(value: Column) -> Column:
    """A value as a reason shows it: quoted, at most 120 characters."""
    quoted = F.when(value.isNull(), "None").otherwise(F.concat(F.lit("'"), F.regexp_replace(value, "\n", r"\\\\n"), F.lit("'")))
    return F.when(F.length(quoted) > 120, F.concat(F.substring(quoted, 1, 117), F.lit("...'"))).otherwise(quoted)


def _error(field: str, message, kind: str, value: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), (message if isinstance(message, Column) else F.lit(message)).alias("message"), F.lit(kind).alias("type"), shown(value).alias("input"))


def _text_error(field: str, custom: Column | None = None) -> Column:
    """The first error of a text field: missing, null, too short, too long, then its own rule."""
    least, most = LENGTHS[field]
    v = _stripped(field)
    whole = F.to_json("payload")
    out = F.when(F.array_contains("missing_keys", field), _error(field, "Field required", "missing", whole)) if field in REQUIRED else F.when(F.lit(False), _error(field, "", "", v))
    if field in REQUIRED:
        out = out.when(v.isNull(), _error(field, "Input should be a valid string", "string_type", _value(field)))
    out = out.when(F.length(v) < least, _error(field, f"String should have at least {least} character{'s' * (least > 1)}", "string_too_short", v))
    out = out.when(F.length(v) > most, _error(field, f"String should have at most {most} characters", "string_too_long", v))
    return out.when(custom.isNotNull(), _error(field, custom, "value_error", v)) if custom is not None else out


def salary(c: Column) -> Column:
    """P-13: whole units; null, '', 0 are null; what isn't a number is null here, and an error in :func:`salary_error`."""
    n = F.when(text.strip(c).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), text.strip(c).try_cast("double"))
    return F.when(~c.isin("", "0"), n.cast("bigint"))


def salary_error(c: Column, n: Column) -> Column:
    """What is wrong with the given ``c``, read as ``n``."""
    given = c.isNotNull() & ~c.isin("", "0")
    return (
        F.when(given & n.isNull(), F.concat(F.lit("isn't numeric: "), shown(c)))
        .when(n < 0, F.concat(F.lit("below zero: "), n.cast("string")))
        .when(n > MAX_SALARY, F.concat(F.lit(f"over the limit of {MAX_SALARY}: "), n.cast("string")))
    )


def timestamp(c: Column) -> Column:
    """P-14: epoch seconds (numbers, marked by EPOCH; digits in a string are none), ISO 8601, then mail dates; no zone means UTC; null if it is none of them."""
    s = text.strip(c)
    iso = F.when(s.rlike(_ISO), F.regexp_replace(F.regexp_replace(s, ",", "."), r" (?=Z|[+-]\d)", "").try_cast("timestamp"))
    mail = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(s, r"^\w{3,9}, *", ""), r" (GMT|UTC|UT|Z)$", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z"))
    compact = F.when(s.rlike(r"^\d{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")))
    epoch = F.when(s.rlike(rf"^{EPOCH}-?\d+(\.\d+)?([eE][+-]?\d+)?$"), F.substring(s, 1 + len(EPOCH), 40).try_cast("double"))
    return F.coalesce(compact, F.when(epoch.between(-6.2e10, 2.5e11), F.timestamp_seconds(epoch)), iso, mail)


def timestamp_error(c: Column, t: Column, as_of: Column) -> Column:
    """What is wrong with the given ``c``, read as ``t``."""
    return (
        F.when(c.isNotNull() & (c != "") & t.isNull(), F.concat(F.lit("no known form of a time: "), shown(c)))
        .when(t > as_of + F.expr("INTERVAL 2 DAYS"), F.concat(F.lit("dated over two days ahead: "), t.cast("string")))
        .when(t < F.lit(EARLIEST).cast("timestamp"), F.concat(F.lit("dated before any posting there is: "), t.cast("string")))
    )


def tags(c: Column) -> Column:
    """P-12: stripped, non-empty, the first MAX_TAGS; a list in one string was split by its source (see :func:`tidemark.functions.text.tags_of_text`)."""
    return F.slice(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), text.strip), lambda t: t != ""), 1, MAX_TAGS)


def errors() -> Column:
    """Of rows with a payload and its values ``v``: array<struct<field, message, type, input>>: the first error of every field, then the rule across fields."""
    company, title, url = _stripped("company"), _stripped("title"), _stripped("url")
    allowed = ", ".join(f"'{s}'" for s in SOURCES[:-1]) + f" or '{SOURCES[-1]}'"
    source = (
        F.when(F.array_contains("missing_keys", "source"), _error("source", "Field required", "missing", F.to_json("payload")))
        .when(~F.coalesce(_stripped("source").isin(*SOURCES), F.lit(False)), _error("source", f"Input should be {allowed}", "literal_error", _value("source")))
    )
    placeholder = lambda v, what: F.when(F.lower(v).isin(*PLACEHOLDERS), F.concat(F.lit(f"the {what} "), shown(v), F.lit(" names nothing")))
    found = [
        source,
        _text_error("external_id"),
        _text_error("url", F.when(~F.lower(url).rlike("^https?://"), F.lit("isn't the address of a web page"))),
        _text_error("company", placeholder(company, "company name")),
        _text_error("title", F.coalesce(F.when(F.contains(title, F.lit("\n")), F.lit("holds a line break: more than a title was taken")), placeholder(title, "title"))),
        _text_error("location"),
        _text_error("employment_type"),
        *(F.when(F.col(f"v.{f}_error").isNotNull(), _error(f, F.col(f"v.{f}_error"), "value_error", _value(f))) for f in ("salary_min", "salary_max")),
        _text_error("salary_currency"),
        F.when(F.col("v.posted_at_error").isNotNull(), _error("posted_at", F.col("v.posted_at_error"), "value_error", _value("posted_at"))),
    ]
    extra = F.transform("extra_keys", lambda k: F.struct(k.alias("field"), F.lit("Extra inputs are not permitted").alias("message"), F.lit("extra_forbidden").alias("type"), F.lit("None").alias("input")))
    alone = F.concat(F.array_compact(F.array(*found)), extra)
    low, high = F.col("v.salary_min"), F.col("v.salary_max")
    order = F.when(low > high, F.array(_error("<root>", F.concat(F.lit("the range runs backwards, from "), low.cast("string"), F.lit(" to "), high.cast("string")), "value_error", F.to_json("payload"))))
    return F.when(F.col("payload").isNull(), F.array().cast(alone_type())).when(F.size(alone) > 0, alone).otherwise(F.coalesce(order, F.array().cast(alone_type())))


def alone_type() -> str:
    return "array<struct<field:string,message:string,type:string,input:string>>"


def reason_of(errors_: Column) -> Column:
    """P-18."""
    whole = F.array_join(F.transform(errors_, lambda e: F.concat(e["field"], F.lit(": "), e["message"], F.lit(" (got "), e["input"], F.lit(")"))), "; ")
    return F.when(F.length(whole) > 1000, F.concat(F.substring(whole, 1, 997), F.lit("..."))).otherwise(whole)


def reason_code(code: Column, errors_: Column, reason: Column) -> Column:
    """P-19: the parser's code; else field and type of the first error, or its first words; else the reason's own text."""
    first = F.try_element_at(errors_, F.lit(1))
    field = F.when(F.coalesce(first["field"], F.lit("")) == "", "?").otherwise(first["field"])
    words = F.array_join(F.slice(F.split(text.collapse(first["message"]), " "), 1, 5), "_")
    kind = F.when(F.coalesce(first["type"], F.lit("")) != "", first["type"]).otherwise(words)
    prose = F.trim(F.substring_index(F.coalesce(reason, F.lit("unknown")), "(got", 1))
    out = F.when(F.coalesce(code, F.lit("")) != "", code).when(first.isNotNull(), F.concat(field, F.lit(":"), kind)).otherwise(F.when(prose != "", prose).otherwise("unknown"))
    return F.substring(out, 1, 120)


TEXTS = ("source", "external_id", "url", "company", "title", "location", "employment_type", "salary_currency", "description_text")
TYPED = {"salary_min": salary, "salary_max": salary, "posted_at": timestamp, "tags": tags}


def judged(records: DataFrame, as_of: Column) -> DataFrame:
    """``records`` with their errors; nothing is dropped."""
    rows = text.once(records, "t", F.struct(*(text.strip(_value(f)).alias(f) for f in TEXTS), *(g(_value(f)).alias(f) for f, g in TYPED.items())))
    found = [salary_error(_value(f), F.col(f"t.{f}")).alias(f"{f}_error") for f in ("salary_min", "salary_max")]
    found.append(timestamp_error(_value("posted_at"), F.col("t.posted_at"), as_of).alias("posted_at_error"))
    rows = text.once(rows, "v", F.struct("t.*", *found)).drop("t")
    return text.once(rows, "errors", errors()).withColumn("valid", F.col("payload").isNotNull() & (F.size("errors") == 0))


def postings(rows: DataFrame) -> DataFrame:
    """The valid ones of :func:`judged`, typed, with their identity hashes."""
    good = rows.filter("valid")
    whole = {f: F.col(f"v.{f}").cast("int") if f.startswith("salary_m") else F.col(f"v.{f}") for f in ALLOWED}
    good = good.select("task_key", "pos", *(c.alias(f) for f, c in whole.items()))
    return with_identity(good)


def with_identity(rows: DataFrame) -> DataFrame:
    small_batches(rows.sparkSession)
    return (
        rows.withColumn("dedup_key", identity.dedup_key(F.col("source"), F.col("external_id")))
        .withColumn("content_fingerprint", identity.fingerprint(F.col("company"), F.col("title"), F.col("location")))
        .withColumn("content_hash", identity.content_hash({f: F.col(f) for f in identity.MUTABLE}, F.col("tags")))
    )


def quarantine(rows: DataFrame) -> DataFrame:
    """The others, with a readable reason and a code to group by (P-20)."""
    bad = rows.filter("NOT valid")
    reason = F.coalesce("parse_error", reason_of(F.col("errors")))
    code = F.when(F.col("payload").isNull(), F.coalesce("error_code", F.lit("parse_error")))
    return bad.select(
        "task_key", "source", "pos", "external_id", reason.alias("reason"), reason_code(code, F.col("errors"), reason).alias("reason_code"),
        F.greatest(F.size("errors"), F.lit(1)).alias("error_count"), "errors", "raw",
    )
