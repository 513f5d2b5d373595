"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType

SOURCES = ("hackernews", "weworkremotely", "remoteok")
SOURCE_LABELS = {"hackernews": "Hacker News", "weworkremotely": "We Work Remotely", "remoteok": "Remote OK"}

_s, _i, _l, _t, _b = StringType(), IntegerType(), LongType(), TimestampType(), BooleanType()


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v, True) for k, v in fields.items()])


#: One fetched body: what a task got, or why it got nothing.
LANDING = _struct(task_key=_s, source=_s, url=_s, status=_i, body=_s, headers=MapType(_s, _s), meta=MapType(_s, _s), error=_s)

#: Marks a time that came as a number, seconds since 1970.
EPOCH = "@"

#: A posting as a parser proposes it; every value still as it came.
PAYLOAD = _struct(
    source=_s, external_id=_s, url=_s, company=_s, title=_s, location=_s, employment_type=_s, salary_min=_s, salary_max=_s,
    salary_currency=_s, tags=ArrayType(_s), description_text=_s, posted_at=_s,
)
ALLOWED = tuple(PAYLOAD.names)
REQUIRED = ("source", "external_id", "url", "company", "title")

#: A parsed record: exactly one of payload and parse_error is set.
RECORD = _struct(task_key=_s, source=_s, pos=_l, external_id=_s, payload=PAYLOAD, extra_keys=ArrayType(_s), missing_keys=ArrayType(_s), parse_error=_s, error_code=_s, raw=_s)

ERROR = _struct(field=_s, message=_s, type=_s, input=_s)

POSTING = _struct(
    source=_s, external_id=_s, url=_s, company=_s, title=_s, location=_s, employment_type=_s, salary_min=_i, salary_max=_i,
    salary_currency=_s, tags=ArrayType(_s), description_text=_s, posted_at=_t,
)

#: A valid posting as one task of one run saw it.
OBSERVATION = StructType([*_struct(run_id=_s, task_key=_s, pos=_l, seen_at=_t).fields, *POSTING.fields, *_struct(dedup_key=_s, content_fingerprint=_s, content_hash=_s).fields])

QUARANTINE = _struct(run_id=_s, source=_s, task_key=_s, pos=_l, external_id=_s, reason=_s, reason_code=_s, error_count=_i, errors=ArrayType(ERROR), raw=_s, created_at=_t)

SOURCE_STATE = _struct(url=_s, etag=_s, last_modified=_s, last_fetched_at=_t, last_status=_i, last_item_count=_l)

#: Events of the ledger: planned, claimed, done, requeued, failed; and of runs: started, finished.
LEDGER = _struct(
    run_id=_s, task_seq=_l, task_key=_s, source=_s, url=_s, event=_s, at=_t, http_status=_i, not_modified=_b, items_seen=_l,
    items_valid=_l, items_quarantined=_l, error=_s, detail=_s, params=MapType(_s, _s), meta=MapType(_s, _s), conditional=_b,
)

#: What the verdict needs to know of a task that ended.
OUTCOME = _struct(task_key=_s, source=_s, ok=_b, not_modified=_b, items_seen=_l, items_valid=_l, items_quarantined=_l, error=_s)
