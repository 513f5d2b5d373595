"""Small functions at the edge of the system (F-27, F-31, F-33, F-36, S-08)."""

from __future__ import annotations

import random
import re
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Answers worth another attempt.
RETRYABLE = frozenset({408, 425, 429, 500, 502, 503, 504})
TRUE_WORDS = frozenset({"1", "true", "yes", "on"})


def canonical_url(url: Column, params: Column) -> Column:
    """F-27: the URL with its parameters (a map) in order of their names; as it is without any."""
    pairs = F.transform(F.array_sort(F.map_entries(params)), lambda p: F.concat(F.url_encode(p["key"]), F.lit("="), F.url_encode(p["value"])))
    return F.when(F.coalesce(F.size(params), F.lit(0)) <= 0, url).otherwise(F.concat(url, F.lit("?"), F.array_join(pairs, "&")))


def backoff(attempt: int, base: float, cap: float, draw: random.Random) -> float:
    """S-08: full jitter."""
    return draw.uniform(0, min(cap, base * 2 ** (attempt - 1)))


def retry_after(value: str | None, now: datetime) -> float | None:
    """F-31: seconds to wait, from seconds or an HTTP date; never below 0; None if it is neither."""
    if value is None:
        return None
    if re.fullmatch(r"\s*\d+(\.\d+)?\s*", value):
        return float(value)
    try:
        when = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    when = when if when.tzinfo else when.replace(tzinfo=UTC)
    return max(0.0, (when - now).total_seconds())


def env_bool(value: str | None, default: bool) -> bool:
    return default if value is None or not value.strip() else value.strip().lower() in TRUE_WORDS


def env_number(value: str | None, default, kind=int):
    """A bad number is the default, not a crash."""
    try:
        return kind(value) if value is not None and value.strip() else default
    except ValueError:
        return default
