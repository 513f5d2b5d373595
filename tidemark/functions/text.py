"""Text functions: columns in, columns out (F-01 to F-06, F-11 to F-13, F-22, F-29, F-32)."""

from __future__ import annotations

import html
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MAX_DESCRIPTION = 8000

# Legal endings of company names (single tokens after normalising).
COMPANY_SUFFIXES = "inc llc ltd limited corp corporation company co gmbh bv nv plc ag sa srl oy ab as pty pte kk kft the".split()
# Words of titles that say how or where, not what.
TITLE_NOISE = (
    r"remote|fully[\s-]?remote|hybrid|onsite|on[\s-]?site|full[\s-]?time|part[\s-]?time|contract|permanent|freelance"
    r"|w2|c2c|visa|relocation|urgent|hiring|new|us|usa|uk|emea|anywhere|worldwide|m/f/d|m/w/d|h/f|f/m/d|all genders"
)
# Spellings of a location that mean "remote".
REMOTE_ALIASES = ("anywhere", "anywhere in the world", "worldwide", "world wide", "global", "remote", "fully remote", "remote worldwide", "remote anywhere", "100 remote", "probably anywhere")

# Fixed value: an aside in brackets.
BRACKETED = r"[\(\[\{][^)\]\}]*[\)\]\}]"


@F.pandas_udf(StringType())
def strip_accents(values: pd.Series) -> pd.Series:
    """F-01: compatibility decomposition without combining marks; null stays null."""

    def strip(v: str | None) -> str | None:
        if v is None or v.isascii():
            return v
        return "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))

    return values.map(strip)


def strip(c: Column) -> Column:
    """Without white space of any kind at either end, as Unicode sees it."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """F-02."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_text(c: Column) -> Column:
    """F-03: lower case, no accents, ASCII letters and digits with single spaces; null gives ''."""
    given = F.coalesce(c.cast("string"), F.lit(""))
    # Only values with other than ASCII characters go to Python: the others leave it at once, as nulls.
    odd = given.rlike(r"[^\x00-\x7F]")
    plain = F.lower(F.when(odd, strip_accents(F.when(odd, given))).otherwise(given))
    return F.trim(F.regexp_replace(plain, r"[^a-z0-9]+", " "))


def without_brackets(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), BRACKETED, " ")


def peel_company(normal: Column) -> Column:
    """Without legal endings, then without leading articles; one token always stays."""
    ends = F.regexp_replace(normal, f"( ({'|'.join(COMPANY_SUFFIXES)}))+$", "")
    return F.regexp_replace(ends, "^(the )+(?=.)", "")


def normalize_company(c: Column) -> Column:
    """F-04."""
    return peel_company(normalize_text(without_brackets(c)))


def normalize_title(c: Column) -> Column:
    """F-05: noise goes before accents do."""
    return normalize_text(F.regexp_replace(without_brackets(c), rf"(?i)\b({TITLE_NOISE})\b", " "))


def fold_location(normal: Column) -> Column:
    return F.when(normal.isin(*REMOTE_ALIASES), "remote").otherwise(normal)


def normalize_location(c: Column) -> Column:
    """F-06."""
    return fold_location(normalize_text(c))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def flatten_html(value: str | None, limit: int = MAX_DESCRIPTION) -> str | None:
    """Readable text of a fragment; None if there is none."""
    if not value:
        return None
    parser = _Text()
    parser.feed(value)
    parser.close()
    text = " ".join(" ".join(parser.parts).split())
    return text[:limit] or None


@F.pandas_udf(StringType())
def html_to_text(values: pd.Series) -> pd.Series:
    """F-11."""
    return values.map(flatten_html, na_action="ignore")


def decode_twice(value: str) -> str | None:
    return " ".join(html.unescape(html.unescape(value)).split()) or None


@F.pandas_udf(StringType())
def clean_text(values: pd.Series) -> pd.Series:
    """F-12: feeds encode entities twice; white space collapses; '' becomes null."""
    return values.map(decode_twice, na_action="ignore")


def before_colon(c: Column) -> Column:
    """F-13: the company of ``Company: Role``."""
    return F.substring_index(c, ":", 1)


def after_colon(c: Column) -> Column:
    """F-13: the role, which may hold colons of its own."""
    return F.regexp_replace(c, r"(?s)^[^:]*:", "")


def salary_label(low: Column, high: Column, currency: Column) -> Column:
    """F-29: ``$120k–$170k``, ``$120k+`` or a dash."""
    sign = F.when(currency == "USD", "$").when(currency == "GBP", "£").when(currency == "EUR", "€").otherwise("")
    thousands = lambda c: F.concat(sign, F.floor(c / 1000).cast("string"), F.lit("k"))
    return F.when((low > 0) & (high > 0), F.concat(thousands(low), F.lit("–"), thousands(high))).when(low > 0, F.concat(thousands(low), F.lit("+"))).otherwise("—")


def redact_login(url: Column) -> Column:
    """F-32: credentials of a URL masked."""
    return F.regexp_replace(url, r"(?<=://)[^/@\s]+@", "***@")


def excerpt(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def humanise_hours(hours: Column) -> Column:
    """F-28: minutes, hours or days; halves round to even."""
    return (
        F.when(hours < 1, F.concat(F.floor(hours * 60).cast("string"), F.lit(" min")))
        .when(hours < 48, F.concat(F.bround(hours, 0).cast("bigint").cast("string"), F.lit(" h")))
        .otherwise(F.concat(F.bround(hours / 24, 0).cast("bigint").cast("string"), F.lit(" days")))
    )


def ago(seconds: Column) -> Column:
    """F-30: an age in the largest unit that is short to read; null is never."""
    whole = lambda n: F.floor(seconds / n).cast("string")
    return F.when(seconds.isNull(), "never").when(seconds < 90, F.concat(whole(1), F.lit("s ago"))).when(seconds < 5400, F.concat(whole(60), F.lit("m ago"))).when(seconds < 172800, F.concat(whole(3600), F.lit("h ago"))).otherwise(F.concat(whole(86400), F.lit("d ago")))


def thousands(n: Column) -> Column:
    """F-30: a whole number with commas; a dash if there is none."""
    return F.coalesce(F.format_number(n, 0), F.lit("—"))


def like_pattern(search: str) -> str:
    """P-04: the pattern of a substring search; % and _ stay wildcards, a backslash is literal."""
    return "%" + search.lower().replace("\\", "\\\\") + "%"




def tags_of_text(c: Column) -> Column:
    """P-12 for a list in one string."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda t: t != "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once for each row, however often it is used later.

    The optimizer copies an expression to where its column is used, and filters move below it with such copies;
    nested ones multiply. A generator of one row is where that ends.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
