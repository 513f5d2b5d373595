"""Case tables for the functions."""

from __future__ import annotations

import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import headers, identity, requests, text


def each(spark, values, column, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def test_companies(spark):
    cases = {"Acme, Inc. (YC S21)": "acme", "ACME Inc": "acme", "The": "the", "The Widget Co": "widget", "Müller GmbH": "muller", None: "", "  ": "", "Inc": "inc", "A B.V.": "a b v"}
    assert each(spark, list(cases), text.normalize_company) == list(cases.values())


def test_titles(spark):
    cases = {"Senior Engineer (Remote)": "senior engineer", "Full-time Développeur, m/f/d": "developpeur", "NEW! Backend Dev": "backend dev", None: ""}
    assert each(spark, list(cases), text.normalize_title) == list(cases.values())


def test_locations(spark):
    cases = {"Anywhere in the World": "remote", "100% Remote": "remote", "Berlin, Germany": "berlin germany", "": ""}
    assert each(spark, list(cases), text.normalize_location) == list(cases.values())


def test_entities_are_decoded_twice(spark):
    assert each(spark, ["H&amp;amp;M", "a &lt;b&gt;", " x  y ", "&nbsp;", None], text.clean_text) == ["H&M", "a <b>", "x y", None, None]


def test_html(spark):
    assert each(spark, ["<p>Hi <b>you</b></p>", "", "<br>", "a" * 9000], text.html_to_text) == ["Hi you", None, None, "a" * 8000]


def test_identity(spark):
    a = lambda s, i: identity.dedup_key(F.lit(s), F.lit(i))
    same, other = spark.range(1).select((a(" RemoteOK", "1 ") == a("remoteok", "1")), (a("x", "1") == a("y", "1"))).first()
    assert same and not other


def test_content_hash_ignores_order_and_empty(spark):
    h = lambda loc, tags: identity.content_hash({f: F.lit(None).cast("timestamp") if f == "posted_at" else F.lit(loc) for f in identity.MUTABLE}, F.array(*map(F.lit, tags)))
    row = spark.range(1).select(h(None, ["a", "b"]) == h("", ["b", "a"]), h("x", ["a"]) == h("y", ["a"])).first()
    assert row[0] and not row[1]


HEADERS = [
    ("Acme | Backend Engineer | Berlin, Germany | Full-time", None, ("Acme", "Backend Engineer", "Berlin, Germany", "Full-time", None, None, None, None)),
    ("QUOBYTE | Berlin, Germany | ONSITE (Germany)", "SRE", ("QUOBYTE", "SRE", "Berlin, Germany, ONSITE (Germany)", None, None, None, None, None)),
    ("MONUMENTAL | https://www.monumental.co/ | Amsterdam | Robotics Engineer", None, ("MONUMENTAL", "Robotics Engineer", "Amsterdam", None, None, None, None, None)),
    ("Acme | Contract Counsel | Remote", None, ("Acme", "Contract Counsel", "Remote", None, None, None, None, None)),
    ("Acme | Remote Infrastructure Engineer | Berlin", None, ("Acme", "Remote Infrastructure Engineer", "Berlin", None, None, None, None, None)),
    ("Acme | Engineer | Remote | $80-120k", None, ("Acme", "Engineer", "Remote", None, 80000, 120000, "USD", None)),
    ("Acme | Engineer | Remote | $175k–$225k base", None, ("Acme", "Engineer", "Remote", None, 175000, 225000, "USD", None)),
    ("Acme | Engineer | Remote | £90k-£110k", None, ("Acme", "Engineer", "Remote", None, 90000, 110000, "GBP", None)),
    ("Acme | Engineer | Remote | $200k-$150k", None, ("Acme", "Engineer", "Remote", None, 150000, 200000, "USD", None)),
    ("Snout https://snout.com/ | Backend Engineer | Remote", None, ("Snout", "Backend Engineer", "Remote", None, None, None, None, None)),
    ("https://acme.com | Backend Engineer | Remote", None, ("https://acme.com", "Backend Engineer", "Remote", None, None, None, None, None)),
    ("Smarkets (https://www.smarkets.com) | Engineer", None, ("Smarkets", "Engineer", None, None, None, None, None, None)),
    ("We are hiring great people", None, (None, None, None, None, None, None, None, "header_not_pipe_delimited")),
    ("Acme | Berlin, Germany | Full-time", None, (None, None, None, None, None, None, None, "no_role_identified")),
]


def test_headers(spark):
    rows = spark.createDataFrame([(i, h, r) for i, (h, r, _) in enumerate(HEADERS)], "i int, h string, r string")
    fields = ("company", "title", "location", "employment_type", "salary_min", "salary_max", "salary_currency", "error_code")
    for got, (header, _, want) in zip(headers.parsed(rows, "p", F.col("h"), F.col("r")).orderBy("i").collect(), HEADERS, strict=True):
        if want[-1]:
            assert got.p["error_code"] == want[-1], header
        else:
            assert tuple(got.p[f] for f in fields) == want, header


def test_role_from_body(spark):
    lines = [["H", "Software Engineer: https://x.y/z"], ["H", "We are looking for an engineer"], ["H", "Great. Engineers wanted"], ["H", "- Site Reliability Engineer -"], ["Engineer"], []]
    assert each(spark, lines, headers.role_from_body, "array<string>") == ["Software Engineer", None, None, "Site Reliability Engineer", None, None]


def test_money_quirks(spark):
    got = each(spark, ["€4500", "$1,000,000", "none", "$100k to $120k"], headers.money)
    assert [tuple(g) for g in got] == [(450000, None, "EUR"), (None, None, None), (None, None, None), (100000, 120000, "USD")]


def test_labels(spark):
    rows = spark.createDataFrame([(120000, 170000, "USD"), (120000, None, "GBP"), (None, None, None)], "a int, b int, c string")
    assert [r[0] for r in rows.select(text.salary_label(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["$120k–$170k", "£120k+", "—"]
    assert each(spark, [0.5, 29.5, 30.5, 60.0], text.humanise_hours, "double") == ["30 min", "30 h", "30 h", "2 days"]


def test_retry_after():
    now = datetime(2026, 9, 4, tzinfo=UTC)
    assert requests.retry_after("12", now) == 12
    assert requests.retry_after("Fri, 04 Sep 2026 00:01:00 GMT", now) == 60
    assert requests.retry_after("Thu, 03 Sep 2026 00:00:00 GMT", now) == 0
    assert requests.retry_after("soon", now) is None and requests.retry_after(None, now) is None


@pytest.mark.parametrize("attempt", [1, 3, 10])
def test_backoff(attempt):
    draw = random.Random(attempt)
    assert all(0 <= requests.backoff(attempt, 0.5, 30, draw) <= min(30, 0.5 * 2 ** (attempt - 1)) for _ in range(200))


def test_env():
    assert requests.env_bool("YES", False) and not requests.env_bool("0", True) and requests.env_bool(None, True)
    assert requests.env_number("x", 5) == 5 and requests.env_number("2.5", 1.0, float) == 2.5
