"""Operator 3: personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, ``://`` of a scheme, a plus before a digit, pairs of
digits, and words that announce an identifier, in any case. Small deterministic parsers then expand from the anchor to the
boundaries and validate what they found. The four base kinds equal the leftmost, non-overlapping matches of
their patterns; url, iban, account and secret are added where an anchor announces them.

Defined results: a null text counts as empty: no spans, the digest of an empty string. Repeated rows each keep
their row. An empty table gives an empty result. Kinds may overlap one another; spans of one kind never do.
Extra columns are ignored by :func:`find`, and passed through by :func:`redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "account", "secret")
KINDS = BASE + ADDED
RANK = {k: i for i, k in enumerate(KINDS)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL_REST = re.compile(r"[^\s<>\"'|]+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
IDENTIFIER = re.compile(r"[A-Za-z0-9]+(?:[-./][A-Za-z0-9]+)*")
SECRET = re.compile(r"[\"']?\s?[=:]\s?[\"']?([A-Za-z0-9_+/=-]{16,})")
GAP = re.compile(r"[\s:#=.]{0,4}(?:(?:no|nr|number|id|is)\b[\s:#=.]{0,3})?", re.IGNORECASE)
ACCOUNT_CUES = ("account", "acct", "customer id", "passport", "ssn", "social security", "tax id", "licence", "license no")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")


def anchors():
    """The automaton, for texts in ASCII lower case; its values are (kind of anchor, length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    found.add_word("://", ("scheme", 3))
    for a in DIGITS:
        found.add_word("+" + a, ("plus", 2))
        for b in DIGITS:
            found.add_word(a + "." + b, ("dot", 3))
            for joint in ("", " ", "-"):
                found.add_word(a + joint + b, ("digits", 2 + len(joint)))
    for kind, words in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES), ("iban", ("iban",))):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def find_spans(text: str, automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start, then kind in the order of KINDS."""
    out: list[tuple[int, int, str]] = []
    done = dict.fromkeys(KINDS, 0)
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes: ASCII letters only, offsets stay
    for last, (anchor, length) in automaton.iter(lowered):
        at = last - length + 1
        if anchor == "at":
            start, floor = at, done["email"]
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                out.append((start, m.end(), "email"))
                done["email"] = m.end()
        elif anchor == "dot":
            start, floor = at + 1, done["ip"]
            while start > floor and text[start - 1] in DIGITS:
                start -= 1
            if start < at + 1 and (m := QUAD.match(text, start)):
                done["ip"] = m.end()
                if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                    out.append((start, m.end(), "ip"))
        elif anchor == "digits":
            if at >= done["card"]:
                m = CHAIN.match(text, at)
                done["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((at, m.end(), "card"))
        elif anchor == "plus":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                done["phone"] = m.end()
                if 10 <= sum(c in DIGITS for c in m[0]) <= 15:
                    out.append((at, m.end(), "phone"))
        elif anchor == "scheme":
            start = at
            while start > done["url"] and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            m = URL_REST.match(text, at + 3)
            if start < at and m:
                done["url"] = m.end()
                if "@" in re.split(r"[/?#]", m[0], maxsplit=1)[0]:  # a login inside
                    out.append((start, m.end(), "url"))
        elif anchor == "secret":
            if at >= done["secret"] and (m := SECRET.match(text, last + 1)) and any(c in DIGITS for c in m[1]):
                out.append((m.start(1), m.end(1), "secret"))
                done["secret"] = m.end()
        else:
            start = GAP.match(text, last + 1).end()
            if anchor == "iban" and start >= done["iban"] and (m := IBAN.match(text, start)) and mod97(m[0]):
                out.append((start, m.end(), "iban"))
                done["iban"] = m.end()
            elif anchor == "account" and start >= done["account"] and (m := IDENTIFIER.match(text, start)) and len(m[0]) >= 6 and sum(c in DIGITS for c in m[0]) >= 4:
                out.append((start, m.end(), "account"))
                done["account"] = m.end()
    out.sort(key=lambda s: (s[0], RANK[s[2]]))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = anchors()
    for batch in batches:
        counts = {k: [] for k in BASE}
        digests, every = [], []
        for text in batch.column(1).to_pylist():
            spans = find_spans(text or "", automaton)
            base = [s for s in spans if RANK[s[2]] < len(BASE)]
            for k in BASE:
                counts[k].append(sum(s[2] == k for s in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            every.append(joined(spans))
        yield pa.record_batch([batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digests, pa.string()), pa.array(every, pa.string())], names=["key", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, counts of the base kinds, their digest, and all spans."""
    common.small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_find, f"key {kind}, {', '.join(f'n_{k} bigint' for k in BASE)}, base_sha256 string, spans string").withColumnRenamed("key", key)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each run of overlapping spans replaced by the label of its first."""
    out, at, until = [], 0, 0
    for start, end, kind in spans:
        if start >= until:
            out += [text[at:start] if at <= start else "", f"[{kind.upper()}]"]
            at = end
        at = until = max(until, end, at)
    out.append(text[at:])
    return "".join(out)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans of every text masked; all rows and columns stay, null texts stay null."""
    common.small_batches(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            masked = [None if t is None else mask(t, find_spans(t, automaton)) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place).name, pa.array(masked, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(common.table(spark, sf_dir, "documents"))
