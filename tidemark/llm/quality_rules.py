"""Operator 6: quality rules of documents, and of the hosts they come from.

Rules are counted on the whole text of each document. Then failures are summed by host (the ``source`` column),
the failure rate of each host is shrunk by a beta prior fitted to all hosts, and the host's verdict is joined
back: a document is kept if it passes its own rules and its host isn't rejected.

Defined results: a null text has no words and fails. Documents of a null host form one host. Repeated rows count
as often as they occur and each keep their row. With no rows there is no host, and the result is empty. Extra
columns are ignored by :func:`judge`, and passed through by :func:`keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytescan, common

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A host whose shrunk failure rate is above this is rejected.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength, in documents.
PRIOR_STRENGTH = (2.0, 1e6)

IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def count_rules(data: np.ndarray) -> tuple[int, int, int, int, int]:
    """The counts of one text, in the order of COUNTS."""
    starts, ends = bytescan.word_bounds(data)
    n = len(starts)
    if not n:
        return 0, 0, int(IS_SYMBOL[data].sum()), 0, 0
    chars = int((bytescan.NOT_CONTINUATION[data] & ~bytescan.IS_SPACE[data]).sum())
    symbols = int(IS_SYMBOL[data].sum())

    breaks = np.flatnonzero(data == 10)
    dup_lines = 0
    if len(breaks):
        line_starts = np.concatenate(([0], breaks + 1))
        line_ends = np.concatenate((breaks, [len(data)]))
        worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
        lines = bytescan.span_hashes(data, line_starts[worded], line_ends[worded])
        dup_lines = len(lines) - len(np.unique(lines))

    repeat_words = 0
    if n > WINDOW:
        windows = bytescan.shingles(bytescan.span_hashes(data, starts, ends), WINDOW)
        again = repeated(windows)
        if again.any():
            change = np.zeros(n + 1, np.int64)
            change[: len(again)] += again
            change[WINDOW : WINDOW + len(again)] -= again
            repeat_words = int((np.cumsum(change[:-1]) > 0).sum())
    return n, chars, symbols, dup_lines, repeat_words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        rows = np.array([count_rules(x) for x in bytescan.texts(text)], np.int64).reshape(-1, len(COUNTS))
        names = batch.schema.names[:-1]
        yield pa.record_batch([*batch.columns[:-1], *(pa.array(rows[:, k]) for k in range(len(COUNTS)))], names=[*names, *COUNTS])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def counted(docs: DataFrame, carry: dict[str, Column], text: str = "text") -> DataFrame:
    """``carry`` (new names to columns) and the counts of each row's text."""
    common.small_batches(docs.sparkSession)
    picked = docs.select(*(c.alias(k) for k, c in carry.items()), F.col(text).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]
    return picked.mapInArrow(_count, ", ".join([*fields, *(f"{c} bigint" for c in COUNTS)])).withColumn("base_failed", base_failed())


def prior(hosts: DataFrame) -> tuple[float, float]:
    """Alpha and beta of the beta prior by moments: the mean rate, and the spread between hosts beyond chance."""
    h = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count("*").alias("hosts"), F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares")).first()
    if not h["n"]:
        return 1.0, 1.0
    mean = min(max(h["failed"] / h["n"], 1e-6), 1 - 1e-6)
    seen = h["squares"] / h["n"] - (h["failed"] / h["n"]) ** 2
    between = seen - mean * (1 - mean) * (h["hosts"] - 1) / h["n"]
    low, high = PRIOR_STRENGTH
    strength = min(max(mean * (1 - mean) / between - 1, low), high) if between > 0 else high
    return mean * strength, (1 - mean) * strength


def host_verdicts(rows: DataFrame) -> DataFrame:
    """host, n, failed, rate (shrunk), host_rejected of ``rows`` (host, base_failed); counts are pre-aggregated."""
    hosts = common.cut(rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("failed")), "hosts")
    alpha, beta = prior(hosts)
    rate = (F.col("failed") + alpha) / (F.col("n") + alpha + beta)
    return hosts.withColumn("host_rate", rate).withColumn("host_rejected", rate > MAX_HOST_RATE)


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per document: ``key``, the counts, base_failed, host_rate and kept."""
    rows = common.cut(counted(docs, {"key": F.col(key), "host": F.col(host).cast("string")}, text), "rules")
    verdicts = host_verdicts(rows).select(F.col("host").alias("of"), "host_rate", "host_rejected")
    out = rows.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left")
    return out.select(F.col("key").alias(key), *COUNTS, "base_failed", "host_rate", (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Each text is counted once, and written with its verdict."""
    carry = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    rows = common.cut(counted(docs, carry | {"host": F.col(host).cast("string")}, text).drop(*COUNTS), "judged")
    bad = host_verdicts(rows.select("host", "base_failed")).filter("host_rejected").select(F.col("host").alias("of"))
    rows = rows.filter(~F.col("base_failed")).join(bad, F.col("host").eqNullSafe(F.col("of")), "left_anti")
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents")).drop("host_rate")


ORACLE_SQL = rf"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS host, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, list_aggregate(list_slice(w, i, i + {WINDOW - 1}), 'string_agg', ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW})
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM twice CROSS JOIN range(0, {WINDOW}) AS r(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id
), counts AS (
    SELECT doc_id, host, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', '')) AS chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts
), hosts AS (
    SELECT host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS failed FROM judged GROUP BY host
), moments AS (
    SELECT greatest(least(sum(failed) / sum(n), 1 - 1e-6), 1e-6) AS mean, sum(failed * failed / n) / sum(n) - power(sum(failed) / sum(n), 2) AS seen, (count(*) - 1) / sum(n) AS chance FROM hosts
), between_hosts AS (
    SELECT mean, seen - mean * (1 - mean) * chance AS b FROM moments
), prior AS (
    SELECT mean, CASE WHEN b > 0 THEN least(greatest(mean * (1 - mean) / b - 1, {PRIOR_STRENGTH[0]}), {PRIOR_STRENGTH[1]}) ELSE {PRIOR_STRENGTH[1]} END AS strength FROM between_hosts
), verdicts AS (
    SELECT host, (failed + mean * strength) / (n + strength) > {MAX_HOST_RATE} AS rejected FROM hosts CROSS JOIN prior
)
SELECT doc_id, n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM judged JOIN verdicts USING (host)
"""
