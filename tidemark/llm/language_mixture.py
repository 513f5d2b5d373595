"""Operator 7: language identification by multilingual mixture inference.

Training counts byte trigrams by language over all labelled training documents. A document is then a mixture:
each word comes from one of the languages, with the likelihood of its trigrams, and expectation-maximisation
finds the proportions. The set of languages is grown, most present first, as long as the likelihood gains more
than a penalty for one more language; the language of the largest proportion is the prediction.

Defined results: null texts and texts without letters get ``und`` and score 0; so does everything if there is
nothing to learn from. Documents with a null language aren't learnt from. Repeated rows count as often as they
occur and each keep their row. Ties go to the language first in order. Long texts are scored in pieces, and all
of their words count. More than MAX_LANGUAGES languages to learn are an error. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytescan, common

BUCKETS = 1 << 16
ROUNDS = 12
#: Languages that are learnt at most: their counts are what the driver and every worker hold, BUCKETS of them each.
MAX_LANGUAGES = 128
#: Log-likelihood that one more language must gain, by the logarithm of the number of words.
PENALTY = 2.0
#: The prior weight of the uniform distribution in a language's trigrams.
SMOOTHING = 0.05
PIECE_WORDS = 1 << 16
UNKNOWN = "und"


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 4 == 2


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def trigrams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of the words (a space before and after each), and where each word's begin.

    ``starts`` and ``ends`` are those of consecutive words of ``data``. A word of n bytes has n trigrams.
    """
    size = ends - starts
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.repeat(starts - first, size) + np.arange(int(size.sum()))
    low = _LOWER[data]
    low = np.concatenate((low, [np.uint32(32)]))
    here = low[at]
    before = low[at - 1]
    before[first] = 32
    after = low[at + 1]
    after[first + size - 1] = 32
    code = before | here << np.uint32(8) | after << np.uint32(16)
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16), first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, data in zip(batch.column(0).to_pylist(), bytescan.texts(batch.column(1)), strict=True):
            own = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            starts, ends = bytescan.word_bounds(data)
            for at in range(0, len(starts), PIECE_WORDS):
                own += np.bincount(trigrams(data, starts[at : at + PIECE_WORDS], ends[at : at + PIECE_WORDS])[0], minlength=BUCKETS)
    for lang, own in totals.items():
        seen = np.flatnonzero(own)
        yield pa.record_batch([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(own[seen])], names=["lang", "bucket", "n"])


class Model:
    """Languages in order, and the log-likelihood of each bucket in each (buckets by languages)."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """From all rows with a language. What comes to the driver is at most BUCKETS counts a language."""
    common.small_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    if (found := rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} values of {lang!r}: {found} or more; a model of them all has no bound")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return None
    names = np.array(counts.column("lang").to_pylist())
    languages = sorted(set(names.tolist()))
    table = np.zeros((BUCKETS, len(languages)))
    table[counts.column("bucket").to_numpy(), np.searchsorted(languages, names)] = counts.column("n").to_numpy()
    # Interpolated with what all languages together have, and that with the uniform distribution.
    total = table.sum(axis=0)
    every = table.sum(axis=1, keepdims=True)
    general = (1 - SMOOTHING) * every / every.sum() + SMOOTHING / BUCKETS
    share = (1 - SMOOTHING) * table / np.maximum(total, 1) + SMOOTHING * general
    return Model(languages, np.log(share).astype(np.float32))


def mixture(likelihood: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and their log-likelihood; rows are words, columns languages."""
    top = likelihood.max(axis=1, keepdims=True)
    p = np.exp(likelihood - top)
    n, k = p.shape
    share = np.full(k, 1 / k)
    if k > 1:
        for _ in range(rounds):
            both = p * share
            both /= both.sum(axis=1, keepdims=True)
            share = both.sum(axis=0) / n
    return share, float(np.log(np.maximum(p @ share, 1e-300)).sum() + top.sum())


def choose(likelihood: np.ndarray) -> tuple[int, float]:
    """The language of the largest proportion, and that proportion, in the set that the penalty selects."""
    n, k = likelihood.shape
    if k == 1:
        return 0, 1.0
    share, _ = mixture(likelihood, 4)
    order = np.argsort(-share, kind="stable")
    best = max(range(k), key=lambda j: (likelihood[:, j].sum(), -j))
    order = np.concatenate(([best], order[order != best]))
    chosen, weights, value = order[:1], np.ones(1), float(likelihood[:, best].sum())
    for size in range(2, k + 1):
        share, reached = mixture(likelihood[:, order[:size]])
        if reached - value <= PENALTY * np.log(n + 1):
            break
        chosen, weights, value = order[:size], share, reached
    at = max(range(len(chosen)), key=lambda j: (weights[j], -int(chosen[j])))
    return int(chosen[at]), float(weights[at])


def word_likelihoods(model: Model, data: np.ndarray) -> np.ndarray:
    starts, ends = bytescan.word_bounds(data)
    out = [np.zeros((0, len(model.languages)), np.float32)]
    for at in range(0, len(starts), PIECE_WORDS):
        bucket, first = trigrams(data, starts[at : at + PIECE_WORDS], ends[at : at + PIECE_WORDS])
        out.append(np.add.reduceat(model.weights[bucket], first, axis=0))
    return np.concatenate(out)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, lang_pred, score of each row of ``docs``; other inputs than the text are never looked at."""
    spark = docs.sparkSession
    common.small_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("text"))
    if model is None:
        return rows.select(F.col("key").alias(key), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((model.languages, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            langs, scores = [], []
            for known, data in zip(batch.column(1).is_valid().to_pylist(), bytescan.texts(batch.column(1)), strict=True):
                words = word_likelihoods(own, data) if known else None
                if words is None or not len(words):
                    langs.append(UNKNOWN), scores.append(0.0)
                else:
                    at, share = choose(words)
                    langs.append(own.languages[at]), scores.append(min(1.0, max(0.0, share)))
            yield pa.record_batch([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["key", "lang_pred", "score"])

    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
