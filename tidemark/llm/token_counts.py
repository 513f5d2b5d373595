"""Operator 1: token counts by a digest cache.

Every text is reduced to the digest of its normalised content (null becomes empty; any other change of a text would
change its tokens). Counts already stored for that digest and this
version of the tokenizer are joined; only distinct texts that are missing are encoded, once each, and their
counts are appended to the cache, a Parquet table. Of the cache only the digests at hand are read into the join, so a run's
work doesn't grow with what runs before it stored, but for one scan of digests.

Defined results: a null text counts as an empty one (0 bytes, 0 tokens). Repeated rows each keep a row of their
own, with the same count. An empty table gives an empty result. Columns other than the key and the text are not
read, so clashing names do no harm. Texts of any length are encoded whole: for byte-level tokenizers long ones are cut, for memory, only
before a single space between two non-spaces, where the tokenizer's own pattern always ends a piece.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

PIECE = 1 << 16
OVER_LIMIT = 1024


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file; another file never shares counts with this one."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def split_long(text: str, piece: int = PIECE) -> list[str]:
    """``text`` in parts of about ``piece`` characters whose token counts add up to that of the whole."""
    out, at = [], 0
    while len(text) - at > piece:
        cut = at + piece
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = -1
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        if cut < 0:
            break
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


def _encoder(load, split):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load()
        for batch in batches:
            parts, owner = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = split(text)
                parts += own
                owner += [i] * len(own)
            totals = [0] * batch.num_rows
            for at in range(0, len(parts), 64):
                for i, n in zip(owner[at : at + 64], count(parts[at : at + 64]), strict=True):
                    totals[i] += n
            yield pa.record_batch([batch.column(0), pa.array(totals, pa.int64())], names=["digest", "n_tokens"])

    return encode


#: Pieces that a byte-level tokenizer never merges across: its own pattern ends at each of their ends.
PIECES = re.compile(r"\s+(?!\S)| ?\S+|\s")
#: Counted as white space here, but not by the tokenizers.
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Known pieces and words of a worker, and their longest; beyond the first number it starts afresh.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 64


class Remembered(dict):
    """Counts by string; what is missing is counted, and kept while there is room."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, key: str) -> int:
        if len(key) > REMEMBERED_LENGTH:
            return self.count(key)
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[key] = self.count(key)
        return n


def by_pieces(path: str) -> bool:
    """Whether texts may be cut at the ends of PIECES: for byte-level tokenizers that change nothing before they split."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    pre = config.get("pre_tokenizer") or {}
    special = [t["content"] for t in config.get("added_tokens") or []]
    return not config.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and all(s.split() == [s] for s in special)


def json_tokenizer(path: str):
    """Counts by the ``tokenizers`` library: nothing added, special strings handled as it does by default.

    Byte-level ones count a text piece by piece, each distinct piece by the library's own steps, once. Texts with a
    special string or an odd separator, and those of other tokenizers, are encoded as they are.
    """

    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        whole = lambda parts: [len(x) for x in model.encode_batch_fast(parts, add_special_tokens=False)]
        if not by_pieces(path):
            return whole
        special = [t.content for t in model.get_added_tokens_decoder().values()]
        cut, encode = model.pre_tokenizer.pre_tokenize_str, model.model.tokenize
        words = Remembered(lambda word: len(encode(word)))
        pieces = Remembered(lambda piece: sum(words[w] for w, _ in cut(piece)))

        def count(parts: list[str]) -> list[int]:
            return [whole([p])[0] if SEPARATORS.search(p) or any(s in p for s in special) else sum(map(pieces.__getitem__, PIECES.findall(p))) for p in parts]

        return count

    return load


def model_tokenizer(path: str):
    """Counts by the ``sentencepiece`` library."""

    def load():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda parts: [len(x) for x in model.encode(parts, num_threads=1)]

    return load


def token_counts(docs: DataFrame, vocabulary: str, cache: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, n_bytes, n_tokens. ``cache`` is the folder of stored counts."""
    spark = docs.sparkSession
    common.small_batches(spark)
    version = tokenizer_version(vocabulary)
    load = json_tokenizer(vocabulary) if vocabulary.endswith(".json") else model_tokenizer(vocabulary)
    neutral = vocabulary.endswith(".json") and by_pieces(vocabulary)
    split = split_long if neutral else lambda text: [text]
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(key).alias("key"), F.xxhash64(key).alias("slot"), content.alias("content"), F.unhex(F.sha2(content, 256)).alias("digest"))

    first = keyed.groupBy("digest").agg(F.min("slot").alias("slot"))
    cached = stored(spark, cache, version)
    known = None
    if cached is not None:
        # A job that was run twice may have appended twice.
        known = common.cut(cached.join(first.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "known")
        first = first.join(known.select("digest"), "digest", "left_anti")
    # One row of each missing digest is encoded; its slot goes into the hash table, the texts stream past.
    # A key may come with several texts, so the digest is part of the join; rows of one key may share a text, too.
    misses = keyed.select("digest", "content", "slot").join(first.hint("shuffle_hash"), ["slot", "digest"], "left_semi")
    misses = misses.select("digest", "content").mapInArrow(_encoder(load, split), "digest binary, n_tokens bigint")
    # Written on its own, and joined from there: Spark can then split the partitions of a text that very many rows share.
    fresh = common.cut(misses, "counts")
    common.write(fresh.withColumn("version", F.lit(version)), cache, "append")
    fresh = fresh.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts = common.cut(fresh if known is None else known.unionAll(fresh), "counts")
    rows = keyed.select("key", "digest", F.octet_length("content").cast("bigint").alias("n_bytes"))
    return rows.join(counts, "digest", "left").select(F.col("key").alias(key), "n_bytes", "n_tokens")


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Counts of this version; None if nothing was ever stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema("digest binary, n_tokens bigint, version string").parquet(cache)
    return rows.filter(F.col("version") == version)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), common.fresh_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)
