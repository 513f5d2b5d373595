"""Operator 4: benchmark decontamination by the CGK embedding and bit-sampling LSH.

Texts and items are read as words: runs of letters, digits and bytes beyond ASCII, lower-cased; in scripts that put no
spaces between words (Chinese, Japanese, Thai, Lao, Burmese, Khmer), each character is one. A passage of a
document leaks an item of L words if its edit distance to the item, in words, is at most a fifth of L, so items of three and
four words must be there unchanged. Windows
of the item's size are embedded by the CGK random walk, which turns a few edits into a small Hamming distance;
each of several tables samples a few steps of one walk, of those on which it is still inside the window, and a window
that falls into an item's bucket in any
table is a candidate. The number of tables is raised until simulated edits at the limit are found with the
target recall; if no number reaches it, that is an error. Candidates are verified by the exact edit distance.

Where windows begin: an edit spoils at most q of an item's L - q + 1 runs of q words, so a passage within k edits
shares at least L - q + 1 - k q of them with its item, on diagonals at most 2 k apart. Windows are laid out from
such clusters only, which loses nothing (a test compares with windows at every word); what becomes a candidate is up to the walk.
Items are read in blocks of bounded size, and each block
is sent to the workers in full, so the documents are scanned once a block and never shuffled.

Defined results: null texts and items, and items of one or two words, which clean texts hold by chance, match nothing. Repeated rows of
documents give repeated hits, one for each row; repeated items one for each item_id. Empty tables give empty
results. Extra columns are ignored by :func:`leaks` and passed through by :func:`clean`.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytescan, common

EDIT_SHARE = 5  # one edit for every so many words of the item
MIN_WORDS = 3
RUN = 3
#: Steps that may be sampled for each word of a window. The walk takes two for a word, so it is about four fifths through by then.
INSIDE = 1.6
SAMPLED = 3
TARGET_RECALL = 0.99
MAX_TABLES = 1024
BLOCK_BYTES = 16 << 20

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _alone(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the characters that are words of their own: those of scripts without spaces."""
    after = np.concatenate((data[1:], np.zeros(1, np.uint8)))
    thai, burmese_khmer = (data == 0xE0) & (after >= 0xB8) & (after <= 0xBB), (data == 0xE1) & ((after >= 0x80) & (after <= 0x82) | (after == 0x9E) | (after == 0x9F))
    han = (data == 0xE3) & (after >= 0x81) | (data >= 0xE4) & (data <= 0xE9) | (data == 0xEF) & (after >= 0xA4) & (after <= 0xAB) | (data == 0xF0) & (after >= 0xA0) & (after <= 0xB3)
    at = np.flatnonzero(thai | burmese_khmer | han)
    return at, np.where(data[at] == 0xF0, 4, 3)


def words_of(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64)
    word = ~_NOT_WORD[data]
    begins = np.zeros(n + 1, bool)
    begins[1:n] = word[1:] != word[:-1]
    if (data >= 0xE0).any():
        at, size = _alone(data)
        begins[at] = True
        begins[np.minimum(at + size, n)] = True
        mark = np.flatnonzero((data[:-2] == 0xE3) & (data[1:-1] == 0x80))  # space and punctuation, U+3000 to U+303F
        word[mark] = word[mark + 1] = word[mark + 2] = False
        begins[1:n] |= word[1:] != word[:-1]
    begins[0] = begins[n] = True
    edge = np.flatnonzero(begins)
    starts, ends = edge[:-1], edge[1:]
    own = word[starts]
    return bytescan.span_hashes(data, starts[own], ends[own], bytescan.BYTE_VALUE_LOWER)


def limit(n_words: int) -> int:
    return n_words // EDIT_SHARE


def run_length(n_words: int) -> int:
    """The longest run of words, up to RUN, of which every passage within the limit shares one with the item."""
    return max(1, min(RUN, n_words // (limit(n_words) + 1)))


def walk(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seeds: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Bucket keys, windows by tables, of windows of ``words``.

    ``picks`` (tables by samples) are fractions of the steps INSIDE, so that each size of window has its own sampled
    steps. At each step the walk writes the word under it, and moves on if a random bit of (table, step, word)
    is one; beyond the window it writes nothing more.
    """
    n, tables = len(starts), len(seeds)
    keys = np.zeros((n, tables), np.uint64)
    if not n:
        return keys
    padded = np.concatenate((words, np.zeros(1, np.uint64)))
    at = np.zeros((n, tables), np.int64)
    sizes, starts = sizes[:, None], starts[:, None]
    wanted = (picks[None, :, :] * (sizes * INSIDE)[:, :, None]).astype(np.int64)
    last = np.minimum(starts + sizes, len(words))
    for step in range(int(wanted.max()) + 1):
        place = starts + at
        symbol = np.where(place < last, padded[np.minimum(place, len(words))], np.uint64(0))
        bits = bytescan.mix(symbol ^ (seeds + np.uint64(step * 0x632BE59BD9B4E019 % (1 << 64))))
        sampled = (wanted == step).sum(axis=2).astype(np.uint64)
        if sampled.any():
            keys += sampled * bytescan.mix(symbol + np.uint64(2 * step + 1))
        at += (bits & np.uint64(1)).astype(np.int64)
    return bytescan.mix(keys ^ seeds[None, :]) + sizes.astype(np.uint64)


class Items:
    """One block of items, ready for look-ups."""

    def __init__(self, ids: list[int], texts: list[bytes], tables: int):
        pairs = [(i, w) for i, t in zip(ids, texts, strict=True) if len(w := words_of(np.frombuffer(t, np.uint8))) >= MIN_WORDS]
        self.ids = [i for i, _ in pairs]
        self.words = [w for _, w in pairs]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.tables = tables
        self.limits = self.sizes // EDIT_SHARE
        self.run_length = np.array([run_length(n) for n in self.sizes.tolist()], np.int64)
        self.needed = np.maximum(self.sizes - self.run_length + 1 - self.limits * self.run_length, 1)
        draw = np.random.Generator(np.random.PCG64(4099))
        self.seeds = draw.integers(0, 1 << 63, MAX_TABLES, np.uint64)[:tables]
        self.picks = draw.random((MAX_TABLES, SAMPLED))[:tables]
        runs, of, offset = [], [], []
        for k, w in enumerate(self.words):
            q = run_length(len(w))
            own = bytescan.shingles(w, q)
            runs.append(own)
            of.append(np.full(len(own), k))
            offset.append(np.arange(len(own)))
        self.lengths = sorted({run_length(len(w)) for w in self.words})
        runs = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
        order = np.argsort(runs, kind="stable")
        self.runs = runs[order]
        self.run_item = np.concatenate(of)[order] if of else np.zeros(0, np.int64)
        self.run_offset = np.concatenate(offset)[order] if offset else np.zeros(0, np.int64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self.runs & np.uint64((1 << 20) - 1)] = True
        if pairs:
            self.keys = np.concatenate([walk(w, np.zeros(1, np.int64), self.sizes[k : k + 1], self.seeds, self.picks) for k, w in enumerate(self.words)])
            flat = self.keys.ravel()
            order = np.argsort(flat, kind="stable")
            self.buckets = flat[order]
            self.bucket_item = order // tables
        else:
            self.buckets, self.bucket_item = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.masks = [bit_masks(w) for w in self.words]

    def windows(self, words: np.ndarray) -> np.ndarray:
        """Starts and sizes (two rows) of the windows that may hold an item."""
        found = []
        for q in self.lengths:
            if len(words) < q:
                continue
            own = bytescan.shingles(words, q)
            at = np.flatnonzero(self.filter[own & np.uint64((1 << 20) - 1)])
            if not len(at):
                continue
            lo, hi = np.searchsorted(self.runs, own[at], "left"), np.searchsorted(self.runs, own[at], "right")
            many = hi - lo
            if not many.any():
                continue
            run = np.repeat(lo - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            item = self.run_item[run]
            right = self.run_length[item] == q
            found.append((item[right], (np.repeat(at, many) - self.run_offset[run])[right]))
        none = np.zeros((2, 0), np.int64)
        if not found:
            return none
        # Key: item, then diagonal. Runs of one passage lie on diagonals at most twice the limit apart.
        spread = np.int64(len(words) + 2 * int(self.sizes.max()))
        item, diagonal = (np.concatenate(x) for x in zip(*found, strict=True))
        keys = np.sort(item * 3 * spread + diagonal + spread)
        item, diagonal = keys // (3 * spread), keys % (3 * spread) - spread
        near = 2 * self.limits[item]
        enough = np.searchsorted(keys, keys + near, "right") - np.searchsorted(keys, keys - near, "left") >= self.needed[item]
        if not enough.any():
            return none
        return np.unique(np.stack((np.maximum(diagonal[enough], 0), self.sizes[item[enough]])), axis=1)

    def candidates(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, start of window) of the windows that share a bucket with an item of their size."""
        windows = self.windows(words)
        out = set()
        for base in range(0, windows.shape[1], 2048):
            start, size = windows[:, base : base + 2048]
            keys = walk(words, start, size, self.seeds, self.picks)
            lo, hi = np.searchsorted(self.buckets, keys, "left"), np.searchsorted(self.buckets, keys, "right")
            for row, table in zip(*np.nonzero(hi > lo), strict=True):
                for slot in range(lo[row, table], hi[row, table]):
                    item = int(self.bucket_item[slot])
                    if self.sizes[item] == size[row]:
                        out.add((item, int(start[row])))
        return sorted(out)

    def hits(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first word of its closest window, edits) of the items that leak into a text."""
        best: dict[int, tuple[int, int]] = {}
        for item, start in self.candidates(words):
            n = len(self.words[item])
            most = limit(n)
            lo = max(0, start - most)
            edits = edit_distance(self.masks[item], n, words[lo : start + n + most].tolist())
            if edits <= most and (item not in best or (edits, start) < best[item]):
                best[item] = (edits, start)
        return [(k, start, edits) for k, (edits, start) in sorted(best.items())]


def bit_masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def edit_distance(masks: dict[int, int], n: int, text: list[int]) -> int:
    """Least edit distance of a pattern of ``n`` words to any part of ``text``, by bit-parallel columns."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best = full, 0, n, n
    for word in text:
        same = masks.get(word, 0)
        x = same | down
        zero = (((x & up) + up) ^ up) | x
        plus = down | (full & ~(zero | up))
        minus = up & zero
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        best = min(best, score)
    return best


def edited(words: np.ndarray, edits: int, draw: random.Random) -> np.ndarray:
    out = words.tolist()
    for _ in range(edits):
        at, kind = draw.randrange(len(out)), draw.randrange(3)
        if kind == 0:
            out[at] = draw.getrandbits(63)
        elif kind == 1:
            out.insert(at, draw.getrandbits(63))
        elif len(out) > 1:
            del out[at]
    return np.array(out, np.uint64)


def tables_needed(ids: list[int], texts: list[bytes], target: float = TARGET_RECALL, trials: int = 200) -> int:
    """The fewest tables, among powers of two, that find simulated copies at the edit limit with the target recall."""
    pairs = [(i, t) for i, t in zip(ids, texts, strict=True) if len(words_of(np.frombuffer(t, np.uint8))) >= MIN_WORDS]
    if not pairs:
        return 1
    draw = random.Random(7)
    picked = [draw.choice(pairs) for _ in range(trials)]
    copies = None
    tables = 4
    while tables <= MAX_TABLES:
        items = Items(list(range(trials)), [t for _, t in picked], tables)
        copies = copies or [edited(words, limit(len(words)), draw) for words in items.words]
        found = sum(bool((walk(copy, *items.windows(copy), items.seeds, items.picks) == items.keys[k]).any()) for k, copy in enumerate(copies))
        if found >= target * trials:
            return tables
        tables *= 2
    raise RuntimeError(f"{MAX_TABLES} tables find less than {target} of the simulated copies")


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[tuple[list, list[bytes]]]:
    """The items in blocks of about BLOCK_BYTES, one at a time; the whole benchmark may be larger than the driver."""
    items = benchmark.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r["key"] is None, r["key"], r["text"]))
        yield [r["key"] for r in rows], [r["text"].encode() for r in rows]


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """One row for each document and item that leaks into it: ``key``, ``item_key``, first_word, edits, item_words."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("text"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, item {benchmark.schema[item_key].dataType.simpleString()}, first_word bigint, edits bigint, item_words bigint"
    found = None
    for ids, texts in _blocks(benchmark, item_key, "text"):
        shared = spark.sparkContext.broadcast((ids, texts, tables_needed(ids, texts)))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                at, rows = [], []
                for i, data in enumerate(bytescan.texts(batch.column(1))):
                    for item, start, edits in items.hits(words_of(data)):
                        at.append(i)
                        rows.append((items.ids[item], start, edits, len(items.words[item])))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["key", "item", "first_word", "edits", "item_words"])

        own = rows.mapInArrow(search, schema)
        found = own if found is None else found.unionAll(own)
    return found.select(F.col("key").alias(key), F.col("item").alias(item_key), "first_word", "edits", "item_words")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item leaks into, with their columns; documents are never shuffled.

    What one block leaves is written before the next is read, so a task holds one block at a time.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    marked = len(docs.columns)
    extra = "lowered"
    while extra in {c.lower() for c in docs.columns}:
        extra += "_"
    lowered = docs.select("*", F.lower(F.col(text)).alias(extra))
    before = None
    for at, (ids, texts) in enumerate(_blocks(benchmark, "item_id", "text")):
        if at:
            lowered = common.cut(lowered, "cleaned")
            if before is not None:
                common.drop_table(spark, before)
            before = lowered
        shared = spark.sparkContext.broadcast((ids, texts, tables_needed(ids, texts)))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                good = [not items.hits(words_of(data)) for data in bytescan.texts(batch.column(marked))]
                yield batch.filter(pa.array(good, pa.bool_()))

        lowered = lowered.mapInArrow(keep, lowered.schema)
    return lowered.drop(extra)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
