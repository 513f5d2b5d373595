"""Operator 5: removal of repeated 100-byte strings by bucket-pointer refinement over sparse suffixes.

The suffixes of all texts start in buckets of their first q bytes. A bucket is refined by sorting its suffixes on the
identifiers of the buckets that they are in q bytes further on; the refined identifiers take the place of the old
ones at once, so the next refinement looks twice as far: 8, 16, 32, 64 bytes, and LENGTH in the last step. An
identifier is a 64-bit value made of the two it was refined from, so tasks agree on it without exchanging ranks.

Sorting every suffix in this way would shuffle some twenty times the input. The suffixes that are sorted across the
cluster are those at anchors: positions whose bucket identifier at 32 bytes is the least of a window, chosen by
content alone. Any two equal strings of LENGTH bytes hold equal anchors at equal places, so no repeat is missed.

1. Each anchor carries its bucket's identifier and that of its neighbourhood, all that a string of LENGTH bytes
   around the anchor can hold, refined from the buckets at later offsets. What repeats within a batch is settled there.
2. One global sort by bucket, neighbourhood and place splits the buckets. It is a range partitioning, so a bucket or
   neighbourhood of any size lies in as many tasks as it needs; what continues beyond the edge of a task is settled by
   an aggregation. A suffix that isn't the first of its neighbourhood's repeats it whole; a bucket of one neighbourhood
   is done.
3. Only in buckets that split, the members (one for each neighbourhood) fetch their bytes, and the suffixes around
   them are refined: those alone in their bucket at 32 bytes are done, the others go on to LENGTH bytes. Buckets with
   very many members are refined by an aggregation instead of in one task.

Defined results: a null text counts as empty: nothing is removed, the digest is that of no bytes. Ties go to the
smaller key, then the earlier start. Rows of one key and one text are one document: they don't remove each other, and
each keeps a row. Different texts under one key are parts of one document, in an order of their own; no string
reaches over two of them. A row with a null key has no place in the order: nothing is removed from it or because of
it. The key must be of an integer type. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bytescan, common

LENGTH = 100
START = 8  # bytes of the first buckets
GRAM = 32
SPAN = LENGTH - GRAM  # an anchor lies at most this far behind the start of a string that holds it
PIECE = 1 << 16
#: Places of the texts of one key are this far apart.
TEXTS_APART = 1 << 32
#: Buckets with more members than this are refined by aggregation.
HOT_MEMBERS = 20_000
#: Members that are refined at a time; what is kept of those before is each string's first place.
AT_ONCE = 4096

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE_STEP = np.array([256**k for k in range(START)], np.uint64)


def first_buckets(data: np.ndarray) -> np.ndarray:
    """The identifiers of the buckets of the suffixes' first START bytes: those bytes, spread. Works along the last axis."""
    n = data.shape[-1] - START + 1
    out = data[..., :n].astype(np.uint64)
    for k in range(1, START):
        out |= data[..., k : n + k].astype(np.uint64) << np.uint64(8 * k)
    return bytescan.mix(out)


def refined(bucket: np.ndarray, later: int) -> np.ndarray:
    """Identifiers refined by those of the buckets at the offset ``later``."""
    n = bucket.shape[-1] - later
    out = bucket[..., :n] * _ODD + (bucket[..., later:] ^ (bucket[..., later:] >> np.uint64(31))) * _ODD2
    out ^= out >> np.uint64(29)
    return out


def buckets(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Identifiers of the buckets of ``size`` bytes (START times a power of two), by refining what the last refinement gave."""
    out, known = first_buckets(data), START
    while known < size:
        out, known = refined(out, known), 2 * known
    return out


def _slide(x: np.ndarray, size: int, best, fill: np.uint64) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every run of ``size`` values, by prefixes and suffixes of blocks."""
    n = len(x)
    rows = -(-n // size)
    block = np.full(rows * size, fill, np.uint64)
    block[:n] = x
    block = block.reshape(rows, size)
    ahead = best.accumulate(block, axis=1).ravel()
    behind = best.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - size + 1], ahead[size - 1 : n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors, identifiers of their buckets, identifiers of their neighbourhoods."""
    n = len(data)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, n - LENGTH + 1, PIECE):
        b = min(a + PIECE, n - LENGTH + 1)  # strings that start in [a, b)
        lo, hi = max(0, a - SPAN), min(n, b + SPAN + LENGTH)
        part = np.zeros(hi - lo + SPAN + LENGTH, np.uint8)
        part[SPAN : SPAN + hi - lo] = data[lo:hi]
        h = buckets(part)
        first, last = a - lo + SPAN, b - 1 + SPAN - lo + SPAN  # suffixes that those strings hold
        held = bytescan.mix(h[first : last + 1])
        least = _slide(held, SPAN + 1, np.minimum, _TOP)
        padded = np.zeros(len(least) + 2 * SPAN, np.uint64)
        padded[SPAN : SPAN + len(least)] = least
        at = np.flatnonzero(held <= _slide(padded, SPAN + 1, np.maximum, np.uint64(0)))
        where = at + first
        # The neighbourhood, SPAN bytes before and LENGTH behind, padded by zeros at the ends of the text, whose distances count.
        around = h[where - SPAN].copy()
        for later in (-SPAN + GRAM, -SPAN + 2 * GRAM, 0, GRAM, 2 * GRAM, LENGTH - GRAM):
            around = bytescan.mix(around * _ODD + h[where + later])
        place = where - SPAN + lo
        left, right = np.minimum(place, SPAN), np.minimum(n - place, LENGTH)
        found.append((place, held[at], bytescan.mix(around + (left * 1000 + right).astype(np.uint64))))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at, gram, around = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(found) > 1:
        at, keep = np.unique(at, return_index=True)
        gram, around = gram[keep], around[keep]
    return at, gram, around


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals, as ascending ones that neither overlap nor touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))]


ANCHOR_SCHEMA = "gram bigint, around bigint, doc bigint, at bigint, sides int"
#: What _split_buckets gives: an interval to remove (doc, at to until), a member, or a bucket at the edge of a task.
SPLIT_SCHEMA = "kind tinyint, gram bigint, around bigint, doc bigint, at bigint, until bigint"
REMOVE, MEMBER, EDGE = 0, 1, 2


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, base, text) to rows of ANCHOR_SCHEMA; ``sides`` is 256 * bytes before + bytes behind.

    What repeats inside one batch is settled here: rows whose ``sides`` is -1, to be removed from ``at`` up to ``around``.
    """
    for batch in batches:
        rows = []
        for doc, base, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bytescan.texts(batch.column(2)), strict=True):
            at, gram, around = anchors(data)
            if len(at):
                sides = np.minimum(at, SPAN) * 256 + np.minimum(len(data) - at, LENGTH)
                rows.append((gram, around, np.full(len(at), doc), at + base, sides))
        if not rows:
            continue
        gram, around, doc, at, sides = (np.concatenate(x) for x in zip(*rows, strict=True))
        # Equal places of equal rows are one; then the first place of each neighbourhood stays.
        order = np.lexsort((at, doc, around, gram))
        gram, around, doc, at, sides = gram[order], around[order], doc[order], at[order], sides[order]
        same = np.zeros(len(gram), bool)
        same[1:] = (gram[1:] == gram[:-1]) & (around[1:] == around[:-1])
        again = same & (sides // 256 + sides % 256 >= LENGTH)
        again[1:] &= (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(gram))))
        again &= (doc != doc[head]) | (at != at[head])
        gone = np.flatnonzero(again)
        gone = gone[np.lexsort((at[gone], doc[gone]))]
        d, s, e = doc[gone], at[gone] - sides[gone] // 256, at[gone] + sides[gone] % 256
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (s[1:] > e[:-1])  # neighbourhoods of one document end in the order of their places
        last = np.concatenate((new[1:], [True])) if len(d) else new
        d, s, e = d[new], s[new], e[last]
        spread = bytescan.mix(d.astype(np.uint64) * np.uint64(4099) + s.astype(np.uint64)).view(np.int64)
        keep = ~same
        yield pa.record_batch(
            [pa.array(np.concatenate(x)) for x in ((spread, gram[keep].view(np.int64)), (e, around[keep].view(np.int64)), (d, doc[keep]), (s, at[keep]), (np.full(len(d), -1, np.int32), sides[keep].astype(np.int32)))],
            names=["gram", "around", "doc", "at", "sides"],
        )


def _split_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the global order of bucket, neighbourhood and place. Out: rows of SPLIT_SCHEMA.

    Members are the first of each neighbourhood in buckets that hold several, or that lie at an edge of this task, which
    are named as such. Carried over are one row and the name of the first bucket.
    """
    edge = gram0 = around0 = doc0 = at0 = until0 = None
    pending = False  # whether the carried leader is the only one of its bucket so far, and not yet given
    out: list[tuple] = []

    def give(kind, gram, around, doc, at, until):
        n = len(doc)
        if n:
            out.append((np.full(n, kind, np.int8), gram, around, doc, at, until))

    def flush():
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        out.clear()
        return pa.record_batch([pa.array(c) for c in columns], names=["kind", "gram", "around", "doc", "at", "until"])

    one = lambda *x: tuple(np.array([v], np.int64) for v in x)
    for batch in batches:
        gram, around, doc, at, sides = (c.to_numpy() for c in batch.columns)
        local = sides < 0
        give(REMOVE, gram[local], gram[local], doc[local], at[local], around[local])
        gram, around, doc, at, sides = (x[~local] for x in (gram, around, doc, at, sides))
        n = len(gram)
        if n:
            leader = np.ones(n, bool)
            leader[1:] = (gram[1:] != gram[:-1]) | (around[1:] != around[:-1])
            if gram0 is not None:
                leader[0] = gram[0] != gram0 or around[0] != around0
            of = np.maximum.accumulate(np.where(leader, np.arange(n), -1))
            first_doc = np.where(of >= 0, doc[of], doc0 if doc0 is not None else 0)
            first_at = np.where(of >= 0, at[of], at0 if at0 is not None else 0)
            lo, hi = at - sides // 256, at + sides % 256
            gone = ~leader & ((doc != first_doc) | (at != first_at)) & (hi - lo >= LENGTH)
            give(REMOVE, gram[gone], gram[gone], doc[gone], lo[gone], hi[gone])
            if edge is None:
                edge = int(gram[0])
                give(EDGE, *one(edge, 0, 0, 0, 0))
            place = np.flatnonzero(leader)
            if len(place):
                g, s = gram[place], sides[place].astype(np.int64)
                starts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
                sizes = np.diff(np.concatenate((starts, [len(g)])))
                joins = gram0 is not None and g[0] == gram0
                if joins and pending:
                    give(MEMBER, *one(gram0, around0, doc0, at0, until0))
                keep = np.repeat(sizes > 1, sizes) | (g == edge)
                if joins:
                    keep[: sizes[0]] = True
                give(MEMBER, g[keep], around[place][keep], doc[place][keep], at[place][keep], s[keep])
                pending = not keep[-1]
                gram0, around0, doc0, at0, until0 = int(g[-1]), int(around[place[-1]]), int(doc[place[-1]]), int(at[place[-1]]), int(s[-1])
        if out:
            yield flush()
    if gram0 is not None:
        if pending:
            give(MEMBER, *one(gram0, around0, doc0, at0, until0))
        if gram0 != edge:
            give(EDGE, *one(gram0, 0, 0, 0, 0))
        if out:
            yield flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each member: gram, doc, at, left (bytes before the anchor), around."""
    for batch in batches:
        grams, docs, places, lefts, parts = [], [], [], [], []
        for doc, base, data, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bytescan.texts(batch.column(2)), batch.column(3), strict=True):
            own = own.values
            for gram, place in zip(own.field("gram").to_pylist(), own.field("at").to_pylist(), strict=True):
                at = place - base
                if 0 <= at < TEXTS_APART:
                    lo = max(0, at - SPAN)
                    grams.append(gram), docs.append(doc), places.append(place), lefts.append(at - lo)
                    parts.append(data[lo : at + LENGTH].tobytes())
        yield pa.record_batch([pa.array(grams, pa.int64()), pa.array(docs, pa.int64()), pa.array(places, pa.int64()), pa.array(lefts, pa.int32()), pa.array(parts, pa.binary())], names=["gram", "doc", "at", "left", "around"])


def strings_around(gram: np.ndarray, doc: np.ndarray, at: np.ndarray, left: np.ndarray, around: list[bytes], open_buckets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket identifier at LENGTH bytes, member, document and start of the strings that hold a member's anchor.

    With ``open_buckets`` (identifiers at GRAM bytes, sorted), suffixes alone in their bucket are done and left out, unless the bucket is open.
    """
    size = np.fromiter(map(len, around), np.int64, len(around))
    width = SPAN + LENGTH
    block = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in around), np.uint8).reshape(len(around), width)
    known = buckets(block)
    starts = width - LENGTH + 1
    start = np.arange(starts)[None, :]
    good = (start + LENGTH <= size[:, None]) & (start <= left[:, None])
    member, start = np.nonzero(good)
    # Strings of one bucket of anchors are compared, at the same distance from the anchor.
    own = bytescan.mix(gram.view(np.uint64) + _ODD)[member] + (left[member] - start).astype(np.uint64) * _ODD2
    if open_buckets is not None:
        short = bytescan.mix(known[member, start] ^ own)
        order = np.argsort(short, kind="stable")
        same = short[order[1:]] == short[order[:-1]]
        shared = np.zeros(len(short), bool)
        shared[order[1:]] = same
        shared[order[:-1]] |= same
        if len(open_buckets):
            at_open = np.minimum(np.searchsorted(open_buckets, gram[member]), len(open_buckets) - 1)
            shared |= open_buckets[at_open] == gram[member]
        member, start, own = member[shared], start[shared], own[shared]
    longer = refined(known, GRAM)  # 64 bytes
    whole = refined(longer, LENGTH - 2 * GRAM)
    return bytescan.mix(whole[member, start] ^ own), member, doc[member], (at - left)[member] + start


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram; buckets up to HOT_MEMBERS. Out: intervals to remove."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = none  # of the last bucket so far: its strings, and the first place (document, start) of each
    last = None

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal first, last
        table = pa.Table.from_batches(rows)
        gram, doc, at, left = (table.column(k).to_numpy().astype(np.int64) for k in ("gram", "doc", "at", "left"))
        # Buckets at the ends may go on in the rows before and behind.
        ends = np.unique(np.array([gram[0], gram[-1]]))
        h, member, d, p = strings_around(gram, doc, at, left, table.column("around").to_pylist(), ends)
        bucket = gram[member]
        if gram[0] == last:
            h, d, p = (np.concatenate(x) for x in zip(first, (h, d, p), strict=True))
            bucket = np.concatenate((np.full(len(first[0]), last), bucket))
        order = np.lexsort((p, d, h))
        h, d, p, bucket = h[order], d[order], p[order], bucket[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        of = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        gone = (d != d[of]) | (p != p[of])
        keep = new & (bucket == gram[-1])
        first, last = (h[keep], d[keep], p[keep]), gram[-1]
        d, p = d[gone], p[gone]
        # Runs of starts become intervals.
        order = np.lexsort((p, d))
        d, p = d[order], p[order]
        head = np.ones(len(d), bool)
        head[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + LENGTH)
        tail = np.concatenate((head[1:], [True])) if len(d) else head
        return pa.record_batch([pa.array(d[head]), pa.array(p[head]), pa.array(p[tail] + LENGTH)], names=["doc", "lo", "hi"])

    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= AT_ONCE:
            yield settle(held)
            held, count = [], 0
    if count:
        yield settle(held)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram, doc, at, left = (batch.column(k).to_numpy().astype(np.int64) for k in range(4))
        if len(doc):
            h, _, d, p = strings_around(gram, doc, at, left, batch.column(4).to_pylist())
            yield pa.record_batch([_signed(h), pa.array(d), pa.array(p)], names=["string", "doc", "at"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, removed, spans, digests = [], [], [], []
        for base, data, own in zip(batch.column(1).to_pylist(), bytescan.texts(batch.column(2)), batch.column(3), strict=True):
            n, gone, runs = len(data), 0, 0
            digest = hashlib.sha256()
            at = 0
            if own.is_valid and len(own.values):
                s, e = own.values.field("lo").to_numpy() - base, own.values.field("hi").to_numpy() - base
                mine = (s >= 0) & (s < TEXTS_APART)
                s, e = merged(s[mine], e[mine])
                runs, gone = len(s), int((e - s).sum())
                for lo, hi in zip(s.tolist(), e.tolist(), strict=True):
                    digest.update(data[at:lo].tobytes())
                    at = hi
            digest.update(data[at:].tobytes())
            size.append(n), removed.append(gone), spans.append(runs), digests.append(digest.hexdigest())
        yield pa.record_batch([batch.column(0), *(pa.array(x, pa.int64()) for x in (size, removed, spans)), pa.array(digests, pa.string())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, base, text: ``base`` is where the places of a text begin, other than 0 only where a key has several texts."""
    common.integer_key(docs, key)
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("own"))
    mixed = rows.filter("doc IS NOT NULL").groupBy("doc").agg(F.min("own").alias("least"), F.max("own").alias("most")).filter("least <> most").select("doc")
    mixed = common.cut(mixed, "mixed-keys")
    if mixed.isEmpty():
        return rows.select("doc", F.lit(0).cast("bigint").alias("base"), "text")
    texts = rows.join(mixed, "doc", "left_semi").select("doc", "own").distinct()
    rank = texts.withColumn("base", (F.row_number().over(Window.partitionBy("doc").orderBy("own")) - 1) * F.lit(TEXTS_APART))
    rank = common.cut(rank.filter("base > 0"), "bases")
    return rows.join(rank, ["doc", "own"], "left").select("doc", F.coalesce("base", F.lit(0).cast("bigint")).alias("base"), "text")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, lo, hi: intervals to remove, of bytes counted from the base of their text (see :func:`_rows`); they may overlap."""
    return _repeats(_rows(docs, key, text).filter("doc IS NOT NULL"))


def _repeats(rows: DataFrame) -> DataFrame:
    common.small_batches(rows.sparkSession)
    order = ["gram", "around", "doc", "at"]
    # Written first: the ranges are found from a sample, and texts are scanned for anchors once.
    placed = common.cut(rows.mapInArrow(_anchors, ANCHOR_SCHEMA), "anchors")
    found = common.cut(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_split_buckets, SPLIT_SCHEMA), "buckets")
    common.drop_table(rows.sparkSession, placed)
    whole = found.filter(F.col("kind") == REMOVE).select("doc", F.col("at").alias("lo"), F.col("until").alias("hi"))
    members = found.filter(F.col("kind") == MEMBER).select("gram", "around", "doc", "at", F.col("until").alias("sides"))

    # Two buckets a task at most are at its edges. Their neighbourhoods may each have a leader in several tasks.
    edges = common.cut(found.filter(F.col("kind") == EDGE).select("gram").distinct(), "edges")
    shared = common.cut(members.join(edges, "gram", "left_semi"), "shared")
    true = common.cut(shared.groupBy("gram", "around").agg(F.min(F.struct("doc", "at")).alias("first")), "first")
    later = shared.join(true, ["gram", "around"]).filter(F.struct("doc", "at") != F.col("first"))
    left, right = F.expr("sides div 256"), F.col("sides") % 256
    whole = whole.unionAll(later.filter(left + right >= LENGTH).select("doc", (F.col("at") - left).alias("lo"), (F.col("at") + right).alias("hi")))
    several = true.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    split = true.join(several, "gram", "left_semi").select("gram", "first.doc", "first.at")
    members = common.cut(members.join(edges, "gram", "left_anti").select("gram", "doc", "at").unionAll(split), "split")

    own = members.groupBy("doc").agg(F.collect_list(F.struct("gram", "at")).alias("own"))
    fetched = rows.join(own.hint("shuffle_hash"), "doc").select("doc", "base", "text", "own").mapInArrow(_members, "gram bigint, doc bigint, at bigint, left int, around binary")
    fetched = common.cut(fetched, "members")

    hot = common.cut(members.groupBy("gram").count().filter(F.col("count") > HOT_MEMBERS).select("gram"), "hot")
    few = fetched.join(hot, "gram", "left_anti").repartition(F.col("gram")).sortWithinPartitions("gram")
    refined_few = few.mapInArrow(_refine, "doc bigint, lo bigint, hi bigint")
    strings = fetched.join(hot, "gram", "left_semi").mapInArrow(_strings, "string bigint, doc bigint, at bigint").distinct()
    first = strings.groupBy("string").agg(F.min(F.struct("doc", "at")).alias("first"))
    repeated = strings.join(first, "string").filter(F.struct("doc", "at") != F.col("first"))
    out = common.cut(whole.unionAll(refined_few).unionAll(repeated.select("doc", F.col("at").alias("lo"), (F.col("at") + LENGTH).alias("hi"))), "repeats")
    for old in (found, edges, shared, true, members, fetched, hot):
        common.drop_table(rows.sparkSession, old)
    return out


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = _rows(docs, key, text)
    found = _repeats(rows.filter("doc IS NOT NULL")).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("own"))
    out = rows.join(found.hint("shuffle_hash"), "doc", "left").select("doc", "base", "text", "own").mapInArrow(_cut_out, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.withColumnRenamed("doc", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"))
