"""Operator 10: near duplicates by an LSH forest over MinHash signatures.

1. Each text becomes the set of its word shingles; texts with equal sets are one class, led by the smallest key.
2. The leaders' signatures are read in several orders, the trees of the forest. Each tree is sorted by its labels, the
   values in its order, in one global sort of all trees (a range partitioning, so no leaf has to fit a task). A scan of
   the sorted rows gives each leader its neighbours and their longest common prefixes. Leaders that share the first
   DEPTH values are in one leaf, and all pairs of a leaf are candidates.
3. Depth adapts to the region. First, each leader is compared with the neighbour of its longest common prefix in any tree;
   where copies are dense that prefix is deep, and these links already join most of them. A second round does so with
   neighbours that were not tried and are of another component by then.
4. Then every leaf at DEPTH that still holds several components is compared block against block, in tasks of bounded
   size: the leaders outside the leaf's largest component with one another and with all of that component. Pairs within
   a component are skipped and no pairs are written, but each candidate is judged, whatever the size of its leaf:
   signatures first, and those that may be alike on their full sets. A dense group has a leaf of much the same documents
   in every tree; leaves that hold the same head are compared as one where that deals fewer rows.
5. The confirmed links' connected components are the groups.

With 40 trees of depth 6, a pair of similarity 0.8 misses every tree with a chance of about 1 in 10,000. Labels hold one
byte of each value, which only adds candidates.

Defined results: a text without words, or null, has the empty set and is linked with nothing. A text of fewer
words than a shingle has one shingle, all of it. Rows of one key are one document, with all their texts: it is linked
with what any of them is linked with, and each row has its own n_shingles. A null key is
linked with nothing but equal sets. Ties go to the smallest key. The key must be of an integer type. An empty table gives
an empty result. Extra columns are ignored by :func:`groups`, and passed through by :func:`keep_first`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bytescan, common
from tidemark.llm.components import components, joined

PERCENT = 80
VALUES = 160
TREES = 40
DEPTH = 6
#: Values of a label, one byte each; neighbours are told apart up to so deep.
DEEPEST = 16
#: What one task compares: leaders, and members of their sets (8 bytes each).
REGION_LEADERS = 1024
REGION_MEMBERS = 4_000_000
#: Rounds in which each leader is compared with one neighbour.
ROUNDS = 2
#: Leaves are compared as one only if so many times the pairs, at most, are judged.
MORE_PAIRS = 4

_DRAW = np.random.Generator(np.random.PCG64(1007))
MULTIPLIERS = _DRAW.integers(0, 1 << 63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
ORDERS = np.stack([_DRAW.permutation(VALUES) for _ in range(TREES)])


def shingle_set(data: np.ndarray, k: int) -> np.ndarray:
    """Ascending distinct hashes of the runs of ``k`` words of a text."""
    return np.unique(bytescan.shingles(bytescan.word_hashes(data)[2], k))


def signature(members: np.ndarray) -> np.ndarray:
    """The least value of the set under each of VALUES hash functions (32 bits of each)."""
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(members), 2048):
        part = members[at : at + 2048]
        h = (MULTIPLIERS[:, None] * part[None, :]) >> np.uint64(32)
        np.minimum(out, h.min(axis=1).astype(np.uint32), out=out)
    return out


def labels(sig: np.ndarray) -> np.ndarray:
    """For each document (row) and tree, the bytes that the tree is sorted by: its number, then values in its order."""
    out = np.empty((len(sig), TREES, 1 + DEEPEST), np.uint8)
    out[:, :, 0] = np.arange(TREES)
    out[:, :, 1:] = sig.astype(np.uint8)[:, ORDERS[:, :DEEPEST]]
    return out.reshape(-1, 1 + DEEPEST)


def _fixed(values: np.ndarray) -> pa.Array:
    """A binary column of the rows of a matrix of bytes."""
    n, width = values.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _sketch(k: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, sigs = [], [], [], []
            for data in bytescan.texts(batch.column(1)):
                members = shingle_set(data, k)
                sizes.append(len(members))
                one.append(int(bytescan.mix(members).sum(dtype=np.uint64).view(np.int64)) if len(members) else 0)
                two.append(int(np.bitwise_xor.reduce(bytescan.mix(members * np.uint64(0xD6E8FEB86659FD93))).view(np.int64)) if len(members) else 0)
                sigs.append(signature(members).tobytes() if len(members) else b"")
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sigs, pa.binary())], names=["doc", "n_shingles", "d1", "d2", "sig"])

    return sketch


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, VALUES)
            yield pa.record_batch([_fixed(labels(sig)), pa.array(np.repeat(part.column(0).to_numpy(), TREES)), pa.array(np.repeat(part.column(2).to_numpy(), TREES))], names=["label", "doc", "n"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, doc, n) in the order of the trees' labels. Out: leaf, doc, n, before, common.

    ``before`` is the row before it if they share DEPTH values or more, ``common`` of them. Rows that share no leaf with
    the one before or behind are left out, but for the first and the last of the task, whose neighbours it can't see.
    """
    held = None  # the last row: what is behind it decides
    schema = ["leaf", "doc", "n", "before", "common"]
    place = np.array([256**k for k in range(DEPTH, -1, -1)], np.int64)

    def rows(label, doc, n, before, common):
        leaf = (label[:, : 1 + DEPTH].astype(np.int64) * place).sum(axis=1)
        return pa.record_batch([pa.array(leaf), pa.array(doc), pa.array(n), pa.array(before, mask=common == 0), pa.array(common)], names=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        label, doc, n = _matrix(batch.column(0), 1 + DEEPEST), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        shared = np.zeros(len(doc), bool)
        before, common = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int32)
        if held is not None:
            label, doc, n, before, common, shared = (np.concatenate((x, y)) for x, y in zip(held, (label, doc, n, before, common, shared), strict=True))
        else:
            shared[0] = True
        same = np.cumprod(label[1:] == label[:-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int32) - 1
        near = same >= DEPTH
        shared[1:] |= near
        shared[:-1] |= near
        before[1:][near] = doc[:-1][near]
        common[1:][near] = same[near]
        keep = np.flatnonzero(shared[:-1])
        if len(keep):
            yield rows(*(x[keep] for x in (label, doc, n, before, common)))
        held = tuple(x[-1:].copy() for x in (label, doc, n, before, common, shared))
    if held is not None:
        yield rows(*held[:-1])


def _sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [shingle_set(data, k) for data in bytescan.texts(batch.column(1))]
            sigs = [signature(m).astype(np.uint8).tobytes() for m in members]
            yield pa.record_batch([batch.column(0), pa.array(list(map(len, members)), pa.int64()), pa.array(sigs, pa.binary()), pa.array([m.tobytes() for m in members], pa.binary())], names=["doc", "n", "sig", "members"])

    return sets


class Linker:
    """Union-find over the documents of one region."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= PERCENT * union, on full sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < PERCENT * large:
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


#: Pairs whose signatures agree in fewer values are never tried: 6 standard deviations below what the limit gives.
LEAST = VALUES * (PERCENT / 100 - 6 * (PERCENT / 100 * (1 - PERCENT / 100) / VALUES) ** 0.5)


def _alike(i: int, sigs: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets before ``i``, of other labels, that may be similar to it, and the values in which their signatures agree."""
    j = np.flatnonzero(label[:i] != label[i])
    low, high = np.minimum(sizes[j], sizes[i]), np.maximum(sizes[j], sizes[i])
    j = j[100 * low >= PERCENT * high]
    agree = (sigs[j] == sigs[i]).sum(axis=1)
    good = agree >= LEAST
    return j[good], agree[good]


def link_region(sets: list[np.ndarray], sigs: np.ndarray, known: list[int]) -> list[int]:
    """For each set, the index of the first set of its component; every pair is judged, linked ones aside.

    Sets of one ``known`` label are linked from the start.
    """
    n = len(sets)
    linker = Linker(n)
    label = np.unique(np.array(known, np.int64), return_inverse=True)[1]
    heads: dict[int, int] = {}
    for x, y in enumerate(label.tolist()):
        linker.parent[x] = heads.setdefault(y, x)
    sizes = np.array([len(s) for s in sets])
    tried: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(1, n):
        j, agree = _alike(i, sigs, sizes, label)
        if len(j):
            # The most alike first: most documents are linked at once and need no other check.
            order = np.argsort(-agree, kind="stable")
            j, agree = j[order], agree[order]
            if similar(sets[j[0]], sets[i]):
                linker.parent[linker.root(i)] = linker.root(int(j[0]))
                j, agree = j[1:], agree[1:]
            tried.append((np.full(len(j), i), j, agree))
    if tried:
        i, j, agree = (np.concatenate(x) for x in zip(*tried, strict=True))
        order = np.argsort(-agree, kind="stable")
        for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
            ra, rb = linker.root(a), linker.root(b)
            if ra != rb and similar(sets[a], sets[b]):
                linker.parent[ra] = rb
    first: dict[int, int] = {}
    return [first.setdefault(linker.root(x), x) for x in range(n)]


def _by_region(batches: Iterator[pa.RecordBatch], settle) -> Iterator[pa.RecordBatch]:
    """``settle`` (a table) of the rows of each region, which come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        region = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1]))) if len(region) else []
        for s, e in zip(starts, [*starts[1:], len(region)], strict=True):
            if held and held[0].column(0)[0].as_py() != region[s]:
                yield from settle(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(s, e - s))
    if held:
        yield from settle(pa.Table.from_batches(held))


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (region, doc, label, n, sig). Out: region, doc, label of those that may be similar to one of another label."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sigs, sizes = _matrix(rows.column(4).combine_chunks(), VALUES), rows.column(3).to_numpy()
        label = np.unique(rows.column(2).to_numpy(), return_inverse=True)[1]
        good = np.zeros(len(sizes), bool)
        for i in range(1, len(sizes)):
            j, _ = _alike(i, sigs, sizes, label)
            good[j] = True
            good[i] |= len(j) > 0
        if good.any():
            yield pa.record_batch([rows.column(k).combine_chunks().filter(pa.array(good)) for k in range(3)], names=["region", "doc", "label"])

    return _by_region(batches, settle)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (region, doc, label, sig, members). Out: links from each document to the first of its component."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(m, np.uint64) for m in rows.column(4).to_pylist()]
        doc = rows.column(1).to_numpy()
        first = doc[link_region(sets, _matrix(rows.column(3).combine_chunks(), VALUES), rows.column(2).to_pylist())]
        other = first != doc
        if other.any():
            yield pa.record_batch([pa.array(doc[other]), pa.array(first[other])], names=["a", "b"])

    return _by_region(batches, settle)


def _links(parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among the documents of each region of ``parts`` (region, doc, label)."""
    seen = parts.join(sets.select("doc", "n", "sig"), "doc").select("region", "doc", "label", "n", "sig").distinct()
    seen = seen.repartition(F.col("region")).sortWithinPartitions("region", "doc")
    alike = common.cut(seen.mapInArrow(_promising, "region bigint, doc bigint, label bigint").distinct(), "alike")
    full = alike.join(sets.select("doc", "sig", "members"), "doc").select("region", "doc", "label", "sig", "members")
    return full.repartition(F.col("region")).sortWithinPartitions("region", "doc").mapInArrow(_link, "a bigint, b bigint")


def _nearest(places: DataFrame, found: DataFrame | None = None, tried: DataFrame | None = None) -> DataFrame:
    """a, b: each document and its neighbour of the longest common prefix in any tree, on either side.

    With ``found`` (node, component) and ``tried`` (a, b), neighbours of the same component and tried pairs don't count.
    """
    pairs = places.filter("before <> doc").select(F.least("doc", "before").alias("a"), F.greatest("doc", "before").alias("b"), "common")
    if found is not None:
        pairs = pairs.groupBy("a", "b").agg(F.max("common").alias("common")).join(tried, ["a", "b"], "left_anti")
        of = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"{name}_in"))
        pairs = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").filter("coalesce(a_in, a) <> coalesce(b_in, b)").select("a", "b", "common")
    pairs = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "common"))
    best = pairs.groupBy("a").agg(F.max(F.struct("common", "b")).alias("best")).select("a", "best.b")
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _regions(pairs: DataFrame) -> DataFrame:
    """region, doc, label: a region for each pair (a, b)."""
    return pairs.select(F.xxhash64("a", "b").alias("region"), F.explode(F.array("a", "b")).alias("doc")).withColumn("label", F.col("doc"))


def _blocks(count: F.Column, members: F.Column) -> F.Column:
    """Blocks of which two make what one task compares."""
    return F.greatest(F.lit(1), F.ceil(2 * count / REGION_LEADERS), F.ceil(2 * members / REGION_MEMBERS)).cast("int")


def _open(rows: DataFrame) -> DataFrame:
    """Of each leaf of ``rows`` (leaf, doc, n, label) that holds several labels: its largest one, its blocks, the rows and pairs that they make.

    ``count``, ``x`` and ``y`` tell its documents from others, ``head`` is the least hash of them.
    """
    sign = lambda salt: F.bit_xor(F.xxhash64("doc", F.lit(salt)))
    parts = rows.groupBy("leaf", "label").agg(F.count("*").alias("c"), F.sum("n").alias("m"), sign(0).alias("x"), sign(1).alias("y"), F.min(F.xxhash64("doc")).alias("head"))
    leaf = parts.groupBy("leaf").agg(F.max(F.struct("c", "label", "m")).alias("major"), F.sum("c").alias("count"), F.sum("m").alias("members"), F.count("*").alias("labels"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.min("head").alias("head"))
    minor = F.col("count") - F.col("major.c")
    leaf = leaf.filter("labels > 1").withColumn("few", _blocks(minor, F.col("members") - F.col("major.m"))).withColumn("many", _blocks(F.col("major.c"), F.col("major.m")))
    return leaf.select("leaf", "head", F.col("major.label").alias("most"), "few", "many", (minor * (F.col("few") + F.col("many") - 1) + F.col("major.c") * F.col("few")).alias("dealt"), (minor * F.col("count")).alias("judged"), "count", "x", "y")


def _blockwise(places: DataFrame, found: DataFrame) -> DataFrame:
    """region, doc, label: pairs of blocks of the leaves that hold several components of ``found`` (node, component).

    Leaves of the same documents are compared once. Leaves of one head, most of which overlap, are compared as one where that
    deals fewer rows; all of them hold the head, so a union is of TREES leaves at most.

    The leaders outside the largest component come first, in ``few`` blocks, the others in ``many``; every block meets each
    of the first ones. Pairs inside a block are seen there too.
    """
    label = found.select(F.col("node").alias("doc"), "component")
    rows = common.cut(places.select("leaf", "doc", "n").distinct().join(label, "doc", "left").select("leaf", "doc", "n", F.coalesce("component", "doc").alias("label")), "labelled")
    plan = ["leaf", "most", "few", "many"]
    leaves = common.cut(_open(rows).groupBy("count", "x", "y").agg(F.min(F.struct("head", *plan, "dealt", "judged")).alias("one")).select("one.*"), "open-leaves")
    unions = common.cut(rows.join(leaves.select("leaf", "head"), "leaf").select(F.col("head").alias("leaf"), "doc", "n", "label").distinct(), "unions")
    apart = leaves.groupBy("head").agg(F.sum("dealt").alias("dealt_apart"), F.sum("judged").alias("judged_apart"))
    merged = _open(unions).select(*plan, "dealt", "judged").join(apart.withColumnRenamed("head", "leaf"), "leaf").filter(f"dealt <= dealt_apart AND judged <= {MORE_PAIRS} * judged_apart")
    merged = common.cut(merged.select(plan), "merged")
    alone = leaves.join(merged.select(F.col("leaf").alias("head")), "head", "left_anti").select(plan)
    dealt = unions.join(merged, "leaf").withColumn("union", F.lit(True)).unionAll(rows.join(alone, "leaf").select(*unions.columns, *plan[1:]).withColumn("union", F.lit(False)))
    minor, hashed = F.col("label") != F.col("most"), F.xxhash64("doc")
    dealt = dealt.withColumn("block", F.when(minor, F.pmod(hashed, F.col("few"))).otherwise(F.col("few") + F.pmod(hashed, F.col("many"))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(minor, F.col("few") + F.col("many") - 1).otherwise(F.col("few") - 1)))).filter("block <> other")
    return dealt.select(F.xxhash64("union", "leaf", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "doc", "label")


def groups(docs: DataFrame, k: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    common.integer_key(docs, key)
    common.small_batches(spark)
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    sketches = common.cut(rows.mapInArrow(_sketch(k), "doc bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary"), "sketches")
    full = sketches.filter("n_shingles > 0 AND doc IS NOT NULL")
    classes = common.cut(full.groupBy("d1", "d2").agg(F.min("doc").alias("leader"), F.count("*").alias("copies")), "classes")
    leaders = full.join(classes.select(F.col("leader").alias("doc"), "d1", "d2"), ["doc", "d1", "d2"], "left_semi").dropDuplicates(["doc", "d1", "d2"])
    forest = common.cut(leaders.select("doc", "sig", F.col("n_shingles").alias("n")).mapInArrow(_forest, "label binary, doc bigint, n bigint"), "forest")
    ordered = forest.repartitionByRange("label", "doc").sortWithinPartitions("label", "doc")
    places = common.cut(ordered.mapInArrow(_neighbours, "leaf bigint, doc bigint, n bigint, before bigint, common int"), "places")
    common.drop_table(spark, forest)

    wanted = places.select("doc").distinct()
    sets = common.cut(rows.join(wanted.hint("shuffle_hash"), "doc").mapInArrow(_sets(k), "doc bigint, n bigint, sig binary, members binary"), "sets")
    tried = common.cut(_nearest(places), "pairs")
    found = components(_links(_regions(tried), sets))
    for _ in range(ROUNDS - 1):
        best = common.cut(_nearest(places, found, tried), "pairs")
        found = common.cut(joined(found, _links(_regions(best), sets)), "found")
        tried = tried.unionAll(best)
        tried = tried.unionAll(best)
    more = _links(common.cut(_blockwise(places, found), "blocks"), sets)

    # A key with several texts is in several classes.
    mixed = common.cut(full.groupBy("doc").agg(F.min("d1").alias("least"), F.max("d1").alias("most")).filter("least <> most").select("doc"), "mixed-keys")
    same = full.join(mixed, "doc", "left_semi").join(classes, ["d1", "d2"]).select(F.col("doc").alias("a"), F.col("leader").alias("b"))
    found = joined(found, more.unionAll(same))

    class_of = classes.join(found.select(F.col("node").alias("leader"), "component"), "leader", "left").select("d1", "d2", F.coalesce("component", "leader").alias("component"))
    out = sketches.select("doc", "n_shingles", "d1", "d2").withColumn("linked", F.col("n_shingles") > 0)
    out = out.join(class_of, ["d1", "d2"], "left")
    component = F.when(F.col("linked"), F.coalesce("component", "doc")).otherwise(F.col("doc"))
    return out.select(F.col("doc").alias(key), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc")).alias("kept"))


def keep_first(docs: DataFrame, k: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one of the smallest key, with its columns."""
    kept = groups(docs, k, key, text).filter("kept").select(F.col(key).alias("key")).distinct()
    kept = kept.select(F.struct("key").alias(_free(docs, "kept")))
    return docs.join(kept.hint("shuffle_hash"), F.col(key).eqNullSafe(kept[kept.columns[0]]["key"]), "left_semi")


def _free(df: DataFrame, name: str) -> str:
    """``name``, longer where the columns of ``df`` hold it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(common.table(spark, sf_dir, "documents"))
