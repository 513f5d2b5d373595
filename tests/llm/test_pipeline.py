"""The pipeline: each stage takes effect, passes the columns on, and leaves clean documents alone."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import near, prose


def test_stages(spark, tmp_path):
    draw = random.Random(21)
    item = prose(30, draw)
    clean = [(i, prose(60, draw) + " write to me@example.org", "en", f"src{i % 4}") for i in range(40)]
    rows = [*clean, (100, clean[0][1], "en", "src0"), (101, near(clean[1][1], 0.02, draw), "en", "src1"), (102, prose(20, draw) + " " + item, "en", "src2"), (103, "too short", "en", "src3"), (104, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = df, [set(r.doc_id for r in df.collect())]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns, name
        ids.append({r.doc_id for r in docs.collect()})
    assert ids[0] - ids[1] == {103, 104} and ids[1] - ids[2] == {100, 101} and ids[2] - ids[3] == {102} and ids[3] == ids[4] == {c[0] for c in clean}
    assert all("[EMAIL]" in r.text and "me@example.org" not in r.text for r in docs.collect())
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "text", "epoch"} <= set(out.columns) and {r.doc_id for r in out.collect()} <= ids[4] and out.count() > 0


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, host string, label string, kept string, lowered string, n_tokens string, epoch string, region string, domain string"


def write(spark, folder, rows, items):
    filled = [(*r, 1, *("clash",) * 9) for r in rows]
    spark.createDataFrame(filled, COLUMNS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
        assert out.count() == 0 and "doc_id" in out.columns, name


def test_odd_rows_against_a_plain_pipeline(spark, tmp_path):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns: each stage against plain Python."""
    draw = random.Random(22)
    item = prose(30, draw)
    rows = [(i, prose(80, draw) + (" write to me@example.org" if i % 2 else ""), ["en", None, "de"][i % 3], None if i % 5 == 0 else f"src{i % 4}") for i in range(60)]
    rows += [(70, "", "en", "src1"), (71, None, None, None), (72, " \n ", "en", "src1"), (73, prose(30_000, draw), "en", "src1"), (74, rows[3][1], "en", "src1"), (75, near(rows[4][1], 0.02, draw), "de", "src0"), (76, prose(40, draw) + " " + item, "en", "src2"), (77, "short", "en", "src3"), (78, ("again and again " * 60).strip(), "en", "src1")]
    rows += [rows[5], rows[5], (None, prose(50, draw), "en", "src1")]
    write(spark, str(tmp_path), rows, [(0, item), (1, None), (2, "")])
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        seen.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr))

    def plain_quality(text):
        w = brute.WORD.findall(text or "")
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)] if len(w) < 5000 else []
        twice = {g for g in set(grams) if grams.count(g) > 1} if len(grams) < 400 else set()
        covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(8)}
        return len(w) >= 20 and 100 * len(covered) <= 30 * len(w)

    want = sorted(((d, t) for d, t, *_ in rows if plain_quality(t)), key=repr)
    assert seen[0] == want
    groups = brute.groups([(d, t) for d, t in want if d is not None], 5)
    want = [(d, t) for d, t in want if d is None or groups[d][1] == d]
    assert seen[1] == want and {74, 75} & {d for d, _ in want} == set()
    want = [(d, t) for d, t in want if d != 76]
    assert seen[2] == want
    want = sorted(((d, t.replace("me@example.org", "[EMAIL]")) for d, t in want), key=repr)
    assert seen[3] == want
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    assert len(mixed.columns) == len(set(c.lower() for c in mixed.columns))
    texts = {t for _, t in want}
    total = sum(len(t.split()) for _, t in want)
    got = [(r.doc_id, r.epoch, r.text) for r in mixed.collect()]
    assert got and {t for *_, t in got} <= texts and sum(len(t.split()) for *_, t in got) <= 0.5 * total
