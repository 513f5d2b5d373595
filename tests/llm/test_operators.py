"""Each operator against brute force, and on the cases that break things: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import bytescan, components, decontamination, html_text, language_mixture, near_duplicates, pii, quality_rules, source_mixing, substring_dedup, token_counts, url_filters

DRAW = random.Random(11)
VOCABULARY = ["".join(DRAW.choice("abcdeorst") for _ in range(DRAW.randint(2, 7))) for _ in range(400)]


def prose(n, draw=DRAW):
    return " ".join(draw.choice(VOCABULARY) for _ in range(n))


def near(text, share, draw=DRAW):
    return " ".join(draw.choice(VOCABULARY) if draw.random() < share else w for w in text.split(" "))


BASE = prose(120)
PASSAGE = prose(40)
TEXTS = [
    BASE, BASE, BASE.upper(), near(BASE, 0.03), near(BASE, 0.05), near(BASE, 0.08), prose(50) + " " + PASSAGE + " " + prose(30), PASSAGE + "\n" + prose(20), None, "", " \n\t ", "one", "ONE", "two words", "x" * 350, "x" * 90,
    "é" * 120, "a\n" * 300, prose(3000), "ab " * 5000, "émail à b@c.de", "\u2028 \x1c \x85", "0" * 5000, "<|endoftext|> a <|endoftext|>", "0" * 5000 + "1.1.1.1 " + "9" * 5000 + ".1.1.1", "1" * 9000 + "@" + "+1 " + "2 " * 3000,
]
DOCS = list(enumerate(TEXTS))


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", None, "fr"]
    rows = [(i, t, langs[i % 3], None if i % 7 == 3 else f"src{i % 3}", len(t or ""), i, "clash", "clash") for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, doc long, key string, host string").repartition(3)


@pytest.fixture
def many_tasks(spark):
    """Far more tasks than rows of a group, so that groups lie over the edges of tasks."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


# -- scanning -----------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é\n\t中", max_size=300))
def test_word_hashes_tell_words_apart(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, hashes = bytescan.word_hashes(data)
    found = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    assert [w.decode() for w in found] == brute.WORD.findall(text)
    assert len(set(found)) == len(set(hashes.tolist()))


def test_hashes_are_the_same_across_chunks():
    piece = prose(40).encode()
    data = np.frombuffer(piece + b" " + b"z" * bytescan.CHUNK + b" " + piece + b" " + b"y " * bytescan.CHUNK + piece, np.uint8)
    _, _, h = bytescan.word_hashes(data)
    assert h[:40].tolist() == h[41:81].tolist() == h[-40:].tolist()


# -- 1 ------------------------------------------------------------------------------


def test_token_counts(spark, docs, empty, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path, cache = public_tokenizers.path(name), str(tmp_path / name)
        model = Tokenizer.from_file(path)
        want = {i: (len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False))) for i, t in DOCS}
        for again in range(2):  # the second time all counts come from the cache
            got = by_id(token_counts.token_counts(docs, path, cache))
            assert {i: (r.n_bytes, r.n_tokens) for i, r in got.items()} == want, (name, again)
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in DOCS})
    assert token_counts.token_counts(empty, path, str(tmp_path / "none")).count() == 0
    assert token_counts.token_counts(docs.unionAll(docs), path, cache).count() == 2 * len(DOCS)


def test_pieces_add_up():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model, count, draw = Tokenizer.from_file(path), token_counts.json_tokenizer(path)(), random.Random(5)
    parts = [*"ab'sdré \n\t \xa0\u3000中1,.!-\x1c\x85", "<|endoftext|>", "'re", " the", "\r\n"]
    for _ in range(2000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        whole = len(model.encode(text, add_special_tokens=False))
        assert count([text]) == [whole]
        cut = token_counts.split_long(text, 7)
        assert "".join(cut) == text and sum(len(model.encode(c, add_special_tokens=False)) for c in cut) == whole


# -- 2 ------------------------------------------------------------------------------

HTML = [
    ("<html><body><nav>Menu</nav><article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four</article><footer>f</footer></body></html>", "A & B one two three four"),
    ("<div class='sidebar'>s</div><main><p>text<br>more</p><aside>x</aside><form>q</form></main>", "text more"),
    ("<body><div id='comments'>c</div><p>plain", "plain"),
    ("<article><p>cut off &amp", "cut off &"),
    ("<article><p>cut <b off", "cut"),
    ("<article><script>var a='</p>'; if (a<b) x();</script><style>p{}</style><p>ok</p><!-- <p>no</p> --></article>", "ok"),
    ("<article><p><b>title<br><p>next</article>", "title next"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><header><h1>Head</h1><span>by me</span></header><p>t</p><section class='reader-comments'>no</section></article>", "Head t"),
    ("<article>one</article><article>two</article>", "one two"), (None, ""), ("", ""), ("no markup", "no markup"), ("<p>" * 3000 + "deep", "deep"), ("<div>" * 100_000 + "deep", "deep"), ("<b>" * 50_000 + "<p>x</p>" * 3 + "<article>" * 20_000, ""), ("<ul><li>" * 30_000 + "x", "x"),
    ("<article><p>main</p><ol class='comment-list'><li>a</li></ol><article class='comment-body'>I am a reader comment</article></article>", "main"), ("<article><p>main</p><div hidden>no</div></article>", "main"),
    ("<div class='elementor-widget widget'><article><p>text</p></article></div>", "text"), ("<article><p>a</p><section id='discussion'>d</section><div class='social-history'>s</div></article>", "a d s"),
    ("<form><div class='x widget'><p>no</p></div><main><p>yes</p></main></form>", "yes"), ("<article><header>x<h1>a<i>b</i></h1>y<h2>c</h2></header>d</article>", "ab c d"),
]


def test_html(spark):
    pages = spark.createDataFrame([(i, f"https://h{i}.example.com/", h, "clash") for i, (h, _) in enumerate(HTML)], "page_id long, url string, html string, host string")
    got = by_id(html_text.extract(pages), "page_id")
    assert {i: r.text for i, r in got.items()} == {i: t for i, (_, t) in enumerate(HTML)}
    assert all(r.n_chars == len(r.text) for r in got.values()) and html_text.extract(pages.limit(0)).count() == 0
    assert html_text.extract(pages.unionAll(pages)).count() == 2 * len(HTML)


def test_templates_go_and_republished_prose_stays(spark):
    rows = []
    for i in range(12):
        own = f"<p>{prose(12)}</p>" if i > 3 else "<p>the same article</p>"
        rows.append((i, "http://a.example.com/x", f"<body><div class='x{i % 2}'>Follow us</div><div>{own}<p>shared words</p></div></body>"))
        rows.append((100 + i, "http://b.example.com/x", f"<article><p>often quoted</p><div><span>Read more here</span></div>{own}</article>"))
    rows.append((200, None, "<body><div>Follow us</div></body>"))
    got = by_id(html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), min_articles=3), "page_id")
    assert all("Follow us" not in got[i].text and "shared words" in got[i].text for i in range(12))
    assert all("Read more" not in got[100 + i].text and "often quoted" in got[100 + i].text for i in range(12))
    assert "the same article" in got[0].text and got[200].text == "Follow us"


def plain_page(rows, min_articles):
    """A plain twin for pages of nested divs without attributes: page -> text, by sets of nested tuples."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.path = [[]]

        def handle_starttag(self, tag, attrs):
            self.path.append([tag])

        def handle_endtag(self, tag):
            done = tuple(self.path.pop())
            self.path[-1].append(done)

        def handle_data(self, data):
            self.path[-1].append(data)

    def below(x):
        return [x, *(z for y in x if isinstance(y, tuple) for z in below(y))]

    def texts(x, gone):
        return [] if x in gone else [x] if isinstance(x, str) else [t for y in x[1:] for t in texts(y, gone)]

    trees = {}
    for i, host, html in rows:
        tree = Tree()
        tree.feed(html)
        trees[i] = host, ("root", *tree.path[0])
    seen = {}
    for host, tree in trees.values():
        article = tuple(sorted(texts(tree, ()), key=lambda t: (-len(t), t))[:2])
        for x in below(tree)[1:]:
            if x[0] == "div":
                seen.setdefault((host, x), set()).add(article)
    return {i: " ".join(texts(tree, {x for (h, x), n in seen.items() if h == host and len(n) >= min_articles})) for i, (host, tree) in trees.items()}


def test_templates_are_found_by_count_alone(spark, monkeypatch):
    """Every tag a div, every name another on each page: menus, footers and side boxes still go, by their counts."""
    draw, rows, want = random.Random(17), [], {}
    sites = {f"s{k}.example.com": [[prose(draw.randint(1, 3), draw) for _ in range(5)] for _ in range(3)] for k in range(3)}
    for i in range(60):
        host = draw.choice(list(sites))
        menu, box, foot = sites[host]
        div = lambda *x: f"<div class='{draw.getrandbits(40):x}'>{''.join(x)}</div>"  # noqa: B023, E731
        own = [prose(draw.randint(15, 30), draw) for _ in range(draw.randint(2, 4))] if i % 20 else ["one article " * 9, "that the site shows twice " * 9]
        list_ = div(*(div(m) for m in menu), div(prose(2, draw))) if i % 3 else div(*map(div, menu))  # some menus name the page, so only their entries recur
        page = list_ + div(*map(div, own[:1]), div(*map(div, box)), *map(div, own[1:])) + div(*map(div, foot))
        rows.append((i, host, page))
        want[i] = " ".join(own)
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", p) for i, h, p in rows], "page_id long, url string, html string")
    got = {i: r.text for i, r in by_id(html_text.extract(frame), "page_id").items()}
    assert got == {i: " ".join(t.split()) for i, t in plain_page(rows, html_text.MIN_ARTICLES).items()}
    boilerplate = {t for site in sites.values() for part in site for t in part}
    assert all(" ".join(want[i].split()[:12]) in t and len(t.split()) - len(want[i].split()) <= 2 for i, t in got.items()) and boilerplate
    monkeypatch.setattr(html_text, "FEW_PAGES", 0)
    assert got == {i: r.text for i, r in by_id(html_text.extract(frame), "page_id").items()}
    with_no_counts = {i: r.text for i, r in by_id(html_text.extract(frame, min_articles=10**9), "page_id").items()}
    assert all(len(with_no_counts[i]) > len(got[i]) for i in got)


def test_templates_do_not_depend_on_the_size_of_their_host(spark):
    rows = [(i, f"http://{host}.example.com/{i}", f"<article><p>{prose(12)}</p>" + ("<div><span>Join our list</span></div>" if i % 1000 < 5 else "") + "</article>") for host, first, n in (("small", 0, 25), ("large", 1000, 200)) for i in range(first, first + n)]
    rows.append((5000, "http://other.example.com/", "<article><p>own</p><div><span>Join our list</span></div></article>"))
    got = by_id(html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert [i for i, r in got.items() if "Join our list" in r.text] == [5000]


# -- 3 ------------------------------------------------------------------------------

PARTS = ["a.b%c@d-e.fr", "@", "a@b", "x@y.z@w.v", " 1.2.3.4", ".5.6.7.8", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (555) 123-4567", "+", "+49.30", " ", "-", ".", "12", "0", "é", "https://u:p@h.com/x", "IBAN DE89370400440532013000", "account no: AB-123456", 'token = "a1b2c3d4e5f6a7b8c9"', "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12))
def test_base_kinds_equal_their_patterns(parts):
    text = "".join(parts)
    spans = pii.find_spans(text, pii.anchors() if not hasattr(pii, "_tests") else pii._tests)
    assert pii.joined([s for s in spans if s[2] in pii.BASE]) == brute.personal(text)


pii._tests = pii.anchors()


def test_added_kinds_and_masking():
    text = "see https://u:p@h.com/x, IBAN DE89370400440532013000, account no: AB-123456 token=\"a1b2c3d4e5f6a7b8c9\" me@x.org"
    spans = pii.find_spans(text, pii._tests)
    assert {k for *_, k in spans} >= {"url", "iban", "account", "secret", "email"}
    masked = pii.mask(text, spans)
    assert "DE89" not in masked and "me@x.org" not in masked and masked.startswith("see [URL]")


def test_cues_in_any_case():
    for cue in ("Customer ID", "CUSTOMER id", "Social Security", "Tax ID", "License No"):
        assert pii.find_spans(f"İ {cue}: AB-123456", pii._tests) == [(4 + len(cue), 13 + len(cue), "account")], cue
    for cue in ("API_Key", "Access_Key", "PassWord"):
        assert pii.find_spans(f"İ {cue}=a1b2c3d4e5f6a7b8c9", pii._tests) == [(3 + len(cue), 21 + len(cue), "secret")], cue


def test_pii_rows(docs, empty):
    got = by_id(pii.find(docs))
    import hashlib

    assert {i: r.base_sha256 for i, r in got.items()} == {i: hashlib.sha256(brute.personal(t).encode()).hexdigest() for i, t in DOCS}
    assert got[8].spans == "" and pii.find(empty).count() == 0
    redacted = pii.redact(docs)
    assert redacted.columns == docs.columns and redacted.count() == len(DOCS)
    assert by_id(redacted)[20].text == "émail à [EMAIL]" and by_id(redacted)[8].text is None


# -- 4 ------------------------------------------------------------------------------


def test_leaks(spark, docs, empty):
    items = [(0, PASSAGE), (1, prose(30)), (2, None), (3, "too short"), (4, PASSAGE), (5, ""), (6, BASE)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    draw = random.Random(3)
    changed = [(100 + i, prose(30, draw) + " " + near(PASSAGE, 0.12, draw) + " " + prose(9, draw)) for i in range(40)]
    more = docs.select("doc_id", "text").unionAll(spark.createDataFrame(changed, "doc_id long, text string"))
    want = set()
    for d, t in [*DOCS, *changed]:
        for i, item in items:
            w = brute.words(item)
            if len(w) >= decontamination.MIN_WORDS and brute.edit_distance(w, brute.words(t)) <= len(w) // decontamination.EDIT_SHARE:
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(more, benchmark).collect()}
    assert got <= want and len(got) >= 0.98 * len(want) and {(6, 0), (7, 0), (6, 4), (0, 6), (2, 6)} <= got
    assert decontamination.leaks(empty, benchmark).count() == 0 and decontamination.leaks(docs, benchmark.limit(0)).count() == 0
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in DOCS} - {d for d, _ in got}


def test_blocks_of_items_one_after_another(spark, docs, monkeypatch):
    items = [(i, prose(30, random.Random(i))) for i in range(20)] + [(99, PASSAGE)] * 3
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits, kept = sorted(decontamination.leaks(docs, benchmark).collect()), sorted(decontamination.clean(docs, benchmark).collect(), key=str)
    assert {h.item_id for h in hits} == {99}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 1000)
    assert len(list(decontamination._blocks(benchmark, "item_id", "text"))) > 2
    assert sorted(decontamination.leaks(docs, benchmark).collect()) == hits and sorted(decontamination.clean(docs, benchmark).collect(), key=str) == kept


def test_short_items_and_scripts_without_spaces(spark):
    question = "東京の人口は何人ですか。また、面積はどのくらいですか"
    items = [(0, "What is 2 + 2?"), (1, question), (2, "two words"), (3, "ประเทศไทยมีกี่จังหวัด"), (4, "word")]
    docs = [(0, "so: what is 2+2 then"), (1, "what is 2 + 3?"), (2, "前置き" + question.replace("何", "幾") + "後書き"), (3, "東京の天気は晴れです"), (4, "two words word"), (5, "xประเทศไทยมีกี่จังหวัดx"), (6, None), (0, "so: what is 2+2 then")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lowered", F.lit(1)).withColumn("_lowered", F.lit(1)).withColumn("key", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontamination.leaks(frame, benchmark).collect()) == [(0, 0), (0, 0), (2, 1), (5, 3)]
    kept = decontamination.clean(frame, benchmark)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6]


def test_words_are_those_of_plain_python():
    for text in ("a b", "Ünï 1x-y", "東京 tower。とう", "", " ", "ไทย", "x東y", "𠀀𠀁a", "\u3000"):
        want = brute.words(text)
        got = decontamination.words_of(np.frombuffer(text.lower().encode(), np.uint8)).tolist()
        assert len(got) == len(want) and len(set(got)) == len(set(want)), text


def test_windows_at_run_clusters_lose_nothing(monkeypatch):
    """All windows of the item's size, at every word, give the same leaks as those laid out from shared runs."""
    draw = random.Random(41)
    words = [np.array([draw.getrandbits(63) for _ in range(n)], np.uint64) for n in (3, 5, 9, 14, 30, 59, 120)]
    texts = [" ".join(f"w{w}" for w in x.tolist()).encode() for x in words]
    items = decontamination.Items(list(range(len(texts))), texts, decontamination.tables_needed(list(range(len(texts))), texts))
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(3):
            own = items.words[draw.randrange(len(texts))]
            parts += [np.array([draw.getrandbits(63) for _ in range(draw.randint(0, 20))], np.uint64), decontamination.edited(own, draw.randint(0, max(1, len(own) // 4)), draw)]
        docs.append(np.concatenate(parts))
    seeded = [{k for k, *_ in items.hits(d)} for d in docs]

    def everywhere(self, text):
        pairs = [(s, n) for n in sorted(set(self.sizes.tolist())) for s in range(max(1, len(text)))]
        return np.array(pairs, np.int64).T

    monkeypatch.setattr(decontamination.Items, "windows", everywhere)
    every = [{k for k, *_ in items.hits(d)} for d in docs]
    exact = [{k for k, w in enumerate(items.words) if brute.edit_distance(w.tolist(), d.tolist()) <= decontamination.limit(len(w))} for d in docs]
    assert all(a <= b for a, b in zip(every, exact, strict=True)) and sum(map(len, exact)) > 60
    assert sum(map(len, seeded)) >= sum(map(len, every)) and sum(map(len, seeded)) >= 0.99 * sum(map(len, exact))


def test_tables_that_never_reach_the_recall_are_an_error(monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_TABLES", 2)
    with pytest.raises(RuntimeError, match="simulated"):
        decontamination.tables_needed([1], [prose(40).encode()])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=20))
def test_bit_parallel_edit_distance(pattern, text):
    masks = decontamination.bit_masks(np.array(pattern, np.uint64))
    assert decontamination.edit_distance(masks, len(pattern), text) == brute.edit_distance(pattern, text)


# -- 5 ------------------------------------------------------------------------------


def check_repeats(spark, docs, **kw):
    got = by_id(substring_dedup.dedup(docs.select("doc_id", "text")))
    want = brute.repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == want


def test_repeats(spark, docs, empty):
    check_repeats(spark, docs)
    assert substring_dedup.dedup(empty).count() == 0 and substring_dedup.dedup(docs.unionAll(docs)).count() == 2 * len(DOCS)


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeats_of_common_lines(spark, monkeypatch, hot):
    """A line in every document, whole copies, repeats inside a document; in buckets refined in a task or by aggregation."""
    monkeypatch.setattr(substring_dedup, "HOT_MEMBERS", hot)
    draw = random.Random(8)
    line, rows = prose(30, draw), []
    for i in range(60):
        own = prose(draw.randint(5, 60), draw)
        rows.append((i, draw.choice([own + "\n" + line + "\n" + prose(9, draw), line + own + line, own, line[draw.randint(0, 40) :] + own, "ab" * 120 + own, rows[-1][1] if rows else own])))
    check_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_buckets_are_refined_alike_in_small_steps(monkeypatch):
    import pyarrow as pa

    draw, common = random.Random(4), prose(60).encode()
    rows = sorted((draw.randint(0, 5), d, 68, 68, prose(9, draw).encode()[:40].ljust(40) + common[:128]) for d in range(200))
    batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["gram", "doc", "at", "left", "around"])

    def removed(step):
        monkeypatch.setattr(substring_dedup, "AT_ONCE", step)
        out = set()
        for found in substring_dedup._refine(iter([batch.slice(i, 3) for i in range(0, 200, 3)])):
            for d, lo, hi in zip(*(c.to_pylist() for c in found.columns), strict=True):
                out |= {(d, p) for p in range(lo, hi)}
        return out

    assert removed(5) == removed(1000) != set()


def test_bucket_identifiers_tell_suffixes_apart():
    data = np.frombuffer((prose(400) + "ab" * 200 + prose(50)).encode() * 2, np.uint8)
    for size in (8, 16, 32, 64):
        found = substring_dedup.buckets(data, size)
        want = {}
        for i, h in enumerate(found.tolist()):
            assert want.setdefault(data[i : i + size].tobytes(), h) == h
        assert len(set(found.tolist())) == len(want)


def test_buckets_over_the_edges_of_tasks(spark, many_tasks):
    """Anchors of one bucket and of one neighbourhood dealt to many tasks: what each task can't know is settled after them."""
    draw = random.Random(14)
    line = prose(30, draw)
    rows = [(i, (prose(3, draw) + " " if i % 3 else "") + line + (" " + prose(4, draw) if i % 2 else "")) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    check_repeats(spark, df)


def test_repeated_and_null_keys(spark):
    draw = random.Random(15)
    a, b = prose(40, draw), prose(40, draw)
    rows = [(5, a), (5, b), (5, a), (7, a + b), (None, a), (None, a), (-1, b)]
    got = {(r.doc_id, r.n_bytes): r for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[-1, len(b)].n_removed == 0 and got[5, len(b)].n_removed == len(b) and got[5, len(a)].n_removed == 0 and got[None, len(a)].n_removed == 0
    assert got[7, len(a + b)].n_removed == len(a + b) and got[7, len(a + b)].n_spans == 1
    with pytest.raises(ValueError, match="integer"):
        substring_dedup.dedup(spark.createDataFrame([("x", "y")], "doc_id string, text string"))


def test_anchors_of_long_texts_are_those_of_short_ones(monkeypatch):
    data = np.frombuffer(prose(3000).encode(), np.uint8)
    whole = [x.tolist() for x in substring_dedup.anchors(data)]
    monkeypatch.setattr(substring_dedup, "PIECE", 777)
    assert [x.tolist() for x in substring_dedup.anchors(data)] == whole


# -- 6 ------------------------------------------------------------------------------


def test_rules(docs, empty):
    for _, t in DOCS:
        w = brute.WORD.findall(t or "")
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)} if len(w) < 4000 else None
        lines = [x for x in (t or "").split("\n") if brute.WORD.search(x)]
        got = quality_rules.count_rules(np.frombuffer((t or "").encode(), np.uint8))
        assert got[:4] == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)))
        assert covered is None or got[4] == len(covered)
    assert quality_rules.judge(empty).count() == 0
    got = by_id(quality_rules.judge(docs))
    assert len(got) == len(DOCS) and not got[8].kept and got[0].base_failed is False
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_bad_hosts_are_rejected_and_small_ones_are_shrunk(spark):
    draw = random.Random(2)
    rows = [(i, prose(40, draw) if i % 20 else "bad", "good") for i in range(100)] + [(200 + i, "bad" if i % 20 else prose(40, draw), "awful") for i in range(100)]
    rows += [(400 + i, prose(40, draw) if i % 10 else "bad", f"g{i % 7}") for i in range(70)] + [(500, "bad", None), (501, prose(40, draw), None)]
    got = by_id(quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert not got[220].kept and not got[220].base_failed and got[1].kept and got[501].kept


# -- 7 ------------------------------------------------------------------------------


def test_languages(spark):
    draw, rows = random.Random(4), []
    for i in range(300):
        lang = "abc"[i % 3]
        letters = {"a": "aeioust", "b": "éàçlmn", "c": "ßüökrg"}[lang]
        text = " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(draw.randint(1, 60)))
        rows.append((i, text, lang))
    rows += [(900, None, "a"), (901, "123 !?", "a"), (902, "", None), (903, rows[0][1] + " " + rows[1][1][:9], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    out = language_mixture.held_out(F.col("doc_id"))
    got = by_id(language_mixture.predict(df, language_mixture.train(df.filter(~out))))
    held = {r.doc_id for r in df.filter(out).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows[:300] if i in held) >= 0.95 * sum(i < 300 for i in held)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    assert language_mixture.train(df.limit(0)) is None
    assert {r.lang_pred for r in language_mixture.predict(df, None).collect()} == {"und"}


def plain_language(text, words_of):
    """The mixture of one text by plain loops over log-likelihoods of its words: language -> proportion, best first."""
    import math

    like = [words_of(w) for w in text]
    k = len(like[0])

    def fit(langs, rounds):
        share = {j: 1 / len(langs) for j in langs}
        for _ in range(rounds if len(langs) > 1 else 0):
            total = dict.fromkeys(langs, 0.0)
            for row in like:
                top = max(row[j] for j in langs)
                p = {j: share[j] * math.exp(row[j] - top) for j in langs}
                for j in langs:
                    total[j] += p[j] / sum(p.values())
            share = {j: total[j] / len(like) for j in langs}
        value = sum(max(row[j] for j in langs) + math.log(sum(share[j] * math.exp(row[j] - max(row[i] for i in langs)) for j in langs)) for row in like)
        return share, value

    first = max(range(k), key=lambda j: (sum(row[j] for row in like), -j))
    rough, _ = fit(list(range(k)), 4)
    order = [first, *sorted((j for j in range(k) if j != first), key=lambda j: (-rough[j], j))]
    share, value = fit(order[:1], 0)
    for size in range(2, k + 1):
        more, reached = fit(order[:size], language_mixture.ROUNDS)
        if reached - value <= language_mixture.PENALTY * math.log(len(like) + 1):
            break
        share, value = more, reached
    return max(share, key=lambda j: (share[j], -j)), max(share.values())


def test_mixtures_equal_plain_loops(spark):
    """Counting, smoothing, likelihoods and the choice of languages, against loops over a dictionary of trigrams."""
    import math
    from collections import Counter

    draw = random.Random(23)
    vocabulary = {lang: ["".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(60)] for lang, letters in (("a", "aeioust"), ("b", "aeiklmn"), ("c", "uorkstn"))}
    rows = [(i, " ".join(draw.choice(vocabulary["abc"[i % 3]]) for _ in range(draw.randint(1, 40))), "abc"[i % 3]) for i in range(90)]
    mixed = [(100 + i, " ".join(draw.choice(vocabulary[draw.choice("ab" if i % 2 else "abc")]) for _ in range(50)), None) for i in range(20)]
    model = language_mixture.train(spark.createDataFrame([*rows, *rows[:9]], "doc_id long, text string, lang string"))

    def grams(word):
        b = b" " + word.encode().lower() + b" "
        return [((b[i] | b[i + 1] << 8 | b[i + 2] << 16) * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for i in range(len(b) - 2)]

    counts = {lang: Counter() for lang in "abc"}
    for _, text, lang in [*rows, *rows[:9]]:
        for w in text.split():
            counts[lang].update(grams(w))
    every = sum(counts.values(), Counter())
    n, size, a = sum(every.values()), language_mixture.BUCKETS, language_mixture.SMOOTHING
    log = lambda lang, g: math.log((1 - a) * counts[lang][g] / sum(counts[lang].values()) + a * ((1 - a) * every[g] / n + a / size))
    got = by_id(language_mixture.predict(spark.createDataFrame([*rows, *mixed, *[(200 + i, *r[1:]) for i, r in enumerate(mixed[:2])]], "doc_id long, text string, lang string"), model))
    for i, text, _ in [*rows, *mixed]:
        at, share = plain_language(text.split(), lambda w: [sum(log(lang, g) for g in grams(w)) for lang in "abc"])
        assert got[i].lang_pred == "abc"[at] and abs(got[i].score - share) < 2e-3, i
    assert got[200].lang_pred == got[100].lang_pred and got[200].score == got[100].score


def test_languages_at_the_edges(spark, monkeypatch):
    model = language_mixture.train(spark.createDataFrame([(1, "der die das und", "de"), (2, "the and of it", "en")], "doc_id long, text string, lang string"))
    rows = [(None, "der und", "x"), (3, "der und", None), (3, "der und", None), (4, "the and " * 40_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("key", F.lit(1)).withColumn("lang_pred", F.lit(1))
    whole = language_mixture.predict(frame, model).collect()
    assert [(r.doc_id, r.lang_pred) for r in sorted(whole, key=lambda r: (r.doc_id or 0))] == [(None, "de"), (3, "de"), (3, "de"), (4, "en")]
    monkeypatch.setattr(language_mixture, "PIECE_WORDS", 77)
    pieces = language_mixture.predict(frame, model).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, pieces))
    assert language_mixture.predict(frame.limit(0), model).count() == 0
    monkeypatch.setattr(language_mixture, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="no bound"):
        language_mixture.train(frame.withColumn("lang", F.col("text")))


def test_mixtures():
    draw = np.random.default_rng(1)
    like = np.log(np.where(draw.random((400, 1)) < 0.7, [[0.9, 0.05, 0.05]], [[0.05, 0.9, 0.05]]))
    at, share = language_mixture.choose(like)
    assert at == 0 and 0.6 < share < 0.85
    assert language_mixture.choose(np.log(np.full((50, 2), 0.5))) == (0, 1.0)


# -- 8 ------------------------------------------------------------------------------


def test_mixing(spark, docs, empty):
    draw = random.Random(6)
    rows = [(i, prose(draw.randint(1, 40), draw), draw.choice(["en", "de", None]), draw.choice(["src0", "src0", "src0", "src1", "src5", "site"])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = source_mixing.mix(df, budget_percent=60, max_epochs=2).collect()
    keys = [(r.doc_id, r.epoch) for r in got]
    assert len(keys) == len(set(keys))
    total = sum(len(t.split()) for _, t, _, _ in rows)
    assert 0.95 * 0.6 * total < sum(r.n_tokens for r in got) <= 0.6 * total
    assert source_mixing.mix(empty).count() == 0 and source_mixing.mix(docs).count() >= 0
    mixed = source_mixing.mixed(df.withColumn("epoch", F.lit("clash")), budget_percent=60)
    assert sorted((r.doc_id, r.epoch) for r in mixed.collect()) == sorted(keys) and "text" in mixed.columns


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("x", "en", "s1", 10), ("x", "en", "s2", 1000), ("x", "de", "s3", 1000), ("y", "en", "s4", 1000)], "domain string, lang string, source string, available long")
    got = {r.source: r.budget for r in source_mixing.leaf_budgets(leaves, {}, 50, 1).collect()}
    # 1505 in all: 752 for each domain; x: 376 for each language; s1 gives 10, its sibling s2 the rest of 376.
    assert got == {"s1": 10, "s2": 366, "s3": 376, "s4": 752}


@pytest.mark.parametrize("seed, percent, epochs", [(1, 50, 2), (2, 97, 1), (3, 10, 2), (4, 100, 1), (5, 0, 1)])
def test_budgets_equal_plain_ones(spark, seed, percent, epochs):
    draw = random.Random(seed)
    weights = {"domain": {"d1": 3}, "lang": {"en": 7, "de": 2}, "source": {"s7": 5, "s8": 900}}
    amount = lambda: draw.choice([1, 2, 3, 50, 50, 50, draw.randint(1, 10**4), draw.randint(1, 10**9)])  # noqa: E731 - ties and wide gaps
    rows = {(d, lang, f"s{s}"): amount() for d in ("d0", "d1", "d2") for lang in ("en", "de", "fr") for s in range(draw.randint(1, 300))}
    leaves = spark.createDataFrame([(*k, n) for k, n in rows.items()], "domain string, lang string, source string, available long")
    got = {(r.domain, r.lang, r.source): r.budget for r in source_mixing.leaf_budgets(leaves, weights, percent, epochs).collect()}
    assert got == brute.budgets(rows, [weights[level] for level in source_mixing.LEVELS], sum(rows.values()) * percent // 100, epochs)


def test_budgets_of_very_many_tokens_and_sources(spark):
    leaves = spark.range(50_000).select(F.lit("d").alias("domain"), F.lit("en").alias("lang"), F.col("id").cast("string").alias("source"), (F.lit(10**13) + F.col("id")).alias("available"))
    budgets = source_mixing.leaf_budgets(leaves, {}, 50, 1)
    total = sum(range(50_000)) + 50_000 * 10**13
    assert {r.budget for r in budgets.collect()} == {total // 2 // 50_000}


# -- 9 ------------------------------------------------------------------------------

URLS = [
    ("http://EXAMPLE.com/en/5", "example.com", "/en/5", "com/en/", "block"), ("http://a.example.com/en/77?x=/", "a.example.com", "/en/77", "example.com/en/7", "allow"), ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
    ("x://b.net/de/8", "b.net", "/de/8", "net/de/", "allow"), ("x://example.net/de/8#a", "example.net", "/de/8", "example.net/de/8", "block"), ("://org/es/", "org", "/es/", "org/es/", "block"), ("//x.org/es/", "", "", None, "allow"),
    (None, "", "", None, "allow"), ("http://x.org", "x.org", "", None, "allow"), ("http://h?q#f", "h", "", None, "allow"), ("http://ÄB.org/a\nb", "Äb.org", "/a\nb", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = by_id(url_filters.judge(pages, labels), "page_id")
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(URLS))] == [u[1:] for u in URLS]
    assert url_filters.judge(pages.limit(0), labels).count() == 0 and url_filters.judge(pages.unionAll(pages), labels).count() == 2 * len(URLS)


def test_mined_rules_block(spark):
    draw = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        spam = i % 4 == 0
        rows.append((i, f"https://{'win.casino' if spam else draw.choice(['a', 'b', 'c'])}.example.org/{'play' if spam else draw.choice(['x', 'y'])}/{i}?utm=1"))
        if i < 300:
            labels.append((i, 1, int(spam)))
    got = by_id(url_filters.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), "page_id")
    assert all((r.verdict == "block") == (i % 4 == 0) for i, r in got.items())


@pytest.mark.parametrize("bad, good", [("/en/forum/casino/{i}", "/en/forum/{w}/{i}"), ("/{w}/en/a/casino", "/{w}/en/a/{w}"), ("/en/forum?kind=casino&n={i}", "/en/forum?kind={w}&n={i}"), ("/b/c/d/e/f/g/h/i/j/k/l/m/n/casino/{i}", "/b/c/d/e/f/g/h/i/j/k/l/m/n/{w}/{i}")])
def test_rules_are_mined_at_any_depth(spark, bad, good):
    draw, rows, labels = random.Random(10), [], []
    for i in range(400):
        spam = i % 4 == 0
        rows.append((i, "https://a.example.org" + (bad if spam else good).format(i=i, w=draw.choice(["news", "help", "talk"]))))
        if i < 300:
            labels.append((i, 1, int(spam)))
    got = by_id(url_filters.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), "page_id")
    assert all((r.verdict == "block") == (i % 4 == 0) for i, r in got.items())


def plain_tokens(url):
    """The tokens of a URL, by plain string work."""
    scheme, _, rest = (url or "").partition("://")
    if "://" not in (url or ""):
        return set()
    authority = rest.split("#")[0].split("?")[0].split("/")[0]
    host, tail = authority.lower(), rest[len(authority) :].split("#")[0]
    path, _, query = tail.partition("?")
    if not host:
        return set()
    out = {"scheme=" + scheme.lower()} | {"host=" + ".".join(host.split(".")[i:]) for i in range(len(host.split(".")))}
    digits = lambda s: "".join("0" if c.isdigit() and (not i or not s[i - 1].isdigit()) else c for i, c in enumerate(s) if not (c.isdigit() and i and s[i - 1].isdigit()))
    for i, part in enumerate(x for x in path.split("/") if x):
        out |= {f"path{i}={digits(part)}", f"path={digits(part)}"}
    for part in query.split("&"):
        out |= {"query=" + part, "query=" + part.split("=")[0]} if part else set()
    return out


def test_mined_rules_equal_all_combinations(spark):
    """Support and confidence counted over every combination of tokens: the pages that a rule of enough of both matches are blocked."""
    from itertools import combinations

    draw, rows, labels = random.Random(12), [], []
    for i in range(500):
        a, b, c = draw.choice("pqr"), draw.choice("xyz"), draw.choice(["k=1", "k=2", "m=1"])
        rows.append((i, f"http://{draw.choice('st')}.org/{a}/{b}?{c}"))
        if i < 350:
            chance = 0.95 if (a, c) == ("p", "k=1") else 0.85 if b == "z" and c == "m=1" else 0.3
            labels.append((i, 1, int(draw.random() < chance)))
    rows += [(900, None), (None, "http://s.org/p/x?k=1"), (901, "http://s.org/p/x?k=1"), (901, "http://s.org/p/x?k=1")]
    support, confidence, pages = 0.02, 0.8, 10
    bags = {i: plain_tokens(u) for i, u in rows if i is not None}
    seen = [(bags[i], bool(bad)) for i, _, bad in labels]
    every = sorted(set().union(*(b for b, _ in seen)))
    least = max(support * len(seen), pages)
    rules = []
    for size in (1, 2, 3, 4):
        for some in combinations(every, size):
            own = [bad for bag, bad in seen if bag.issuperset(some)]
            if sum(own) >= least and sum(own) >= confidence * len(own):
                rules.append(set(some))
    assert rules
    want = {i: "block" if any(bag >= r for r in rules) else "allow" for i, bag in bags.items()}
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("tokens", F.lit("clash"))
    got = url_filters.judge(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rules=(), min_support=support, min_pages=pages, min_confidence=confidence).collect()
    assert len(got) == len(rows) and {"block", "allow"} <= set(want.values())
    assert all(r.verdict == want[r.page_id] for r in got if r.page_id is not None) and [r.verdict for r in got if r.page_id is None] == [want[901]]


# -- 10 -----------------------------------------------------------------------------


@pytest.mark.parametrize("k", [2, 5])
def test_groups(docs, empty, k):
    got = by_id(near_duplicates.groups(docs, k))
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute.groups(DOCS, k)
    assert all(r.kept == (d == r.component_id) for d, r in got.items())
    assert near_duplicates.groups(empty, k).count() == 0 and near_duplicates.groups(docs.unionAll(docs), k).count() == 2 * len(DOCS)
    kept = near_duplicates.keep_first(docs, k)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


@pytest.mark.parametrize("leaders", [1024, 100, 12])
def test_groups_of_many_copies(spark, monkeypatch, leaders):
    """A star of near copies, some linked only to its centre, in one task or dealt to many; no link is lost."""
    monkeypatch.setattr(near_duplicates, "REGION_LEADERS", leaders)
    draw = random.Random(12)
    centre = prose(150, draw)
    rows = [(1000 - i, near(centre, 0.045, draw)) for i in range(140)] + [(5, centre), (6, centre)] + [(2000 + i, prose(60, draw)) for i in range(60)]
    got = by_id(near_duplicates.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2))
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute.groups(rows, 2)


def test_leaves_over_the_edges_of_tasks(spark, many_tasks):
    draw = random.Random(33)
    rows = []
    for i in range(12):
        text = prose(60, draw)
        rows += [(i, text), (100 + i, text + " end")]
    got = by_id(near_duplicates.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2))
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute.groups(rows, 2)


def test_pairs_just_over_the_limit_among_much_boilerplate(spark, monkeypatch):
    """Pairs of 0.80 to 0.83 in a background of 0.6 to 0.7, where leaves are large and most of their pairs aren't links."""
    monkeypatch.setattr(near_duplicates, "REGION_LEADERS", 30)
    draw = random.Random(31)
    page, rows = prose(160, draw).split(" "), []
    for i in range(120):
        words = list(page)
        for _ in range(16):
            words[draw.randrange(160)] = draw.choice(VOCABULARY) + str(i)
        rows.append((i, " ".join(words)))
        for _ in range(8):
            words[draw.randrange(160)] = draw.choice(VOCABULARY) + "x" + str(i)
        rows.append((1000 + i, " ".join(words)))
    got = by_id(near_duplicates.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2))
    want = brute.groups(rows, 2)
    assert 60 < sum(d != c for d, (_, c) in want.items()) and len({c for _, c in want.values()}) > 60
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want


@pytest.mark.parametrize("leaders", [1024, 60])
def test_leaves_that_overlap_are_compared_as_one(spark, monkeypatch, leaders):
    """Every pair of a leaf still meets in a region, leaves that share one document only are kept apart, and fewer rows are dealt."""
    monkeypatch.setattr(near_duplicates, "REGION_LEADERS", leaders)
    draw = random.Random(34)
    leaves = [[d for d in range(200) if draw.random() < 0.9] for _ in range(40)]
    hub = spark.range(1000, 2000).orderBy(F.xxhash64("id")).first().id
    apart = [[hub, *range(2000 + 30 * i, 2030 + 30 * i)] for i in range(12)]
    label = {d: 0 if d < 100 else d for leaf in leaves + apart for d in leaf}
    rows = [(i, d, 50, None, 0) for i, leaf in enumerate(leaves + apart) for d in leaf]
    places = spark.createDataFrame(rows, "leaf long, doc long, n long, before long, common int")
    found = spark.createDataFrame([(d, 0) for d in range(100)], "node long, component long")
    got, where = near_duplicates._blockwise(places, found).collect(), {}
    for r in got:
        assert r.label == label[r.doc]
        where.setdefault(r.doc, set()).add(r.region)
    assert all(label[a] == label[b] or where[a] & where[b] for leaf in leaves + apart for a in leaf for b in leaf)
    assert max(sum(r.region == x and r.doc >= 1000 for r in got) for x in where[hub]) <= 31
    assert sum(r.doc < 1000 for r in got) < sum(map(len, leaves)) / 2


def test_next_neighbours_are_untried_and_of_other_components(spark):
    places = spark.createDataFrame([(0, 1, 9, None, 0), (0, 2, 9, 1, 9), (0, 3, 9, 2, 7), (0, 4, 9, 3, 8), (1, 1, 9, None, 0), (1, 3, 9, 1, 6)], "leaf long, doc long, n long, before long, common int")
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    first = {tuple(r) for r in near_duplicates._nearest(places).collect()}
    assert first == {(1, 2), (3, 4)}
    found, tried = frame([(1, 1), (2, 1)], "node long, component long"), frame(sorted(first), "a long, b long")
    assert {tuple(r) for r in near_duplicates._nearest(places, found, tried).collect()} == {(1, 3), (2, 3)}


def test_keys_of_several_texts_are_one_document(spark):
    draw = random.Random(32)
    a, b = prose(60, draw), prose(60, draw)
    rows = [(1, a), (2, a + " end"), (2, b), (3, b + " end"), (None, a), (4, prose(30, draw)), (2, b)]
    out = near_duplicates.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((r.doc_id, r.component_id) for r in out if r.doc_id) == [(1, 1), (2, 1), (2, 1), (2, 1), (3, 1), (4, 4)]
    clash = spark.createDataFrame([(1, a, "c"), (2, a, "c")], "doc_id long, text string, kept string").withColumn("KEY", F.lit(1)).withColumn("_kept", F.lit(1))
    assert [r.doc_id for r in near_duplicates.keep_first(clash).collect()] == [1]
    with pytest.raises(ValueError, match="integer"):
        near_duplicates.groups(spark.createDataFrame([("x", "y")], "doc_id string, text string"))


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(draw.randint(200, 260), draw.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges for x in e if e[0] != e[1]}


def test_components_joined_by_more_edges(spark):
    first, more = [(1, 2), (3, 4), (5, 6), (9, 8)], [(2, 4), (6, 7), (10, 11), (1, 2), (12, 8)]
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    found = components.components(frame(first))
    got = {r.node: r.component for r in components.joined(found, frame(more)).collect()}
    assert got == {r.node: r.component for r in components.components(frame(first + more)).collect()}
    assert components.joined(found, frame([(1, 2)])).count() == found.count() == 8
