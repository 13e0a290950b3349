"""The training-data operators against brute force on small rows: nulls, empty and long texts, ties, repeats, clashing columns, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnloom.llm import decontamination, fingerprints, html_text, kernel, language_model, mixing, near_dedup, quality, substring_dedup, token_codec, token_output, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall(text or "")


def corpus(n=60, seed=3):
    """Random texts with exact and near copies, a shared passage, odd rows and one long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnoé") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = text(60)
    rows = [(i, text(rng.randint(1, 160)).capitalize()) for i in range(n)]
    base = text(120).split()
    for i in range(n, n + 12):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    rows += [(n + 20 + i, rows[i][1]) for i in range(5)] + [(n + 30 + i, f"{text(20)}\n{passage}\t{text(9)}") for i in range(4)]
    rows += [(n + 40, None), (n + 41, ""), (n + 42, "   \n\t"), (n + 43, "One two"), (n + 44, "one TWO"), (n + 45, "x" * 5000), (n + 46, text(30_000)), (n + 47, "a\x0bb\x0cc\xa0d\x1ce")]
    return [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None]), len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return rows, spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("bucket", F.lit(1)).withColumn("key", F.lit(2)).withColumn("id", F.lit(3)).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_kernel_matches_plain_words():
    texts = [t for _, t, *_ in corpus()]
    data, offsets = kernel.text_buffers(pa.array(texts, pa.string()))
    hashes, first = kernel.word_hashes(data, offsets, lower=True)
    seen = {}
    plain = [words((t or "").translate(LOWER)) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in plain]
    for w, h in zip([w for ws in plain for w in ws], hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    grams, at = kernel.shingles(hashes, first, 5)
    assert np.diff(at).tolist() == [len(w) - 4 if len(w) >= 5 else min(len(w), 1) for w in plain]
    assert np.array_equal(kernel.gram_hashes(hashes, 50)[:100], kernel.gram_hashes(hashes[:149], 50))


def test_url_parts_rules_and_model(spark):
    urls = [None, "no scheme/x", "http://WWW.Example.COM/en/1?q#f", "x://a.example.com/en/", "https://b.net/es/é?x", "y://://z", "http://casino-free-bets.org/win", "http://blog.therin.org/en/2", "http://com/", "http://xcom/", "http://"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    made = {r.page_id: r for r in url_filter.judge(pages, url_filter.RULES, url_filter.train(spark)).collect()}
    assert [(made[i].host, made[i].path) for i in (0, 1, 2, 5, 10)] == [("", ""), ("", ""), ("www.example.com", "/en/1"), (":", "//z"), ("", "")]
    assert [(made[i].rule, made[i].verdict) for i in (2, 3, 4, 8)] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("net/es/", "block"), ("com/", "allow")]
    assert [made[i].rule for i in (0, 6, 7, 9)] == [None] * 4
    assert (made[6].verdict, made[7].verdict) == ("block", "allow")
    model = url_filter.train(spark, rounds=2)
    known = set(url_filter.seed_urls())
    fresh = [x for x in url_filter.seed_urls(5) + url_filter.seed_urls(11) if x not in known]  # other pairs of the words
    held = spark.createDataFrame(fresh, "url string, label int").withColumn("page_id", F.monotonically_increasing_id()).cache()
    right = url_filter.judge(held, [], url_filter.train(spark)).join(held, "page_id").where((F.col("verdict") == "block") == (F.col("label") == 1)).count()
    assert len(fresh) > 250 and right >= 0.95 * len(fresh) and len(model["weights"]) == url_filter.BUCKETS
    assert url_filter.judge(pages.where("false"), url_filter.RULES, model).isEmpty()
    many = url_filter.RULES + [(f"h{i}.example.com/p{i % 7}/", "block") for i in range(2000)] + [("com/de/", "block"), ("com/de/", "allow"), ("blog.therin.org/en/", "block")]
    more = pages.unionByName(spark.createDataFrame([(100 + i, f"http://a.h{i}.example.com/p{i % 7}/x", "") for i in range(0, 50, 7)] + [(200, "http://www.x.com/de/1", ""), (201, None, "")], "page_id bigint, url string, host string"))
    joined = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(more, many, model).collect()}
    plain = {}
    for r in more.select("page_id", url_filter.host_of(F.col("url")).alias("h"), url_filter.path_of(F.col("url")).alias("p")).collect():
        fits = [(len(x), x.index("/"), a, x) for x, a in many if (r.h == x[: x.index("/")] or r.h.endswith("." + x[: x.index("/")])) and r.p.startswith(x[x.index("/") :])]
        plain[r.page_id] = max(fits)[3:1:-1] if fits else None
    assert {i: x for i, x in joined.items() if x[0]} == {i: x for i, x in plain.items() if x} and joined.keys() == plain.keys()


def test_fingerprints(spark, docs, nothing):
    rows, df = docs
    made = {r.doc_id: r for r in fingerprints.next_documents(df).mapInArrow(fingerprints._neighbours, fingerprints.SCHEMA).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    sets = lambda t: {tuple(w[i : i + 5]) for w in [words((t or "").translate(LOWER))] for i in range(len(w) - 4)} or ({tuple(w)} if (w := words((t or "").translate(LOWER))) else set())
    errors = []
    for k, (i, t, *_) in enumerate(order):
        own, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(own) // 3
        edited = own[: len(own) - cut] + after[:cut]
        assert (made[i].n_chars, made[i].edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        a, b = sets(own), sets(edited)
        errors.append(made[i].near_edited - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.abs(errors).max() < 0.15 and np.abs(errors).mean() < 0.03
    assert made[0].fingerprint == made[80].fingerprint and made[103].fingerprint == made[104].fingerprint
    assert made[100].fingerprint == "" and fingerprints.next_documents(nothing).isEmpty()
    one = fingerprints.next_documents(spark.createDataFrame([(None, "a b", None, None, 3)], DOCS)).mapInArrow(fingerprints._neighbours, fingerprints.SCHEMA).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(None, 1.0)]


def test_fingerprints_of_rows_without_ids(spark):
    """Rows without ids and with equal ids are spread over ranges, and each is compared with the one after it."""
    rng = random.Random(2)
    rows = [(None, " ".join(str(rng.randrange(50)) for _ in range(rng.randint(5, 30)))) for _ in range(300)] + [(i // 3, f"row {i} of many words {i % 7}") for i in range(90)] + [(None, "same")] * 20
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    laid = fingerprints.next_documents(df)
    assert laid.where("late = 0").groupBy("bucket").count().agg(F.max("count")).first()[0] < 120
    made = laid.mapInArrow(fingerprints._neighbours, fingerprints.SCHEMA).collect()
    hashed = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]], r[1]), reverse=True)
    plain = []
    for k, (i, t) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(t) // 3
        plain.append((str(i), len(t), hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in made) == sorted(plain)


def test_densified_bins_agree_like_the_sets():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 2**63, 40, dtype=np.uint64)
    low = []
    for part in (grams[:30], grams[10:]):  # similarity 0.5 with most bins empty
        table = np.full((1, fingerprints.BINS), fingerprints._EMPTY)
        np.minimum.at(table[0], (part >> fingerprints._SHIFT).astype(np.int64), part << fingerprints._LEFT)
        low.append(fingerprints.densify(table)[0])
    assert (low[0] != fingerprints._EMPTY).all() and abs((low[0] == low[1]).mean() - 0.5) < 0.2


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", ""), ("a &amp; b", "a & b"), ("<p>a<p>b", "a\n\nb"), ("<ul><li>x<li>y</ul>", "- x\n- y"), ("<ol start=3><li>x<li>y<ul><li>z</ul></ol>", "3. x\n4. y\n   - z"),
        ("<table><tr><td>1<td>22<tr><th>333<td>4</table>", "1   | 22\n333 | 4"), ("<script>x<y</script>a<!-- b -->c", "ac"), ("<div hidden>n</div><p style='Display : none'>n</p>y", "y"),
        ("<head><title>t</title></head><body>b", "b"), ("<pre> a\n  b</pre>", " a\n  b"), ("a<br>b  \n c", "a\nb c"), ("1 < 2 <", "1 < 2 <"), ("<b>x</b><i> y", "x y"), ("</p>a</div></b>", "a"),
        ("<table><tr><td colspan=2>head<td>z<tr><td>a<td>b<td>c</table>", "head  | z\na | b | c"), ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
        ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a | b\n  | c\n  | d"), ("<table><tr><td>one<td><ul><li>x<li>y</ul><tr><td>2<td>z</table>", "one | - x\n    | - y\n2   | z"),
        ("<table><tr><td>a<br>b<td><table><tr><td>p<td>q</table></table>", "a | p | q\nb |"), ("<table><tr><td colspan=2>wide title<tr><td>a<td>b</table>", "wide title\na | b"),
        ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>", "yes"), ("<div style='visibility:hidden'>no<p style='display:none'><i style='visibility:visible'>no</i></p></div>z", "z"),
        ("<ol data-start=9><li>x</ol>", "1. x"), ("<dialog title=open>n</dialog><dialog open>y</dialog>", "y"), ("<blockquote>q</blockquote>z", "  q\n\nz"), ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<td>x", "x"), ("<textarea> <b> </textarea>", " <b> "),
    ],
)
def test_html_layout(page, expected):
    assert html_text.render(page) == expected


def test_html_is_safe_and_keeps_all_words(spark):
    assert html_text.render("<div>" * 3000 + "deep") == "deep"
    rng = random.Random(5)
    tags = ["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "<td>", "</table>", "<tr>", "<b>", "</b>", "<br>", "<div>", "</div>", "<ol>", "<h1>", "<pre>", "</pre>"]
    for _ in range(60):
        tokens = [rng.choice(tags) if rng.random() < 0.5 else f"w{i}" for i in range(40)]
        text = html_text.render(" ".join(tokens))
        assert [w for w in re.findall(r"w\d+", text)] and set(re.findall(r"w\d+", text)) == {t for t in tokens if t[0] == "w"}
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x")], "page_id bigint, html string").withColumn("text", F.lit("clash"))
    assert [tuple(r) for r in html_text.extract(pages).orderBy("page_id").collect()] == [(1, None), (2, ""), (3, "x")]


class _Visible(HTMLParser):
    """The visible words of pages whose elements are all closed, by the standard library's parser."""

    def __init__(self, page):
        super().__init__()
        self.words, self.open = [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag not in html_text.VOID:
            own = dict(reversed(attrs))
            style = (own.get("style") or "").replace(" ", "").lower()
            gone, faded = self.open[-1][1:] if self.open else (False, False)
            faded = False if "visibility:visible" in style else faded or "visibility:hidden" in style
            self.open.append((tag, gone or tag in html_text.UNSEEN or "hidden" in own or "display:none" in style, faded))

    def handle_endtag(self, tag):
        if tag in [t for t, *_ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.open or not any(self.open[-1][1:]):
            self.words.append(data)


def test_html_keeps_all_visible_characters_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    made = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    marks = re.compile(r"(?m)^\s*(?:- |\d+\. )| \| |[\s|]")
    for r in pages.collect():
        assert Counter(marks.sub("", made[r.page_id])) == Counter(marks.sub("", "".join(_Visible(r.html).words))), r.html


def test_html_keeps_all_visible_words_of_nested_elements():
    rng = random.Random(12)
    for _ in range(150):
        n, parts = 0, []

        def grow(depth):
            nonlocal n
            for _ in range(rng.randint(1, 3)):
                parts.append(f" w{n}x ")
                n += 1
                if depth < 5 and rng.random() < 0.7:
                    tag = rng.choice(["div", "span", "b", "section", "ul", "blockquote", "pre", "script" if rng.random() < 0.3 else "em"])
                    parts.append(f"<{tag} {rng.choice(['', '', '', 'hidden', 'class=hidden', 'style=visibility:hidden', 'style=visibility:visible', 'style=display:none'])}>")
                    (grow if tag != "script" else lambda _: parts.append("n0"))(depth + 1)
                    parts.append(f"</{tag}>")

        grow(0)
        page = "".join(parts)
        assert Counter(re.findall(r"w\d+x", html_text.render(page))) == Counter(re.findall(r"w\d+x", " ".join(_Visible(page).words))), page


def test_html_of_long_and_repeated_pages(spark):
    row = "<tr><td colspan=1000>a<td rowspan=99999>b<td>c</tr>"
    page = f"<table>{row * 2000}</table>" + "<p>word" * 20_000
    text = html_text.render(page)
    assert text.count("word") == 20_000 and text.count("b") == 2000
    wide = "<table>" + "<tr><td>" + "x" * 100_000 + "<td>z" + "<tr><td>a<td>b" * 5000 + "</table>"
    assert len(html_text.render(wide)) < 2 * len(wide)
    pages = spark.createDataFrame([(1, page), (1, page), (None, "x")], "page_id bigint, html string").withColumn("text", F.lit("clash"))
    assert sorted((str(r.page_id), r.text) for r in html_text.extract(pages).collect()) == sorted([("1", text), ("1", text), ("None", "x")])


@pytest.mark.parametrize("attributes", ['style="overflow: hidden"', 'class="box hidden"', 'title="The hidden garden"', 'href="/hidden/garden"', "href=/hidden/garden", "data-hidden", "hidden=until-found", "data-style='display:none'", 'style="display:none;display:block"'])
def test_html_shows_what_only_names_hidden(attributes):
    assert html_text.render(f"<div {attributes}>seen</div>") == "seen"


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", 'class="a"hidden', 'id=x hidden="hidden"', 'style="color:red; Display : none"', "style=display:none", "style='visibility:hidden!important;visibility:visible'"])
def test_html_hides_what_is_hidden(attributes):
    assert html_text.render(f"<p>a</p><div {attributes}>gone<b>too</b></div>") == "a"


def test_fitting_and_searching_hold_few_rows_at_once():
    import tracemalloc

    rng = np.random.default_rng(4)
    words, first = rng.integers(0, 2**63, 120_000).astype(np.uint64) * np.uint64(2), np.arange(0, 120_001, 300)
    matrix, idf = rng.standard_normal((decontamination.FEATURES, 208)).astype(np.float32), np.ones(decontamination.FEATURES, np.float32)
    start = decontamination.steps(first, decontamination.WIDTH)[0]
    index = decontamination.Index(idf, matrix[:, :64])
    items = decontamination.Items(list(range(1500)), [" ".join(f"{k}x{j}" for j in range(60)) for k in range(1500)], [None] * 1500, index, 0.6, 8)

    def peak(run):
        tracemalloc.start()
        try:
            return run(), tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    gram, most = peak(lambda: decontamination._gram(iter([(words, first)]), idf, matrix))
    assert most < 70  # all words at once: over 200 MB
    f, w = decontamination._rows(words, start, idf)
    at, rows = decontamination._back(f, w, start, decontamination._times(f, w, start, matrix))
    assert np.abs(gram[at] - rows).max() < 1e-3 * np.abs(rows).max() and not np.delete(gram, at, axis=0).any()
    _, most = peak(lambda: items.leaks(words, first, 0.9, 0.6, 0.5, 8))
    assert most < 80


def test_tasks_give_memory_back():
    import ctypes
    import subprocess
    import sys

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("needs glibc")
    code = """if True:
        import numpy as np, pyarrow as pa
        from pathlib import Path
        from turnloom.llm import kernel
        held = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6
        def run(batches):
            parts = [np.ones(12_500) for _ in range(2000)]  # 200 MB below what malloc maps
            kept = parts[-1]
            yield from batches
            run.kept = kept
        before = held()
        rows = list(kernel.tidy(run)([1]))
        print(rows, held() - before < 60)"""
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split() == ["[1]", "True"]


def test_decontamination(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(1500)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [text(rng.randint(16, 60)) for _ in range(20)]
    rows, planted = [], set()
    for i in range(200):
        body = text(rng.randint(20, 300))
        if i % 10 == 0:
            k = i // 10
            item = list(items[k])
            if i % 20 == 0:  # a paraphrase: one word in eight is another, and the case and the marks change
                item = [rng.choice(vocabulary) if j % 8 == 3 else w.upper() + "," for j, w in enumerate(item)]
            at = rng.randrange(len(body))
            body[at:at] = item
            planted.add((i, k))
        rows.append((i, " ".join(body), "en", "s", 0))
    rows += [(900, None, None, None, None), (901, "", None, None, 0), (None, " ".join(items[3]), None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(99, None), (98, "")], "item_id bigint, text string")
    made = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    assert made == planted | {(None, 3)}
    assert decontamination.leaks(docs.where("false"), bench).isEmpty() and decontamination.leaks(docs, bench.where("false")).isEmpty()
    kept = decontamination.with_leaks(docs.withColumn("item_id", F.lit(1)), bench).where(F.size("_leaks") == 0)
    assert kept.count() == 182 and decontamination.lcs(np.array([1, 2, 3, 4]), np.array([1, 3, 9, 4])) == 3


def test_the_judge_is_right_and_asks_for_answers_of_likely_leaks_only(monkeypatch):
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *(last := 0, [last := max(last, row[k + 1], row[k] + 1 if x == y else 0) for k, y in enumerate(b)])[1]]
        return row[-1]

    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 63, 64, 65, 200):
        for top in (2, 9, 300):
            a, b = (rng.integers(0, top, k).astype(np.uint64) for k in (n, int(rng.integers(0, 150))))
            assert decontamination.lcs(a, b) == table(a.tolist(), b.tolist())
    seen, real = [], decontamination.lcs
    monkeypatch.setattr(decontamination, "lcs", lambda a, b: seen.append(len(a)) or real(a, b))
    items = decontamination.Items.__new__(decontamination.Items)
    items.words, items.answers = [np.arange(30)], [np.arange(20, 30)]
    assert items._judge(0, np.arange(29, -1, -1), 0, 30, 0.6, 0.5, 8) is None and seen == [30]
    assert items._judge(0, np.arange(25), 0, 25, 0.6, 0.5, 8) == (25 / 30, 0.5) and seen == [30, 30, 10]


def test_decontamination_finds_all_that_the_judge_accepts(spark):
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [text(rng.randint(15, 60)) for _ in range(2300)] + [text(k) for k in (1, 2, 3, 5, 7)]
    rows, planted = [], set()
    for i in range(120):
        body, k = text(rng.randint(60, 200)), 2304 - i if i < 5 else rng.randrange(2300)
        share = rng.choice([0.62, 0.7, 0.8]) if i >= 5 else 1
        kept = set(rng.sample(range(len(items[k])), math.ceil(share * len(items[k]))))
        at = rng.randrange(len(body))
        body[at:at] = [w if j in kept else rng.choice(vocabulary) for j, w in enumerate(items[k])]
        rows.append((i, " ".join(body), "en", "s", 0))
        planted.add((i, k))
    made = {(r.doc_id, r.item_id) for r in decontamination.leaks(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")).collect()}

    def accepted(body, k):  # the judge at every passage, item by item
        item, answer = items[k], items[k][-max(1, len(items[k]) // 3) :]
        common = lambda a, b: decontamination.lcs(np.array(a, object), np.array(b, object)) / len(a)
        for at in range(0, len(body), 12):
            part = body[max(0, at - len(item)) : at + 24 + len(item)]
            if len(set(item) & set(part)) and common(item, part) >= (1 if len(item) < 8 else 0.6) and common(answer, part) >= 0.5:
                return True
        return False

    bodies = [r[1].split() for r in rows]
    brute = {(i, k) for i, body in enumerate(bodies) for k, item in enumerate(items) if sum(w in body for w in item) >= (1 if len(item) < 8 else 0.6) * len(item) and accepted(body, k)}
    assert len(brute & planted) > 80 and made == brute


def plain_model(tokens, train):
    """n-gram counts of the training texts, and the estimates at each token, word by word."""
    grams = [Counter(), Counter(), Counter()]
    for i in train:
        ws = ["</s>", "</s>", *tokens[i]]
        for k in range(2, len(ws)):
            for order in range(3):
                grams[order][tuple(ws[k - order : k + 1])] += 1
    n, texts = sum(grams[0].values()), len(train)

    def estimates(ws):
        ws = ["</s>", "</s>", *ws]
        for k in range(2, len(ws)):
            one = grams[0][(ws[k - 1],)]
            two = texts if k == 2 else grams[1][tuple(ws[k - 2 : k])]
            bucket = 40 + two.bit_length() if two else one.bit_length()
            yield bucket, [grams[2][tuple(ws[k - 2 : k + 1])] / two if two else 0.0, grams[1][tuple(ws[k - 1 : k + 1])] / one if one else 0.0, grams[0][(ws[k],)] / max(n, 1)]

    return grams[0], n, estimates


def test_language_model(spark, docs, nothing):
    rows, df = docs
    made = {r.doc_id: r for r in language_model.score(df).collect()}
    tokens = {i: [*words((t or "").translate(LOWER)), "</s>"] for i, t, *_ in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}
    counts, n, estimates = plain_model(tokens, [i for i in tokens if fold[i] != 2])
    rest, _, rest_estimates = plain_model(tokens, [i for i in tokens if fold[i] not in (2, 3)])
    octave = lambda p: round(-math.log2(p) * language_model.STEP) if p else -1
    cells = Counter((b, *map(octave, p)) for i in tokens if fold[i] == 3 for b, p in rest_estimates(tokens[i]))
    weights = language_model.learn([(*k, m) for k, m in cells.items()], float(len(rest)))
    v = len(counts)
    for i, ws in tokens.items():
        r = made[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[i] == 2, len(ws), sum(counts[(w,)] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[(w,)] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        plain = sum(math.log10(sum(w * x for w, x in zip(weights[b], [*p, 1 / (v + 1)], strict=True))) for b, p in estimates(ws))
        assert math.isclose(r.score, plain, rel_tol=1e-6)
    held = [made[i] for i in tokens if made[i].held_out and len(tokens[i]) < 1000]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert language_model.score(nothing).isEmpty()


def test_language_model_of_odd_rows(spark):
    rows = [(None, "a b c"), (None, "a b c"), (2**63 - 1, "a b"), (1, None), (1, ""), (1, "a b c")]
    made = language_model.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in made)) == [(False, 1, 1), (False, 1, 1), (False, 1, 4), (False, 2**63 - 1, 3), (True, 0, 4), (True, 0, 4)]
    assert all(math.isfinite(r.score) and r.score <= 0 for r in made) and len({r.score for r in made if r.n_tokens == 4}) == 1


def test_learned_weights_maximise_the_held_out_likelihood():
    rng = np.random.default_rng(3)
    cells = [(int(b), int(x), int(y), int(z), float(k)) for b, x, y, z, k in zip(rng.choice([43, 50], 60), rng.integers(-1, 9, 60), rng.integers(0, 12, 60), rng.integers(4, 20, 60), rng.integers(1, 30, 60), strict=True)]
    weights = language_model.learn(cells, 100.0, rounds=2000)
    assert np.allclose(weights.sum(axis=1), 1) and (weights[:40, 0] == 0).all() and weights[0, 1] == 0
    share = lambda o: 2.0 ** (-o / language_model.STEP) if o >= 0 else 0.0

    def likelihood(b, w):
        return sum(k * math.log(w @ np.array([share(x), share(y), share(z), 1 / 101])) for c, x, y, z, k in cells if c == b)

    for b in (43, 50):
        best = likelihood(b, weights[b])
        for _ in range(200):
            other = np.maximum(weights[b] + rng.normal(0, 0.02, 4), 1e-9)
            assert likelihood(b, other / other.sum()) <= best + 1e-2


def quality_corpus():
    """Clean, junk and toxic texts; junk comes from a source of its own, and two thirds of the documents have labels."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        kind = rng.choice(["clean", "clean", "clean", "junk", "toxic"])
        body = ["".join(rng.choice("aeiourstn") for _ in range(rng.randint(2, 8))) + ("!!***" if kind == "junk" else "") for _ in range(rng.randint(5, 60))]
        if kind == "toxic":
            body.insert(rng.randrange(len(body)), rng.choice(["Vilezz,", "zzloser", "ZZSCUM!"]))
        text = " ".join(body)
        rows.append((i, text, "en", "s9" if kind == "junk" else "s1", len(text), kind))
        if i < 1000:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    rows += [(9000, None, None, None, None, "odd"), (9001, "", None, None, 0, "odd"), (9002, "rest " * 50_000, "en", "s1", 250_000, "odd"), (9002, "rest " * 50_000, "en", "s1", 250_000, "odd")]
    return rows, labels


def test_quality(spark, nothing):
    rows, labels = quality_corpus()
    docs = spark.createDataFrame([r[:5] for r in rows], DOCS).withColumn("quality", F.lit("clash")).withColumn("lang_slot", F.lit("clash"))
    schema = "doc_id bigint, quality int, toxic int"
    given = spark.createDataFrame(labels + [(5, *labels[5][1:]), (6, None, None), (None, 1, 0)], schema)
    scored = quality.with_quality(docs, quality.train(docs, given))
    assert scored.columns == [*docs.columns, "_quality"] and {(r.quality, r.lang_slot) for r in scored.collect()} == {("clash", "clash")}
    made = {r.doc_id: r._quality for r in scored.collect()}
    right = sum((made[i] >= 0.5) == (rows[i][5] == "clean") for i in range(1000, 1500))
    assert right >= 485 and len(made) == 1503 and scored.count() == 1504
    assert sum(made[i] < 0.5 for i in range(1000, 1500) if rows[i][5] == "toxic") >= 0.9 * sum(rows[i][5] == "toxic" for i in range(1000, 1500))
    assert quality.train(docs, given.where("quality = 1 AND toxic = 0")) == 1.0 and quality.train(nothing, given.where("false")) == 0.5
    assert quality.with_quality(docs, 1.0).where("_quality = 1").count() == 1504
    tie = quality.votes(spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (3, None, 0), (4, 1, 1), (4, 1, 0), (4, 1, 1)], schema))
    assert {tuple(r) for r in tie.collect()} == {(1, 1.0), (2, 0.0), (4, 0.0)}


def plain_text_logit(text, view):
    """The text view's log-odds, trigram by trigram and word by word."""
    data = (text or "").encode()
    places = [(data[i] * 7919 + data[i + 1] * 31337 + data[i + 2] * 104729 >> 3) % quality.TRIGRAMS for i in range(len(data) - 2)]
    total = view.bias + sum(view.trigrams[p] for p in places) / max(len(places), 1)
    plain = [w.lower() for w in words("".join(" " if c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in text or ""))]
    n = max(len(plain), 1)
    total += view.repeats @ np.array([sum(a == b for a, b in zip(plain, plain[1:], strict=False)) / n, len(set(plain)) / n])
    hashes = kernel.word_hashes(*kernel.text_buffers(pa.array([" ".join(sorted(set(plain)))])), lower=True)[0]
    return total + sum(view.words[np.flatnonzero(view.telling == h)[0]] for h in hashes if h in view.telling)


def test_one_round_of_co_training(spark):
    """The metadata view after one round is the one that a plain restatement fits on its own labels and the text view's confident marks."""
    rows, labels = quality_corpus()
    docs, given = spark.createDataFrame([r[:5] for r in rows[:1501]], DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    before, after = quality.train(docs, given, rounds=0, confident=0.9), quality.train(docs, given, rounds=1, confident=0.9)
    slots = {r[0]: tuple(r)[1:] for r in docs.select("doc_id", *quality._slots()).collect()}
    held = {r[0] for r in docs.where("pmod(xxhash64(doc_id), 5) = 0").select("doc_id").collect()}
    label = {i: float(q == 1 and not t) for i, q, t in labels}
    own = Counter((*slots[i], y) for i, y in label.items() if i not in held)
    logits = {i: plain_text_logit(t, before.text) for i, t, *_ in rows[:1501]}
    made = before.text.logits(*kernel.text_buffers(pa.array([r[1] for r in rows[:1501]], pa.string())))
    assert np.allclose(made, list(logits.values()))
    marks = Counter((*slots[i], float(x > 0)) for i, x in logits.items() if i not in label and abs(x) >= math.log(9))
    assert sum(marks.values()) > 50
    plain = lambda *parts: quality.MetaView([(*k, n) for c in parts for k, n in c.items()]).weights
    assert np.allclose(before.meta.weights, plain(own), atol=1e-6) and np.allclose(after.meta.weights, plain(own, marks), atol=1e-6)
    x, y, weight = np.array([[0.0], [1.0], [2.0], [3.0]]), np.array([0, 1, 0, 1]), np.array([3.0, 1.0, 2.0, 4.0])
    w = quality.logistic(x, y, weight, 1e-3)
    p = 1 / (1 + np.exp(-(x[:, 0] * w[0] + w[1])))
    assert np.allclose([(weight * (p - y) * x[:, 0]).sum() + 1e-2 * w[0], (weight * (p - y)).sum()], 0, atol=1e-5)


def plain_components(rows):
    sets = {}
    for i, t, *_ in rows:
        w = words((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates(spark, docs, nothing):
    rows, df = docs
    made = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert made == plain_components(rows)
    assert near_dedup.near_duplicates(nothing).isEmpty()


def test_near_duplicates_of_edited_families(spark):
    rng = random.Random(8)
    base, rows = [f"w{i}" for i in range(80)], []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            copy[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy), None, None, 0))
    made = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame([*rows, (None, rows[0][1], None, None, 0)], DOCS)).where("doc_id IS NOT NULL").collect()}
    assert made == plain_components(rows)


def test_near_duplicates_of_a_repeated_id(spark):
    """Two texts of one doc_id join the groups of both."""
    word = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(5, word("a")), (5, word("b")), (5, word("b")), (7, word("a")), (9, word("b") + " tail"), (3, word("c")), (4, None), (4, "")]
    made = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert made == [(3, 3, True), (4, 4, True), (4, 4, True), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False)]


def test_pairs_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """2000 near copies, some of them far from nearly all others: all links are kept, and few pairs are compared."""
    rng, n = random.Random(9), 2000
    base, rows = [f"w{i}" for i in range(90)], []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5, 7])):
            copy[rng.randrange(90)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy), None, None, 0))
    sets = [{hash(tuple(w[k : k + 5])) for k in range(86)} for w in (t.split() for _, t, *_ in rows)]
    known = {g: k for k, g in enumerate(sorted(set().union(*sets)))}
    has = np.zeros((n, len(known)), dtype=np.float32)
    for i, s in enumerate(sets):
        has[i, [known[g] for g in s]] = 1
    both, size = has @ has.T, has.sum(axis=1)
    near = 100 * both >= 75 * (size[:, None] + size[None, :] - both)
    label = np.arange(n)
    for _ in range(n):
        low = np.where(near, label[None, :], n).min(axis=1)
        if (low == label).all():
            break
        label = low
    compared, check = [], near_dedup.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return check(pairs, *rest)

    monkeypatch.setattr(near_dedup, "verified", counted)
    made = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert made == dict(enumerate(label.tolist())) and len(set(label.tolist())) > 20
    assert sum(compared) < 60 * n < near.sum() / 4


def test_sketches_and_signatures_estimate_similarity(spark):
    rng = np.random.default_rng(2)
    grams = np.sort(rng.integers(0, 2**63, 2000, dtype=np.uint64))
    a, b = grams[:1600], grams[400:]  # similarity 0.6
    both = near_dedup.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    assert abs((both[0] == both[1]).mean() - 0.6) < 0.12
    sketch = near_dedup.sketches(both)
    row = spark.createDataFrame([(sketch[0].tolist(), sketch[1].tolist())], "a array<bigint>, b array<bigint>")
    assert row.select(near_dedup.unlike(F.col("a"), F.col("b"))).first()[0] == int(((both[0] & 15) != (both[1] & 15)).sum())


@pytest.mark.parametrize("n", [0, 1, 5, token_codec.BLOCK, token_codec.BLOCK * 2 + 77])
def test_codec_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.concatenate([rng.integers(0, 2**32 - 1, n // 2, dtype=np.uint64), rng.zipf(1.3, n - n // 2) % 5000]).astype("<u4")
    blob = token_codec.encode_segment(ids)
    assert np.array_equal(token_codec.decode_segment(blob), ids)


def test_codec_learns_and_finds_damage():
    ids = np.tile(np.arange(50, dtype="<u4"), 400)
    blob = token_codec.encode_segment(ids)
    assert len(blob) < len(ids) // 4
    broken = bytearray(blob)
    broken[-9] ^= 255
    with pytest.raises(ValueError, match="damaged"):
        token_codec.decode_segment(bytes(broken))
    with pytest.raises(ValueError, match="segment"):
        token_codec.decode_segment(b"\0" * 20)


def test_token_output(spark, docs, nothing):
    from tokenizers import Tokenizer

    rows, df = docs
    tokenizer = Tokenizer.from_file(token_output.default_tokenizer())
    made = {r.doc_id: r for r in token_output.read_tokens(token_output.write_tokens(df)).collect()}
    at = 0
    for i, t, *_ in sorted(rows):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (made[i].start, made[i].n_tokens, made[i].ids) == (at, len(ids), ids)
        at += len(ids)
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (1, "a")], "doc_id bigint, text string")
    assert [r.doc_id for r in token_output.read_tokens(token_output.write_tokens(twice), digest=True).orderBy("start").collect()] == [1, 1, 1, None]
    assert token_output.read_tokens(token_output.write_tokens(nothing)).isEmpty()


def test_substring_dedup(spark, docs, nothing):
    rows, df = docs
    first = {}
    for i, t, *_ in sorted(rows):
        w = words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    made = {r.doc_id: r for r in substring_dedup.dedup(df).collect()}
    removed = 0
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        removed += sum(gone)
        assert (made[i].n_words, made[i].n_removed, made[i].kept_sha256, made[i].kept) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    assert removed > 300 and substring_dedup.dedup(nothing).isEmpty()
    same = spark.createDataFrame([(None, " ".join(map(str, range(60)))), (7, " ".join(map(str, range(60)))), (7, " ".join(map(str, range(60))))], "doc_id bigint, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in substring_dedup.dedup(same).collect()) == [("7", 0), ("7", 0), ("None", 60)]


def test_mixing(spark, docs, nothing):
    rows, df = docs
    made = mixing.mix(df).collect()
    assert len(made) == len(rows)
    sizes, targets, taken = Counter(), {}, Counter()
    for r in made:
        assert r.size == len(words(next(t for i, t, *_ in rows if i == r.doc_id))) and 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        targets[r.source] = r.target
        taken[r.source] += r.taken
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, free, plan = float(sum(sizes.values())), set(order), {}
    while True:  # share, cap, share the excess again
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            plan[s] = 3.0 * sizes[s]
            left -= plan[s]
            free.discard(s)
    plan |= {s: level * weight[s] for s in free}
    for s in order:
        assert math.isclose(targets[s], plan[s], rel_tol=1e-9)
        longest = max(r.size for r in made if r.source == s)
        assert abs(taken[s] - plan[s]) <= 0.03 * plan[s] + longest / 2  # whole copies of a document that outweighs its source
    again = {(r.doc_id, r.taken) for r in mixing.mix(df.repartition(3)).collect()}
    assert again == {(r.doc_id, r.taken) for r in made} and mixing.mix(nothing).isEmpty()
