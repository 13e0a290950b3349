"""Archives, centroid clustering and whitening against brute force: nulls, empty tables, ties, repeated rows, clashing columns, hot groups."""

import glob
import gzip
import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.llm import centroids, fingerprints, html_text, token_codec, url_filter, warc, whitening

PAGES = "page_id bigint, url string, html string"
VECTORS = "vec_id bigint, embedding array<float>"


# ---------------------------------------------------------------- archives
def captured(seed=1):
    rng = random.Random(seed)
    bodies = ["<p>" + "".join(rng.choice("abcé\r\n ") for _ in range(rng.randint(120, 400))) for _ in range(12)]
    rows = [(i, f"http://h{i % 3}.example/{i}", rng.choice(bodies)) for i in range(60)]
    rows += [(100 + i, f"http://hot.example/{i}", bodies[0]) for i in range(80)]
    rows += [(200, None, bodies[1]), (201, "http://x/a\r\nb\x00c", bodies[2]), (202, "http://x/ü", None), (203, "", ""), (204, "u", "short"), (205, "u", "short"), (None, "u", bodies[3]), (None, None, bodies[3])]
    rows += [(206, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 100), (207, "u", "y" * 3_000_000)]
    rows += [(300, "http://same", "z" * 150)] * 5  # wholly equal rows, which hold the original
    rows += [(301, "http://same", "z" * 150)] * 3
    return rows


def expected_archive(rows):
    out, seen = [], {}
    for row in rows:
        body = (row[2] or "").encode()
        seen.setdefault(body, []).append(row)
    for body, group in seen.items():
        group = sorted(group, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
        for k, row in enumerate(group):
            again = k > 0 and len(body) >= 100
            out.append((row[0], len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", group[0][0] if again else None))
    return sorted(out, key=str)


def taken(df):
    return sorted((tuple(r) for r in df.select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    rows = captured()
    path = str(tmp_path_factory.mktemp("warc") / "out")
    pages = spark.createDataFrame(rows, PAGES).withColumn("key", F.lit(1)).withColumn("id", F.lit(2)).withColumn("_salt", F.lit(3)).withColumn("size", F.lit(4)).repartition(7)
    return rows, path, warc.deduplicate(warc.records_of(pages), path)


def test_archives_hold_each_payload_once(archive):
    rows, _, read = archive
    assert read.where("error IS NOT NULL").count() == 0
    assert taken(warc.resolved(read)) == expected_archive(rows)


def test_archives_are_members_with_valid_records(spark, archive):
    rows, path, _ = archive
    kinds, ids, bodies = [], [], {}
    for file in glob.glob(f"{path}/part-*"):
        data = gzip.open(file).read()  # whole members only, else this raises
        first = True
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            size = int(fields["Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            assert not first or fields["WARC-Type"] == "warcinfo"
            first = False
            kinds.append(fields["WARC-Type"])
            ids.append(fields["WARC-Record-ID"])
            if kinds[-1] == "response":
                bodies[fields["WARC-Record-ID"]] = rest[:size].partition(b"\r\n\r\n")[2]
            data = rest[size + 4 :]
    assert len(ids) == len(set(ids))
    assert kinds.count("response") + kinds.count("revisit") == len(rows)
    assert sorted(bodies.values()).count(b"z" * 150) == 1
    revisits = warc.read_archives(spark, path).where("record_type = 'revisit'").collect()
    assert all(hashlib.sha256(bodies[r.refers_to_record]).hexdigest() == r.stated_digest for r in revisits)


def test_payloads_come_back(spark, archive):
    rows, path, _ = archive
    got = {bytes(r.payload) for r in warc.read_archives(spark, path, payloads=True).where("record_type = 'response'").collect()}
    assert got == {(r[2] or "").encode() for r in rows}


def test_rewritten_archives_agree(spark, archive, tmp_path):
    rows, path, _ = archive
    made = warc.rewrite(spark, path, str(tmp_path / "again"))
    assert taken(warc.resolved(made)) == expected_archive(rows)
    assert made.agg(F.count("record_id"), F.countDistinct("record_id")).first()[:] == (len(rows), len(rows))


def test_foreign_and_broken_archives(spark, tmp_path):
    def record(kind, id_, body, **more):
        head = {"WARC-Type": kind, "WARC-Record-ID": id_, "WARC-Target-URI": f"http://{id_}", "Content-Type": "application/http; msgtype=response", **{k.replace("_", "-"): v for k, v in more.items()}, "Content-Length": len(body)}
        return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + body + b"\r\n\r\n"

    page = b"HTTP/1.1 200 OK\r\n\r\n" + b"q" * 200
    plain = record("response", "a", page, WARC_Payload_Digest="sha1:ABC") + record("revisit", "b", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Payload_Digest="sha1:ABC") + record("revisit", "c", b"", WARC_Payload_Digest="sha1:GONE") + record("revisit", "d", b"")
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.warc").write_bytes(plain)  # not packed
    (source / "two.warc.gz").write_bytes(gzip.compress(record("request", "r", b"GET /") + record("response", "e", page)))  # one member, two records
    (source / "cut.warc.gz").write_bytes(gzip.compress(record("response", "f", page))[:-30])
    (source / "odd.warc").write_bytes(b"no archive")
    read = warc.read_archives(spark, str(source))
    assert read.where("error IS NOT NULL").count() == 2 and read.where("error IS NULL").count() == 5
    made = warc.rewrite(spark, str(source), str(tmp_path / "out")).collect()
    kinds = {r.uri: (r.record_type, r.refers_to_uri) for r in made}
    assert kinds["http://a"] == ("response", None) and kinds["http://e"] == ("revisit", "http://a") and kinds["http://b"] == ("revisit", "http://a")
    assert kinds["http://c"] == ("revisit", None) and kinds["http://d"] == ("revisit", None) and len(made) == 5


def test_empty_table_gives_no_archives(spark, tmp_path):
    made = warc.deduplicate(warc.records_of(spark.createDataFrame([], PAGES)), str(tmp_path / "none"))
    assert warc.resolved(made).count() == 0


# ---------------------------------------------------------------- centroids
def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        centres = [[sum(col) // len(groups[c]) for col in zip(*groups[c], strict=True)] if c in groups else old for c, old in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for *_, d in found)
    inertia = {c: sum(d for _, x, d in found if x == c) for c in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], total, digest[c]) for i, c, d in found), key=str)


def vectors(n, seed=5, dims=64):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((5, dims))
    rows = [(i, [float(np.float32(x)) for x in middle[i % 5] + 0.3 * rng.standard_normal(dims)]) for i in range(n)]
    odd = [(n, None), (n + 1, []), (n + 2, [1.0] * (dims - 1)), (n + 3, [None] + [1.0] * (dims - 1)), (n + 4, [math.nan] + [1.0] * (dims - 1)), (n + 5, [math.inf] + [1.0] * (dims - 1)), (None, [0.5] * dims), (None, [0.5] * dims)]
    last = rows[-1][1]
    return rows + [(7, last), (7, rows[0][1])] + [(n + 10 + i, last) for i in range(n // 2)] + odd


@pytest.mark.parametrize("n", [70, 3])
def test_centroids_match_plain_rounds(spark, n):
    rows = vectors(n)
    made = centroids.cluster(spark.createDataFrame(rows, VECTORS).withColumn("x", F.lit("clash")).withColumn("cluster", F.lit(1)).withColumn("v", F.lit(2)).repartition(6))
    assert sorted((tuple(r) for r in made.collect()), key=str) == plain_clusters(rows)


def test_only_changed_components_are_multiplied(spark):
    """Kept products plus those of the changes are the products with the new centroids."""
    rng = np.random.default_rng(2)
    x = rng.integers(-60, 60, (40, 64))
    before, after = rng.integers(-60, 60, (3, 64)), None
    after = before.copy()
    after[1, [4, 9]] += 5
    rows = spark.createDataFrame([(i, v.tolist(), (v @ before.T).tolist()) for i, v in enumerate(x)], "vec_id bigint, x array<int>, dots array<bigint>")
    made = {r.vec_id: r for r in centroids.stepped(rows, after - before, after).collect()}
    for i, v in enumerate(x):
        away = ((v - after) ** 2).sum(axis=1)
        assert made[i].dots == (v @ after.T).tolist() and (made[i].cluster, made[i].distance) == (int(away.argmin()), int(away.min()))


def test_centroids_of_nothing_and_of_too_large_numbers(spark):
    assert centroids.cluster(spark.createDataFrame([], VECTORS)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], VECTORS)).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], VECTORS)).count()


# ---------------------------------------------------------------- whitening
def plain_whitening(rows, components=32):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    n, dims = len(kept), len(kept[0][1])
    sums = [sum(v[j] for _, v in kept) for j in range(dims)]
    exact = [[n * v[j] - sums[j] for j in range(dims)] for _, v in kept]
    # the covariance in fractions, rounded once
    cov = np.array([[float(Fraction(sum(d[a] * d[b] for d in exact), n**3)) for b in range(dims)] for a in range(dims)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    y = np.array([[float(Fraction(d, n)) for d in row] for row in exact])
    return n, [sum(d * d for d in row) for row in exact], y @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(cov)


@pytest.mark.parametrize(("n", "dims"), [(150, 40), (400, 8), (20, 33)])
def test_whitening_matches_exact_covariance(spark, n, dims):
    rng = np.random.default_rng(n)
    good = [(i, [float(np.float32(x)) for x in rng.standard_normal(dims) * (1 + np.arange(dims))]) for i in range(n)]
    good += [(3, good[3][1]), (None, good[4][1])]
    odd = [(900, None), (901, [None] * dims), (902, [math.nan] * dims), (903, [math.inf] + [0.0] * (dims - 1)), (904, [1.0] * (dims + 1)), (905, [])]
    table = spark.createDataFrame(good + odd, VECTORS).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).withColumn("dims", F.lit(0)).repartition(5)
    made = whitening.whiten(table).collect()
    count, deviation, white, explained = plain_whitening(good)
    width = white.shape[1]
    assert len(made) == count * width and {r.n for r in made} == {count}
    assert max(r.identity_error for r in made) < 1e-9
    got = {}
    for r in made:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    at = {i: k for k, (i, _) in enumerate(good)}
    for c in range(width):
        sign = np.sign(sum(got[i][c + 1][0].whitened * white[at[i], c] for i in range(n)))
        for i in [*range(n), None]:
            for r in got[i][c + 1]:
                assert abs(r.whitened * sign - white[at[i], c]) < 1e-8 and r.deviation == deviation[at[i]]
                assert abs(r.explained / explained[c] - 1) < 1e-10


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.25, 1.0])] * 4, VECTORS)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.25, 1.0]), (2, [0.5, 1.0])], VECTORS)).collect()
    assert sorted((r.component, abs(r.whitened), r.explained) for r in one) == [(1, pytest.approx(1.0), pytest.approx(1.0))] * 2


@pytest.mark.parametrize(("dims", "wanted"), [(64, 32), (200, 8), (1, 4), (30, 30)])
def test_jacobi_davidson_reaches_double_precision(dims, wanted):
    rng = np.random.default_rng(dims)
    x = rng.standard_normal((3 * dims, dims)) * 0.97 ** np.arange(dims)
    a = x.T @ x / len(x)
    values, axes = whitening.leading_pairs(lambda b: a @ b, dims, wanted)
    exact = np.linalg.eigvalsh(a)[::-1][: min(wanted, dims)]
    assert np.abs(values - exact).max() < 1e-13 * exact[0]
    assert np.linalg.norm(a @ axes - axes * values, axis=0).max() < 1e-12 * exact[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((25, 25))
    a, b = a + a.T, rng.standard_normal((25, 4))
    assert np.abs(whitening.minres(lambda v: a @ v, b, 40) - np.linalg.solve(a, b)).max() < 1e-9


# ---------------------------------------------------------------- HTML in proportion to the page
@pytest.mark.parametrize("part", ["<a ", '<a x="', "<a '>", '<a ">"', "<div>x", "<li>", "<li>x", "<ul><li>x", "<blockquote>", "<blockquote>x", "<b>", "<b><p>x", "<p><button><div>", "<!", "</", "<table><tr><td>x"])
def test_html_time_and_text_grow_with_the_page(part):
    import time

    took, text = [], []
    for size in (250_000, 500_000):
        page = part * (size // len(part)) + ('"' if part == '<a ">"' else "")
        best = math.inf
        for _ in range(2):
            began = time.perf_counter()
            text = html_text.render(page)
            best = min(best, time.perf_counter() - began)
        took.append(best)
        assert len(text) < 70 * size
    assert took[1] < 3.5 * took[0] + 0.5, took


def test_html_of_five_megabytes_of_unclosed_tags():
    import time

    began = time.perf_counter()
    assert html_text.render("<a " * 1_700_000).startswith("<a <a")
    assert html_text.render('<a x="' * 850_000 + ">end") == "end"
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("a</br>b", "a\nb"),
        ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
        ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
        ("<ol reversed start=9><li>a<li>b</ol>", "9. a\n8. b"),
        ("x﷐y﷓<pre> a\tb</pre>", "x﷐y﷓\n\n a\tb"),
        ("<a title=\"it's >\">b</a>", "b"),
        ("<a title=\"open>b</a> it's", "b it's"),
        ("<blockquote>" * 40 + "x", " " * 64 + "x"),
    ],
)
def test_html_defined_cases(page, expected):
    assert html_text.render(page) == expected


# ---------------------------------------------------------------- what is moved and kept
def test_bitmap_leaves_out_rows_of_other_ids(spark):
    from turnloom.llm import near_dedup

    rows, ids = spark.range(-20_000, 20_000).selectExpr("id AS doc_id", "'t' AS text"), spark.range(0, 2000, 2).selectExpr("id AS least")
    left = near_dedup.among(rows, "doc_id", ids, 1000)
    found = {r.doc_id for r in left.collect()}
    assert left.columns == ["doc_id", "text"] and set(range(0, 2000, 2)) <= found and len(found) < 10_000
    assert near_dedup.among(rows, "doc_id", ids.limit(0), 0).isEmpty()
    assert near_dedup.among(rows, "doc_id", ids, near_dedup.MOST_MARKED + 1) is rows


def test_weights_move_the_answers_of_their_own_chunks(spark, monkeypatch):
    from turnloom.llm import language_model

    seen, real = [], language_model.answered

    def spy(table, replies, work, schema):
        seen.append({r.fold for x in replies for r in x.where("chunk >= 0").selectExpr("chunk % 16 AS fold").distinct().collect()})
        return real(table, replies, work, schema)

    monkeypatch.setattr(language_model, "answered", spy)
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('a b ', id % 7, ' c') AS text")
    assert language_model.score(docs).count() == 60 and seen == [{1}, {0, 1}]


def test_stored_tables_let_finished_plans_go(spark, monkeypatch):
    from turnloom.llm import storage

    calls, real = [], storage.release
    monkeypatch.setattr(storage, "RELEASE_S", -1.0)
    monkeypatch.setattr(storage, "release", lambda s: (calls.append(1), real(s)))
    storage.discard(*[storage.materialize(spark.range(3), "small") for _ in range(2)])
    assert len(calls) == 2


def test_the_driver_lets_go_between_passes_of_the_decontamination(spark, monkeypatch):
    import tracemalloc

    from turnloom.llm import decontamination, storage

    calls, real = [], storage.release
    monkeypatch.setattr(storage, "RELEASE_S", -1.0)
    monkeypatch.setattr(storage, "release", lambda s: (calls.append(1), real(s)))
    docs = spark.range(40).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 59), x -> concat('w', (x * 7 + id) % 97))) AS text")
    tracemalloc.start()
    decontamination.fit(docs, [" ".join(f"w{k}" for k in range(40))], "doc_id", "text")
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(calls) == 4  # the sample's table and three products
    assert most < 5 * 8 * decontamination.FEATURES * (decontamination.RANK + decontamination.OVERSAMPLE), most


# ---------------------------------------------------------------- token segments
def test_words_have_the_librarys_ids(monkeypatch):
    from tokenizers import Tokenizer

    from turnloom.llm import token_output

    path = token_output.default_tokenizer()
    whole = Tokenizer.from_file(path)
    monkeypatch.setattr(token_output, "CACHE_WORDS", 8)
    monkeypatch.setattr(token_output, "CACHE_PIECES", 6)
    monkeypatch.setattr(token_output, "_TOKENIZERS", {})
    texts = ["It's 'TIS don't''s ÉßÿÀ×÷ naïve", "<unk> a<unk>b </w> x² 1²3", "İstanbul ΑΣ e\u0301a ªº a\u200bb", "'S ÿ'RE!!9a a,b a.b. ((x)) 2024-01-01", "", "word Word WORD word, " * 5]
    for text in texts * 2:
        assert np.frombuffer(token_output.encode_text(text.encode(), path), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert token_output._CACHE[path].model is not None and len(token_output._CACHE[path].pieces) < 20


def test_a_word_of_many_texts_is_looked_up_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from turnloom.llm import token_output

    path = token_output.default_tokenizer()
    whole = Tokenizer.from_file(path)
    token_output.encode_text(b"x", path)
    words, seen = token_output._CACHE[path], []
    real = words.made
    monkeypatch.setattr(token_output, "CACHE_WORDS", 4)
    monkeypatch.setattr(words, "made", lambda new: seen.extend(new) or real(new), raising=False)
    texts = [" ".join(f"Zq{(i * 7 + k) % 40}k\u00e9 Wv{k}" for k in range(30)) for i in range(50)] + ["", " \tZq1k\u00e9\x0b\n", "  "]
    column = pa.array(["cut off", *texts]).slice(1)
    ids, at = token_output.encode_texts(column, path)
    assert [ids[a:z].tolist() for a, z in zip(at[:-1], at[1:], strict=True)] == [whole.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(seen) == len(set(seen)) <= 71 and len(words.young) <= 2


def test_plain_words_are_cut_together_and_their_pieces_looked_up_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from turnloom.llm import token_output

    path = token_output.default_tokenizer()
    whole = Tokenizer.from_file(path)
    monkeypatch.setattr(token_output, "_TOKENIZERS", {})
    token_output.encode_text(b"x", path)
    words, single, seen = token_output._CACHE[path], [], []
    made, cut = words.made, words.cut
    monkeypatch.setattr(words, "made", lambda new: single.extend(new) or made(new), raising=False)
    monkeypatch.setattr(words, "cut", lambda new: seen.extend(new) or cut(new), raising=False)
    rng = random.Random(6)
    letters = [*"abZ09,.!/~\t\n\x0b\x1c\x85 '<>|sTd", *"ÀÞß×÷ÿŸµ²é́İΣ中​　ſK", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    plain = [f"Ab{k}, AB{k}. Éab/{k} ({k % 7})" for k in range(500)]
    for some in (plain, texts, [], [""]):
        ids, at = token_output.encode_texts(pa.array(["cut off", *some], pa.string()).slice(1), path)
        assert [ids[a:z].tolist() for a, z in zip(at[:-1], at[1:], strict=True)] == [whole.encode(x, add_special_tokens=False).ids for x in some]
        if some is plain:  # no word by itself, and 18 pieces: two words, signs and digits
            assert not single and len(seen) == len(set(seen)) <= 18


def test_what_a_writer_of_segments_holds():
    import subprocess
    import sys

    code = """if 1:
        import tracemalloc
        import numpy as np, pyarrow as pa
        from types import SimpleNamespace
        from turnloom.llm import token_output
        token_output.TaskContext = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
        path = token_output.default_tokenizer()
        token_output.encode_text(b"x", path)
        n = 400
        words = ["".join(chr(97 + c) for c in w) for w in np.random.default_rng(2).integers(0, 26, (2000, 6)).tolist()]
        pick = np.random.default_rng(3).integers(0, 2000, (n, 3500)).tolist()
        batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([" ".join(words[k] for k in p) for p in pick])], names=["key", "text"])
        del pick
        tracemalloc.start()
        parts = list(token_output._segments(path, 2)(iter([batch])))
        ids = sum(p.column("n_ids")[0].as_py() for p in parts)
        print(ids > 4_000_000, tracemalloc.get_traced_memory()[1] < 140e6)"""
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split() == ["True", "True"]


def test_codec_states_what_follows_in_the_header():
    rng = np.random.default_rng(8)
    follows = rng.integers(0, 5000, 5000)
    ids = np.zeros(60_000, dtype="<u4")
    for i, (new, jump) in enumerate(zip(rng.integers(0, 5000, 60_000).tolist(), (rng.random(60_000) < 0.2).tolist(), strict=True)):
        ids[i] = new if jump or not i else follows[ids[i - 1]]
    blob = token_codec.encode_segment(ids)
    # what follows is told for all blocks at once; a coder that learns it anew in each block needs over 9 bits an id
    assert np.array_equal(token_codec.decode_segment(blob), ids) and len(blob) * 8 < 7 * len(ids)


@pytest.mark.parametrize(("n", "top"), [(70_000, 2**32), (150_000, 70_000), (30_000, token_codec.ALPHABET), (40_000, token_codec.ALPHABET + 1)])
def test_codec_takes_any_ids(n, top):
    ids = np.random.default_rng(n).permutation(np.arange(n, dtype=np.uint64) * 2654435761 % top).astype("<u4")
    assert np.array_equal(token_codec.decode_segment(token_codec.encode_segment(ids)), ids)


def test_damaged_blocks_cost_no_others():
    ids = np.random.default_rng(3).integers(0, 40_000, 20 * token_codec.BLOCK + 5).astype("<u4")
    blob = token_codec.encode_segment(ids)
    whole = [ids[a : a + token_codec.BLOCK] for a in range(0, len(ids), token_codec.BLOCK)]
    bent = bytearray(blob)
    bent[len(blob) // 2] ^= 255
    for broken, most in ((bytes(bent), 1), (blob[: len(blob) * 3 // 4], 8)):
        parts = token_codec.decode_blocks(broken)
        bad = [k for k, p in enumerate(parts) if p is None]
        assert 1 <= len(bad) <= most and all(np.array_equal(p, w) for p, w in zip(parts, whole, strict=True) if p is not None)
        with pytest.raises(ValueError, match="damaged blocks"):
            token_codec.decode_segment(broken)
    for broken in (blob[:10], blob[:60], blob[:40] + b"\0\0" + blob[42:]):
        with pytest.raises(ValueError):
            token_codec.decode_segment(broken)


def test_vocabularies_are_read_by_their_definition():
    import json

    from turnloom.llm import token_output

    made = json.load(open(token_output.default_tokenizer(), encoding="utf-8"))
    assert token_output.splits_at_spaces(made)
    split = made["pre_tokenizer"]["pretokenizers"][0]
    for change in (
        {"pre_tokenizer": made["pre_tokenizer"]["pretokenizers"][1]},
        {"pre_tokenizer": split | {"pattern": {"Regex": r"\s?\p{L}+"}}},
        {"pre_tokenizer": split | {"behavior": "Isolated"}},
        {"pre_tokenizer": None},
        {"normalizer": {"type": "Prepend", "prepend": "_"}},
        {"post_processor": {"type": "TemplateProcessing"}},
        {"added_tokens": [made["added_tokens"][0] | {"lstrip": True}]},
    ):
        assert not token_output.splits_at_spaces(made | change), change
    assert token_output.splits_at_spaces(made | {"pre_tokenizer": {"type": "WhitespaceSplit"}})


# ---------------------------------------------------------------- earlier operators, restated
def test_likeness_to_the_next_document_is_the_similarity_of_shingles(spark):
    """Over many ranges of ids: each document against the one before it in id, the first against the last."""
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts, last = [], []
    for k in range(150):
        last = [rng.choice(vocabulary) for _ in range(rng.randint(150, 400))] if k % 3 == 0 else [w if rng.random() > 0.04 else rng.choice(vocabulary) for w in last]
        texts.append(" ".join(last))
    texts[40], texts[41] = "", None
    ids = [k * 7 + k % 2 for k in range(150)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string").repartition(6)
    made = {r.doc_id: r for r in fingerprints.next_documents(docs).mapInArrow(fingerprints._neighbours, fingerprints.SCHEMA).collect()}

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    errors = []
    for k, own in enumerate(ids):
        a, b = shingles(texts[k]), shingles(texts[k - 1])
        true = len(a & b) / len(a | b) if a and b else float(a == b)
        errors.append(made[own].near_next - true)
    assert max(map(abs, errors)) < 0.13 and abs(np.mean(errors)) < 0.01 and len(made) == 150


def test_url_model_is_plain_gradient_descent(spark):
    table = spark.createDataFrame(url_filter.seed_urls()[::5], "url string, label int")
    grams = table.select("label", url_filter.ngram_buckets(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")), 256).alias("g")).collect()
    x = np.zeros((len(grams), 257))
    for i, r in enumerate(grams):
        np.add.at(x[i], r.g, 1 / math.sqrt(max(len(r.g), 1)))
    x[:, 256] = 1
    y, w = np.array([r.label for r in grams], dtype=float), np.zeros(257)
    for _ in range(12):
        gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y)
        w[:256] *= 1 - 4.0 * 1e-3
        w -= 4.0 * gradient * np.append(np.ones(256), 0.25)
    model = url_filter.train(spark, table, buckets=256, rounds=12)
    assert np.abs(np.array(model["weights"]) - w[:256]).max() < 1e-9 and abs(model["bias"] - w[256]) < 1e-9
    judged = url_filter.judge(table.withColumn("page_id", F.monotonically_increasing_id()), [], model).orderBy("page_id").collect()
    assert np.abs(np.array([r.block_probability for r in judged]) - 1 / (1 + np.exp(-x @ w))).max() < 1e-9
    assert [r.verdict for r in judged] == ["block" if p >= 0.5 else "allow" for p in 1 / (1 + np.exp(-x @ w))]
