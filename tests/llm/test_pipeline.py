"""The pipeline's stages on a planted corpus."""

import random

import pytest

import corpus_pipeline

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 8))) for _ in range(1200)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    items = [text(40) for _ in range(5)]
    rows = [(i, text(rng.randint(30, 90)), "en", f"s{i % 4}", 0) for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "s1", 0) for i in range(10)]  # exact copies
    rows += [(300 + i, f"{text(20)} {items[i]} {text(20)}", "en", "s2", 0) for i in range(5)]  # leaks
    rows += [(400 + i, " ".join(w.upper() + "!!" for w in text(50).split()), "en", "s3", 0) for i in range(60)]  # junk
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 2)] + [(400 + i, 0, 0) for i in range(0, 60, 2)], "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_each_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    (_, good), (_, distinct), (_, clean), (_, mixed), (_, tokens) = corpus_pipeline.STAGES
    kept = good(spark, docs, folder)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and not [i for i in ids if i >= 400] and len(ids) == 165
    unique = {r.doc_id for r in distinct(spark, kept, folder).collect()}
    assert unique == ids - set(range(200, 210))
    pure = clean(spark, kept.where(kept.doc_id.isin(list(unique))), folder)
    assert {r.doc_id for r in pure.collect()} == unique - set(range(300, 305))
    spread = mixed(spark, pure, folder)
    assert spread.columns == columns and 100 < spread.count() < 300
    out = tokens(spark, spread, folder).collect()
    assert len(out) == spread.count() and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_whole_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 100


def test_stages_of_odd_rows(spark, folder):
    """Nulls, empty texts, repeated rows and ids, and columns with the stages' own names."""
    words = lambda k, s: " ".join(f"{s}{i}" for i in range(k))
    rows = [(None, words(30, "n"), None, None, None), (None, words(30, "n"), None, None, None), (1, None, None, None, None), (2, "", "en", "s1", 0), (3, words(40, "a"), "en", "s1", 9), (3, words(40, "a"), "en", "s1", 9)]
    rows += [(4, words(40, "b"), "en", "s2", 9), (4, words(40, "c"), "en", "s2", 9), (5, words(40, "c") + " tail", "en", "s2", 9), (6, "long " * 60_000, "en", "s2", 9)]
    docs = spark.createDataFrame([(*r, "q", "l", "c", "k") for r in rows], DOCS + ", _quality string, _leaks string, _copy string, _key string")
    (_, good), (_, distinct), (_, clean), (_, mixed), (_, tokens) = corpus_pipeline.STAGES
    for stage in (good, distinct, clean, mixed):
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns and {(r._quality, r._leaks, r._copy, r._key) for r in made.collect()} <= {("q", "l", "c", "k")}
        assert stage(spark, docs.where("false"), folder).isEmpty()
    left = sorted((str(r.doc_id), (r.text or "")[:2]) for r in distinct(spark, docs, folder).collect())
    assert left == [("1", ""), ("2", ""), ("3", "a0"), ("4", "b0"), ("6", "lo"), ("None", "n0"), ("None", "n0")]
    assert clean(spark, docs, folder).count() == len(rows)
    taken = [r for r in mixed(spark, docs, folder).collect()]
    assert all(r.text for r in taken) and {r.source for r in taken} <= {None, "s1", "s2"}
    out = tokens(spark, docs, folder).collect()
    assert len(out) == len(rows) and sorted(r.start for r in out)[0] == 0 and sum(r.doc_id is None for r in out) == 2


def test_mixed_copies_of_one_id(spark, folder):
    """Rows of one doc_id with different texts, and equal rows, keep their own copies, and no source passes its target by more than a document."""
    rng = random.Random(3)
    text = lambda k: " ".join(rng.choice(["red", "green", "blue", "grey"]) + str(rng.randrange(99)) for _ in range(k))
    rows = [(i % 7, text(rng.randint(5, 40)), "en", f"s{i % 3}", 0) for i in range(200)]
    rows += [rows[0]] * 9
    docs = spark.createDataFrame(rows, DOCS)
    from turnloom.llm import mixing

    plan = mixing.mix(docs).collect()
    made = corpus_pipeline.mixed_documents(spark, docs, folder).collect()
    for source in ("s0", "s1", "s2"):
        words = sum(len(r.text.split()) for r in made if r.source == source)
        assert words == sum(r.taken for r in plan if r.source == source)
        assert abs(words - next(r.target for r in plan if r.source == source)) <= 0.03 * words + 20
    times = {}
    for r in made:
        times[(r.doc_id, r.text)] = times.get((r.doc_id, r.text), 0) + 1
    assert max(n for k, n in times.items() if k != rows[0][:2]) <= 3 and times[rows[0][:2]] <= 30


def test_stages_send_texts_to_python_in_small_batches(spark):
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    docs = spark.range(30).selectExpr("id AS doc_id", "repeat('word ', 200000) AS text")
    try:
        spark.conf.unset(key)
        corpus_pipeline.STAGES[-1][1](spark, docs.limit(1).selectExpr("doc_id", "'word' AS text"), "")
        assert max(r.n for r in docs.coalesce(1).mapInArrow(sizes, "n bigint").collect()) < 6_000_000
        spark.conf.set(key, "2m")  # what the owner of the session has set stays
        corpus_pipeline.STAGES[-1][1](spark, docs.limit(1).selectExpr("doc_id", "'word' AS text"), "")
        assert spark.conf.get(key) == "2m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
