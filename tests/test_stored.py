"""Steps and their states, stored tables, file sources, timelines, arriving turns and block-wise measures, each against a plain restatement."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom import failures
from turnloom.functions import vectors
from turnloom.operators import catalog, dialogue, stats
from turnloom.plans import pipeline, tables
from turnloom.sources import documents, measures, riff, wav, wavfiles
from turnloom.streaming import turns as arriving


# ---------------------------------------------------------------- steps
def test_step_specs():
    chosen = pipeline.chosen_steps
    assert chosen("all", {}) == pipeline.ORDER == chosen(None, {}) == chosen("ALL", {})
    assert chosen("segment,3-5", {}) == ["scrub", "validate", "segment"] and chosen(" label , 1", {}) == ["preprocess", "label"]
    assert chosen("all", {"SKIP_SCRUB": "yes", "SKIP_SEGMENT": "1"}) == [s for s in pipeline.ORDER if s != "scrub"]
    for bad in ("0", "3-99", "nothing", "5-3"):
        with pytest.raises(ValueError):
            chosen(bad, {})


def test_inputs_bridge_steps_that_do_not_take_part():
    every = set(pipeline.ORDER)
    assert pipeline.inputs_of("validate", every) == ["scrub"] and pipeline.inputs_of("validate", every - {"scrub"}) == ["diarize"]
    assert pipeline.inputs_of("segment", every - {"scrub", "validate"}) == ["diarize", "preprocess"] and pipeline.inputs_of("label", every) == ["filter", "enroll"]


def test_what_follows_a_changed_step_runs_again(spark, tmp_path):
    ran, source = [], tmp_path / "in"
    source.mkdir()
    (source / "a.wav").write_bytes(b"x")

    def stage(name, read=None):
        def run(t):
            ran.append(name)
            return t[read(t)].select("v", F.lit(name).alias("by")) if read else spark.createDataFrame([(1,), (2,)], "v int")

        return run

    made = {"preprocess": stage("preprocess"), "diarize": stage("diarize", lambda t: "preprocess"), "scrub": stage("scrub", lambda t: "diarize"), "validate": stage("validate", lambda t: "scrub" if "scrub" in t else "diarize"), "segment": stage("segment", lambda t: "validate")}
    root, every, plain = str(tmp_path / "run"), list(made), ["preprocess", "diarize", "validate", "segment"]
    sources = {"preprocess": [str(source)]}

    def go(steps, **settings):
        ran.clear()
        tables_ = pipeline.run(spark, root, made, steps, settings=settings, sources=sources)
        return list(ran), tables_

    told = lambda steps, **settings: {s: state for s, state, _ in pipeline.states(spark, root, steps, settings=settings, sources=sources)}
    assert go(plain)[0] == plain and go(plain)[0] == []
    # an optional step turned on later: it and all that follows it
    assert told(every) == {"preprocess": "kept", "diarize": "kept", "scrub": "missing", "validate": "stale", "segment": "stale"}
    again, found = go(every)
    assert again == ["scrub", "validate", "segment"] and found["validate"].first().by == "validate"
    # scrubbed turns are read although scrubbing is not among the steps of this run
    assert go(["validate", "segment"])[0] == [] and go(plain)[0] == []
    # other settings, other recordings, a table that somebody changed or took away
    assert go(every, validate={"size": 4})[0] == ["validate", "segment"]
    (source / "b.wav").write_bytes(b"y")
    assert go(every, validate={"size": 4})[0] == every
    spark.createDataFrame([(9, "z")], "v int, by string").write.mode("append").parquet(f"{root}/scrub")
    assert go(every, validate={"size": 4})[0] == ["scrub", "validate", "segment"]
    tables.delete(spark, f"{root}/validate")
    assert told(every, validate={"size": 4})["validate"] == "missing" and go(every, validate={"size": 4})[0] == ["validate", "segment"]
    # a failure ends the run; what stands before it is kept
    made["segment"] = lambda t: (_ for _ in ()).throw(RuntimeError("down"))
    with pytest.raises(RuntimeError):
        go(every, validate={"size": 4}, segment=1)
    assert told(every, validate={"size": 4}, segment=1) == {s: "missing" if s == "segment" else "kept" for s in every}
    saved = json.loads((tmp_path / "run" / "manifest.json").read_text())["steps"]
    assert saved["segment"]["status"] == "failed" and "down" in saved["segment"]["error"] and saved["scrub"]["counts"] == {"rows": 2}


def test_counts_come_from_the_job_that_writes(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    log = pipeline.Manifest()
    pipeline.run(spark, str(tmp_path), {"diarize": lambda t: spark.range(10, numPartitions=2).mapInArrow(run, "id bigint")}, ["diarize"], log, metrics={"diarize": {"even": F.count_if(F.col("id") % 2 == 0)}})
    assert log.tallies() == {"diarize": {"rows": 10, "even": 5}} and calls.value == 10
    assert pipeline.Manifest.parsed(log.text()).tallies() == log.tallies()


# ---------------------------------------------------------------- stored tables
def test_calls_are_removed_from_stored_tables(spark, tmp_path):
    root, order = str(tmp_path), ["validate", "segment", "filter"]
    rows = [(c, i, f"t{c}-{i}") for c in range(60) for i in range(c % 4 + 1)]
    for stage in order:
        assert tables.write_bucketed(spark.createDataFrame(rows, "call_id bigint, idx int, text string"), f"{root}/{stage}", 8) == {"rows": len(rows)}
    bucket = {r.call_id: r.bucket for r in spark.read.parquet(f"{root}/segment").select("call_id", "bucket").distinct().collect()}
    gone = {3, 17, 42} | {c for c in bucket if bucket[c] == bucket[5]}  # of one bucket nothing stays
    ids = spark.createDataFrame([(c,) for c in gone] + [(999,)], "call_id bigint")
    plan = catalog.Invalidation(ids, ["segment"], order)
    told = {(r.stage, r.bucket): (r.rows, r.gone) for r in plan.remove(spark, root).collect()}
    assert {s for s, _ in told} == {"segment", "filter"} and {b for _, b in told} == {bucket[c] for c in gone}
    assert tables.read_bucketed(spark, f"{root}/segment").count() == len(rows)  # only told so far
    n = sum(r[0] in gone for r in rows)
    assert plan.remove(spark, root, execute=True) == {"segment": n, "filter": n}
    for stage in order:
        left = sorted(tuple(r) for r in tables.read_bucketed(spark, f"{root}/{stage}").select("call_id", "idx", "text").collect())
        assert left == (rows if stage == "validate" else [r for r in rows if r[0] not in gone])
    assert plan.remove(spark, root, execute=True) == {"segment": 0, "filter": 0}  # again: nothing is left to do
    untouched = set(bucket.values()) - {bucket[c] for c in gone}
    assert untouched and all((tmp_path / "segment" / f"bucket={b}").exists() for b in untouched)


# ---------------------------------------------------------------- who speaks
def plain_speaker(t, line):
    held = [x for x in line if x[1] <= t <= x[2]]
    return (held[0] if held else min(line, key=lambda x: min(abs(t - x[1]), abs(t - x[2]))))[3] if line else "UNKNOWN"


@pytest.mark.parametrize("bin_s", [None, 3.0])
def test_lookup_by_steps_is_the_plain_lookup(spark, bin_s):
    rng = random.Random(8)
    lines, words = [], []
    for call in range(25):
        line = []
        for k in range(rng.choice([0, 1, 2, 6, 12])):
            start = rng.randint(0, 40) / 2
            line.append((k, start, start + rng.choice([0, 0.5, 1, 5, 20, -2]), rng.choice("abc")))  # overlaps, points, and one that ends before it begins
        lines += [(call, *x) for x in line]
        words += [(call, i, t) for i, t in enumerate([-7.25, 0.0, 90.5, *(rng.randint(-4, 100) / 4 for _ in range(40)), *(x[1] for x in line), *(x[2] for x in line)])]
    plain = {(c, i): plain_speaker(t, [x[1:] for x in lines if x[0] == c]) for c, i, t in words}
    timeline = spark.createDataFrame([*lines, (0, 99, None, 3.0, "x"), (1, 99, 3.0, None, "x")], "call_id int, ord int, start_s double, end_s double, speaker string").repartition(3)
    points = spark.createDataFrame([*words, (3, 1000, None)], "call_id int, k int, mid_s double").withColumn("next_s", F.lit(1)).repartition(5)
    made = dialogue.speakers_at(points, timeline, bin_s=bin_s)
    assert made.columns == ["call_id", "k", "mid_s", "next_s", "speaker"]
    assert {(r.call_id, r.k): r.speaker for r in made.collect()} == plain | {(3, 1000): "UNKNOWN"}


@pytest.mark.parametrize("bin_s", [None, 600.0])
def test_lookup_in_a_call_of_twenty_thousand_intervals(spark, bin_s):
    rng = np.random.default_rng(4)
    n = 20_000
    start = np.sort(rng.random(n) * 36_000)
    end = start + rng.random(n) * 3
    end[::500] += 5000  # a few that hold a large part of the call
    order = rng.permutation(n)
    line = spark.createDataFrame([("c", int(o), float(s), float(e), f"s{int(o) % 7}") for o, s, e in zip(order, start, end, strict=True)], "call_id string, ord int, start_s double, end_s double, speaker string")
    times = rng.random(3000) * 36_100 - 50
    made = {r.k: r.speaker for r in dialogue.speakers_at(spark.createDataFrame([("c", k, float(t)) for k, t in enumerate(times)], "call_id string, k int, mid_s double"), line, bin_s=bin_s).collect()}
    for k, t in enumerate(times):
        inside = (start <= t) & (t <= end)
        if inside.any():
            best = order[inside].min()
        else:
            away = np.minimum(np.abs(t - start), np.abs(t - end))
            best = order[away == away.min()].min()
        assert made[k] == f"s{best % 7}", (k, t)


def test_steps_of_nested_intervals_cost_what_sorting_costs():
    import time

    took = []
    for n in (20_000, 40_000):
        start = np.arange(n, dtype=float)
        began = time.perf_counter()
        out = dialogue.call_steps(start, 2.0 * n - start, list(range(n)), ["a"] * n)  # each within the one before
        took.append(time.perf_counter() - began)
        assert len(out) == 3  # before, held, after
    assert took[1] < 4 * took[0] + 0.2


# ---------------------------------------------------------------- arriving turns
def test_arriving_turns_and_idle_calls(spark, tmp_path):
    from datetime import datetime, timedelta

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema, start = "call_id string, idx bigint, speaker string, start_s double, end_s double, text string, at timestamp", datetime(2024, 1, 1)
    at = lambda s: start + timedelta(seconds=s)
    parts = [
        [("c", 0, "a", 0.0, 1.0, "x", at(1)), ("c", 2, "a", 2.9, 4.0, "z", at(4))],
        [("c", 1, "a", 1.5, 2.5, "y", at(2)), ("d", 0, "b", 0.0, 1.0, None, at(5)), ("c", 2, "a", 2.9, 4.0, "Z", at(4))],  # late, and one again
        [("e", 0, "b", 0.0, 1.0, "q", at(5000))],  # the watermark passes c and d
        [("e", 1, "b", 1.1, 2.0, "r", at(5001)), ("c", 9, "a", 9.0, 9.5, "w", at(5002))],  # c speaks again
    ]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withWatermark("at", "10 seconds")
        query = arriving.merged_turns(stream, idle_s=60.0).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        query.awaitTermination()
        if k == 0:
            assert [(r.call_id, r.text) for r in arriving.latest(spark.read.parquet(str(tmp_path / "out"))).orderBy("idx").collect()] == [("c", "x"), ("c", "z")]
    made = sorted((r.call_id, r.idx, r.text, r.merged_from, r.first_idx, r.turn) for r in arriving.latest(spark.read.parquet(str(tmp_path / "out"))).collect())
    assert made == [("c", 0, "x y Z", 3, 0, 1), ("c", 1, "w", 1, 9, 2), ("d", 0, "", 1, 0, 1), ("e", 0, "q r", 2, 0, 1)]


def test_a_call_reads_and_writes_its_state_once_a_batch():
    asked = []

    class Value:
        held = None

        def get(self):
            asked.append("get")
            return self.held

        def update(self, value):
            asked.append("update")
            self.held = value

    class Handle:
        def getValueState(self, name, schema):  # noqa: N802
            return Value()

    made = arriving.MergeTurns(0.5, None)
    made.init(Handle())
    list(made.handleInputRows((7,), iter([(7, 2, "a", 2.0, float("nan"), "zé\ud7ff", 0), (7, 0, "a", 0.0, 1.0, None, 0)]), None))
    asked.clear()
    rows = [tuple(r) for r in made.handleInputRows((7,), iter([(7, 1, "a", 1.1, 1.9, "y", 0)]), None)]
    assert asked == ["get", "update"]
    assert rows == [(7, 0, 2, 0, "a", 0.0, None, " y zé\ud7ff", 3, 0, 1)]


# ---------------------------------------------------------------- files
def long_header(samples, rate, filler=200_000):
    whole = wav.encode(samples, rate)
    return whole[:12] + b"LIST" + filler.to_bytes(4, "little") + bytes(filler) + whole[12:]


def test_headers_are_read_by_ranges(spark, tmp_path):
    x = np.zeros(4000, np.float32)
    for name, data in (("a.wav", wav.encode(x, 8000)), ("B.WAV", long_header(x, 16000)), ("c.wav", b"RIFF"), ("d.txt", b"x"), ("e.wav", wav.encode(x, 8000)[:-3000]), ("sub/f.wav", wav.encode(x[:10], 8000))):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    found = {r.path.rpartition("/")[2]: r for r in wavfiles.headers_under(spark, str(tmp_path)).collect()}
    assert set(found) == {"a.wav", "B.WAV", "c.wav", "e.wav"}
    assert (found["a.wav"].duration, found["B.WAV"].duration, found["B.WAV"].frames, found["e.wav"].frames) == (0.5, 0.25, 4000, 2500)
    assert not found["c.wav"].ok and "WAV" in found["c.wav"].error
    few = wavfiles.headers_under(spark, f"file://{tmp_path}", recursive=True).where("length < 3000 AND suffix = 'wav' AND ok")
    assert [r.path.rpartition("/")[2] for r in few.collect()] == ["f.wav"]
    own = {r.call_id: r for r in wav.headers(wav.scan(spark, str(tmp_path))).collect()}
    assert own["B"].frames == 4000 and not own["c"].ok
    read = []
    source = riff.in_memory(long_header(x, 16000))
    assert riff.frames_of(riff.Reader(lambda at, n: read.append(n) or source.read(at, n), source.length)) == (16000, 1, 4000) and sum(read) < 100


def test_pushed_filters_reach_the_listing(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringEndsWith

    for k in range(5):
        (tmp_path / f"{k}.wav").write_bytes(b"x" * k)
    reader = wavfiles.HeaderReader({"path": str(tmp_path), "filesperpartition": "2"})
    assert list(reader.pushFilters([GreaterThan(("length",), 1), EqualTo(("channels",), 2), StringEndsWith(("path",), ".wav")])) == [EqualTo(("channels",), 2)]
    assert [[f.rpartition("/")[2] for f, _ in p.files] for p in reader.partitions()] == [["2.wav", "3.wav"], ["4.wav"]]


def test_files_appear_when_the_job_has_succeeded(spark, tmp_path):
    rows = spark.createDataFrame([(c, f"{k}.wav", bytes([c, k])) for c in range(3) for k in range(4)] + [(9, "none.wav", None)], "call_id int, name string, content binary").repartition(4)
    root = tmp_path / "out"
    wavfiles.write_files(rows, str(root))
    files = {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}
    assert files == {f"{c}/{k}.wav": bytes([c, k]) for c in range(3) for k in range(4)}
    broken = rows.withColumn("content", F.when((F.col("call_id") == 2) & (F.col("name") == "3.wav"), F.raise_error(F.lit("no"))).otherwise(F.col("content")))
    for bad, where in ((broken, tmp_path / "bad"), (rows.unionByName(rows), tmp_path / "twice"), (rows.withColumn("name", F.lit("../../x")), tmp_path / "out2")):
        with pytest.raises(Exception, match="."):
            wavfiles.write_files(bad, str(where))
        assert not [p for p in where.rglob("*") if p.is_file()]
    wavfiles.write_files(rows.where("call_id = 1"), str(root), mode="overwrite")
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()) == [f"1/{k}.wav" for k in range(4)]


def test_broken_documents_and_others_in_one_table(spark, tmp_path):
    for k in range(6):
        text = json.dumps({"call_id": f"c{k}", "mode": "m", "language": "en", "num_speakers": 1, "turns": []}, indent=1)
        (tmp_path / f"c{k}.json").write_text(text if k % 3 else text[: len(text) // 2])
    good, bad = documents.read_documents(spark, str(tmp_path))
    assert sorted(r.call_id for r in good.collect()) == ["c1", "c2", "c4", "c5"] == sorted(r.call_id for r in documents.read_calls(spark, str(tmp_path)).collect())
    answers = spark.createDataFrame([("x", (True, "v", None)), ("y", (False, None, "down"))], "call_id string, answer struct<ok:boolean,value:string,error:string>")
    clips = spark.createDataFrame([("p", None), ("q", "not a WAV file")], "call_id string, error string")
    rows = failures.gathered(bad, failures.of_answers(answers, "validate"), failures.of_rows(clips, "segment")).collect()
    assert sorted((r.stage, r.item.rpartition("/")[2], r.error.partition(":")[0]) for r in rows) == [("read", "c0.json", "not a document"), ("read", "c3.json", "not a document"), ("segment", "q", "not a WAV file"), ("validate", "y", "down")]


def test_decoders_may_raise_anything(spark, tmp_path):
    for name in ("a.mp3", "b.mp3"):
        (tmp_path / name).write_bytes(name.encode())

    def decoder(content):
        if content.startswith(b"a"):
            raise RuntimeError("unknown container")
        return np.full((8000, 1), 0.25, np.float32), 8000

    files = wav.scan(spark, str(tmp_path))
    assert {r.call_id: (r.ok, r.frames) for r in wav.headers(files, decoder).collect()} == {"a": (False, None), "b": (True, 8000)}
    made = {r.call_id: r.error for r in wav.prepare(files, 8000, decoder=decoder).collect()}
    assert made["b"] is None and "unknown container" in made["a"]
    turns = spark.createDataFrame([(c, 0, "s", 0.0, 0.5) for c in "ab"], "call_id string, idx int, speaker string, start_s double, end_s double")
    assert {r.call_id: (r.n_samples, r.error is None) for r in wav.clips(turns, files, decoder).collect()} == {"a": (None, False), "b": (4000, True)}


# ---------------------------------------------------------------- measures
def plain_levels(x, size, hop):
    return np.array([math.sqrt(float(np.mean(np.square(x[i : i + size], dtype=np.float64)))) for i in range(0, len(x) - size + 1, hop)])


@pytest.mark.parametrize(("size", "hop", "n"), [(2048, 512, 70_000), (300, 128, 5000), (4410, 1102, 50_000), (480, 480, 4801), (10, 25, 300), (100, 30, 99), (100, 30, 100)])
def test_levels_by_hops(size, hop, n):
    x = np.random.default_rng(n).standard_normal(n) * np.linspace(1e-4, 1, n)
    energies = measures.Energies(size, hop)
    for at in range(0, n, 777):
        energies.add(x[at : at + 777])
    assert np.allclose(np.sqrt(energies.mean_squares()), plain_levels(x, size, hop), rtol=1e-9, atol=0)


def plain_resample(x, rate, to, taps=32):
    scale = min(1.0, to / rate)
    half = math.ceil(taps / scale)
    out = []
    for k in range(round(len(x) * to / rate)):
        place = k * rate / to
        base = math.floor(k * rate / to + 1e-12)
        d = place - np.arange(base - half, base + half + 1)
        inside = (np.arange(base - half, base + half + 1) >= 0) & (np.arange(base - half, base + half + 1) < len(x))
        kernel = scale * np.sinc(scale * d) * (0.5 + 0.5 * np.cos(np.pi * np.clip(d / (half + 1), -1, 1)))
        out.append(float((kernel[inside] * x[np.arange(base - half, base + half + 1)[inside]]).sum()))
    return np.array(out)


@pytest.mark.parametrize(("rate", "to", "n"), [(48000, 32000, 900), (16000, 24000, 500), (44100, 24000, 1500), (8000, 192000, 60), (192000, 8000, 3000), (24000, 24001, 400), (16000, 24000, 1)])
def test_filter_bank_is_the_plain_sum(rate, to, n):
    x = np.random.default_rng(n).standard_normal(n)
    expected = plain_resample(x, rate, to)
    for size in (7, 250, n):
        bank = measures.Resampler(rate, to)
        made = np.concatenate([*(bank(x[at : at + size]) for at in range(0, n, size)), bank.end()])
        assert len(made) == len(expected) and np.abs(made - expected).max(initial=0) < 1e-6


def test_what_measures_hold_does_not_grow_with_samples():
    import tracemalloc

    most = []
    for seconds in (20, 80):
        meter, levels, bank = measures.Loudness(16000, 1), measures.Energies(2048, 512), measures.Resampler(16000, 24000)
        block = np.random.default_rng(1).standard_normal(1 << 15) * 0.1
        tracemalloc.start()
        for _ in range(seconds * 16000 // len(block)):
            meter.add(block[:, None])
            levels.add(bank(block))
        most.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert math.isfinite(meter.value()) and len(levels.mean_squares())
    assert most[1] < most[0] + 60 * 24000 / 512 * 16 * 4  # two numbers a hop more, not samples


def test_preparing_by_blocks_is_preparing_as_a_whole():
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((90_000, 2)) * np.concatenate([np.full(20_000, 1e-5), np.full(50_000, 0.2), np.full(20_000, 1e-5)])[:, None]).astype(np.float32)
    y = np.stack([wav.resample(c, 16000, 24000) for c in wav.split_channels(x)], axis=1)
    y = wav.normalize(wav.trim(y), 24000)
    blocks = wav.resampled(wav.sliced(x), 2, 16000, 24000)
    frames, snr, bodies = wav.levelled(blocks, 2, 24000, -23.0, -40.0)
    assert frames == len(y) and abs(snr - wav.estimate_snr(y)) < 1e-6
    for body, sound in zip(bodies, (wav.mono(y), y[:, 0], y[:, 1]), strict=True):
        assert np.abs(np.frombuffer(body, "<i2").astype(int) - np.frombuffer(wav.pcm(sound), "<i2").astype(int)).max() <= 1


# ---------------------------------------------------------------- vectors and totals
def test_vector_means_by_partial_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), [rng.random() for _ in range(5)]) for _ in range(200)] + [("z", 1, None), ("a", 1, [None, 1.0]), ("s", 2, [])]
    table = spark.createDataFrame(rows, "k string, j int, v array<double>").repartition(6)
    groups = {}
    for k, j, v in rows:
        if v is not None:
            groups.setdefault((k, j), []).append(v)
    expected = {}
    for key, group in groups.items():
        columns = [[v[i] for v in group if i < len(v) and v[i] is not None] for i in range(max(map(len, group)))]
        expected[key] = [sum(c) / len(c) if c else None for c in columns]
    made = {(r.k, r.j): r.v for r in vectors.mean_vectors(table, ["k", "j"], "v").collect()}
    assert made.keys() == expected.keys() and all([x is None for x in made[g]] == [x is None for x in expected[g]] and [x or 0.0 for x in made[g]] == pytest.approx([x or 0.0 for x in expected[g]]) for g in expected)
    parts = vectors.partial_sums(table, ["k", "j"], "v")
    assert parts.count() <= len(expected) * table.rdd.getNumPartitions()
    plan = vectors.mean_vectors(table, ["k", "j"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    vectors.register(spark)
    table.where("k = 'b' AND size(v) = 5").createOrReplaceTempView("some_vectors")
    assert spark.sql("SELECT mean_vector(v) AS v FROM some_vectors GROUP BY j ORDER BY j").first().v == pytest.approx(expected["b", 1])


def test_rollup_tells_totals_from_unknown_languages(spark):
    rows = spark.createDataFrame([("a", "en-US", 1.0), ("a", "en-GB", 2.0), ("b", None, 4.0)], "call_id string, language string, seconds double")
    made = {(r.stage, r.language, r.level): (r.calls, r.turns, r.seconds) for r in stats.stage_rollup({"x": rows, "y": rows.where("call_id = 'a'")}).collect()}
    assert made == {("x", "en", 0): (1, 2, 3.0), ("x", None, 0): (1, 1, 4.0), ("y", "en", 0): (1, 2, 3.0), ("x", None, 1): (2, 3, 7.0), ("y", None, 1): (1, 2, 3.0), (None, None, 3): (3, 5, 10.0)}
