"""Operators against plain restatements on small rows, with the edge cases."""

import json
import math
import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from turnloom import models
from turnloom.functions import text
from turnloom.operators import catalog, checkpoints, dataset, dialogue, review, screening, sets, stats, voiceprint
from turnloom.plans import pipeline, stages
from turnloom.sources import documents, measures, wav, wavfiles
from turnloom.streaming import intake

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests
TURN = "call_id string, idx int, speaker string, start_s double, end_s double, text string"


def random_turns(seed, calls=12):
    rng, rows = random.Random(seed), []
    for c in range(calls):
        at = 0.0
        for i in range(rng.randrange(0, 14)):
            start = round(at + rng.choice([-0.3, 0.0, 0.4, 0.5, 0.6, 2.0]), 3)
            at = round(start + rng.choice([0.2, 0.5, 3.0, 45.0, 61.0]), 3)
            rows.append((f"c{c}", i, rng.choice(["a", "b"]), start, at, f"t{i}"))
    return rows


def plain_merge(rows, gap):
    out = []
    for call, idx, speaker, start, end, words in sorted(rows, key=lambda r: (r[0], r[1])):
        last = out[-1] if out and out[-1][0] == call else None
        if last and last[1] == speaker and start - last[3] <= gap:
            last[3], last[4] = end, last[4] + " " + words
        else:
            out.append([call, speaker, start, end, words])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_turns(spark, seed):
    rows = random_turns(seed)
    made = dialogue.merge_turns(spark.createDataFrame(rows, TURN)).orderBy("call_id", "idx").collect()
    assert [(r.call_id, r.speaker, r.start_s, r.end_s, r.text) for r in made] == plain_merge(rows, 0.5)


def test_merge_turns_keeps_repeated_issues_of_single_turns_only(spark):
    rows = [("c", 0, "a", 0.0, 1.0, "x", ["too_short", "too_short"]), ("c", 1, "b", 1.0, 2.0, "y", ["p"]), ("c", 2, "b", 2.5, 3.0, "z", ["q", "p"]), ("c", 3, "b", 9.0, 9.5, "w", None)]
    made = dialogue.merge_turns(spark.createDataFrame(rows, TURN + ", issues array<string>")).orderBy("idx").collect()
    assert [r.issues for r in made] == [["too_short", "too_short"], ["p", "q"], []]
    assert [r.turn for r in made] == [1, 2, 3]


def test_segments_drop_blank_ones_before_joining(spark):
    rows = [("c", 0, "a", 0.0, 1.0, " hi "), ("c", 1, "b", 1.0, 2.0, "   "), ("c", 2, "a", 2.0, 3.004, "there"), ("c", 3, None, 3.0, 4.0, "who")]
    made = dialogue.segments_to_turns(spark.createDataFrame(rows, "call_id string, seg int, speaker string, start_s double, end_s double, text string")).orderBy("idx").collect()
    assert [(r.speaker, r.start_s, r.end_s, r.text) for r in made] == [("a", 0.0, 3.0, "hi there"), (None, 3.0, 4.0, "who")]


def test_words_to_turns(spark):
    words = [("c", 0, "punctuation", ".", None, None), ("c", 1, "pronunciation", "Hi", "0.1", "0.2"), ("c", 2, "punctuation", ",", None, None), ("c", 3, "pronunciation", "you", "0.3", "0.4"), ("c", 4, "pronunciation", "Yes", "0.5", "0.6"), ("c", 5, "punctuation", ".", None, None)]
    labels = [("c", 0, "a", "0.1"), ("c", 1, "x", "0.5"), ("c", 2, "b", "0.5")]
    made = dialogue.words_to_turns(spark.createDataFrame(words, "call_id string, ord int, kind string, content string, start_time string, end_time string"), spark.createDataFrame(labels, "call_id string, ord int, speaker string, start_time string")).orderBy("idx").collect()
    assert [(r.speaker, r.start_s, r.end_s, r.text) for r in made] == [("a", 0.1, 0.4, "Hi, you"), ("b", 0.5, 0.6, "Yes.")]


def test_speakers_at_prefers_order_then_distance(spark):
    line = [("c", 0, 0.0, 2.0, "a"), ("c", 1, 1.0, 3.0, "b"), ("c", 2, 5.0, 6.0, "d")]
    points = [("c", 0, 1.5), ("c", 1, 3.0), ("c", 2, 4.0), ("c", 3, 99.0), ("z", 4, 1.0)]
    made = dialogue.speakers_at(spark.createDataFrame(points, "call_id string, n int, mid_s double"), spark.createDataFrame(line, "call_id string, ord int, start_s double, end_s double, speaker string")).orderBy("n").collect()
    assert [r.speaker for r in made] == ["a", "b", "b", "d", "UNKNOWN"]


def test_scrub_verdicts(spark):
    answer = "1. clean\n2. not SENSITIVE\n x. SENSITIVE\n2\n3. SENSITIVE\n3. CLEAN. SENSITIVE no\n4. fine"
    lines = review.response_lines(spark.createDataFrame([("c", 20, answer)], "call_id string, offset bigint, response string"))
    made = {r.idx: r.sensitive for r in review.scrub_flags(lines).collect()}
    assert made == {20: False, 21: True, 22: True, 23: False}


@pytest.mark.parametrize(
    ("raw", "prefer", "expected"),
    [
        ('{"a": 1}', "object", {"a": 1}), ('```json\n{"a": 1}\n```', "object", {"a": 1}), ('so: {"a": [1]} ok', "object", {"a": [1]}), ("so: [1, 2] ok", "object", [1, 2]),
        ("{bad} [1]", "object", None), ("none", "object", None), ('x [1, {"a": 2}] y', "array", [1, {"a": 2}]), ("", "object", None),
    ],
)
def test_json_text(spark, raw, prefer, expected):
    got = spark.createDataFrame([(raw,)], "x string").select(text.json_text(F.col("x"), prefer)).first()[0]
    assert (json.loads(got) if got is not None else None) == expected


def test_validation_response_forms(spark):
    raws = ['{"confidence": 0.9, "issues": ["language_mismatch", "made_up"], "assignments": [{"index": 1, "speaker": "a"}]}', '[{"index": 0, "speaker": "b"}]', '{"confidence": 1}', "words"]
    made = [r[0] for r in spark.createDataFrame([(x,) for x in raws], "x string").select(review.validation_response(F.col("x"))).collect()]
    assert (made[0].confidence, made[0].issues, made[0].assignments[0].speaker) == (0.9, ["language_mismatch"], "a")
    assert (made[1].confidence, made[1].issues, made[1].assignments[0]["index"]) == (-1.0, [], 0)
    assert made[2:] == [None, None]


def test_scored_turns_forms(spark):
    raws = [("a", '[{"speaker": "S1", "text": "hi"}, {"speaker": "S2", "text": " "}]'), ("b", "Speaker 1: hello\nSpeaker_2: yes"), ("c", "only words"), ("d", "  ")]
    made = [(r.call_id, r.speaker, r.text) for r in review.scored_turns(spark.createDataFrame(raws, "call_id string, response string")).orderBy("call_id", "idx").collect()]
    assert made == [("a", "S1", "hi"), ("b", "Speaker_1", "hello"), ("b", "Speaker_2", "yes"), ("c", "Speaker_1", "only words")]


def test_gates(spark):
    calls = spark.createDataFrame([("a", "en", 2), ("b", "en-US", 1), ("c", None, 3)], "call_id string, language string, num_speakers int")
    made = {r.call_id: r.reject_reasons for r in review.language_gate(calls).collect()}
    assert made == {"a": [], "b": ["language_not_allowed", "mono_speaker"], "c": ["language_not_allowed"]}
    scored = spark.createDataFrame([("a", 0.6, []), ("b", 0.59, ["nonsensical_conversation"]), ("c", -1.0, None)], "call_id string, confidence double, issues array<string>")
    made = {r.call_id: r.reject_reasons for r in review.confidence_gate(scored).collect()}
    assert made == {"a": [], "b": ["nonsensical_conversation", "low_confidence"], "c": []}


def test_assignments_last_one_counts(spark):
    turns = spark.createDataFrame([("c", 0, "a", 0.0, 1.0, "x"), ("c", 1, "b", 1.0, 2.0, "y")], TURN)
    given = spark.createDataFrame([("c", 0, 0, "q", "Ann", ["garbled_transcript", "made_up"]), ("c", 0, 1, "b", "Bo", []), ("c", 9, 2, "z", "", [])], "call_id string, a_index int, pos int, speaker string, name string, issues array<string>")
    made = review.apply_assignments(turns, given).orderBy("idx").collect()
    assert [(r.speaker, r.name, r.issues, r.changed) for r in made] == [("b", "Bo", [], True), ("b", None, [], False)]
    assert review.speaker_names(review.apply_assignments(turns, given)).first().speaker_names == {"b": "Bo"}


def test_drop_cascade(spark):
    rows = [("c", 0, 10.0, ["too_short", "too_short"], True, None), ("c", 1, 2.9, [], True, "low_energy"), ("c", 2, 45.1, None, True, None), ("c", 3, 3.0, [], False, "low_energy"), ("c", 4, 45.0, [], True, "tail_decay"), ("c", 5, 5.0, ["other"], True, None), ("d", 0, 5.0, [], True, None)]
    turns = spark.createDataFrame(rows, "call_id string, idx int, duration double, issues array<string>, has_audio boolean, audio_issue string").withColumn("start_s", F.lit(0.0)).withColumn("end_s", F.lit(1.0))
    coded = screening.drop_codes(turns, dialogue.duration(turns))
    made = [(r.drop_codes, r.missing_audio, r.kept) for r in coded.where("call_id = 'c'").orderBy("idx").collect()]
    assert made == [(["too_short", "too_short"], False, False), (["too_short"], False, False), (["too_long"], False, False), ([], True, False), (["tail_decay"], False, False), ([], False, True)]
    fate = {r.call_id: r.reject_reason for r in screening.survivors(coded).collect()}
    assert fate == {"c": "single_turn", "d": "single_turn"}
    assert screening.removed_map(coded).first().filter_removed == {"tail_decay": 1, "too_long": 1, "too_short": 3}


def test_voiceprint(spark):
    vectors = [("c", "a", 0, [1.0, 0.0]), ("c", "a", 1, [0.0, 1.0]), ("c", "b", 2, [1.0, 1.0]), ("d", "x", 3, [0.0, 0.0])]
    rows = spark.createDataFrame(vectors, "call_id string, speaker string, idx int, embedding array<float>")
    own = voiceprint.enroll(rows.where("speaker = 'b'"), "m", "s")
    scored = voiceprint.similarities(voiceprint.speaker_vectors(rows), own, "m")
    best = {r.call_id: (r.best_speaker, round(r.best_similarity, 6), r.margin) for r in voiceprint.best_match(scored).collect()}
    assert best["c"][:2] == ("a", 1.0) and abs(best["c"][2]) < 1e-9 and best["d"] == ("x", 0.0, None)
    with pytest.raises(Exception, match="not made by"):
        voiceprint.similarities(voiceprint.speaker_vectors(rows), own, "other").collect()


def test_dataset(spark):
    rows = spark.createDataFrame([(c, i, "me", "en-US" if c % 2 else None, float(i), " x ") for c in range(8) for i in range(6)], "call_id int, idx int, speaker_label string, language string, duration double, text string")
    assert rows.where(dataset.in_languages(F.col("language"), ("en",))).count() == 24
    capped = dataset.cap_turns(dataset.own_turns(rows), 4)
    assert capped.groupBy("call_id").count().agg(F.max("count")).first()[0] == 4
    parts = {r.split: r.n for r in dataset.split(capped, 0.1).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert parts == {"train": 29, "val": 3}
    assert [dataset.holdout_size(n) for n in (0, 20, 21, 25, 75)] == [0, 0, 1, 2, 4]
    assert dataset.cap_turns(rows, 4).exceptAll(dataset.cap_turns(rows.repartition(7), 4)).isEmpty()
    made = dataset.rewritten(dataset.manifest(rows.withColumn("audio", F.lit("a/b.wav")).withColumn("_lang", F.lit("x"))).drop("_lang"), "/r/")
    assert made.first() == ("/r/b.wav", "x", 0.0)
    with pytest.raises(ValueError, match="empty"):
        dataset.checked(made.where("false"))


def test_checkpoints(spark):
    steps = checkpoints.step_numbers(spark.createDataFrame([("step_100",), ("step_200",), ("step_x",), ("step_300",)], "name string"))
    losses = spark.createDataFrame([(95, 0.4), (105, 0.3), (205, 0.2), (330, 0.1)], "step bigint, loss double")
    near = checkpoints.nearest_losses(steps, losses)
    assert sorted((r.step, r.away, r.loss) for r in near.collect()) == [(100, 5, 0.3), (200, 5, 0.2)]
    assert checkpoints.best_step(steps, near).first() == (200, 0.2)
    assert checkpoints.best_step(steps, near.where("false")).first() == (300, None)


def test_catalog(spark):
    calls = spark.createDataFrame([("a", "en", 2, 0.9, False, [], "1"), ("a", "fr", 1, 0.1, True, ["mono_speaker"], "2"), ("b", "HI", 2, 0.5, True, ["low_confidence"], "3")], "call_id string, language string, num_speakers int, confidence double, rejected boolean, reject_reasons array<string>, source string")
    turns = spark.createDataFrame([("a", 0, "x", 0.0, 1.0, "t", ["too_short"])], TURN + ", issues array<string>")
    tables = catalog.shred(calls, turns)
    assert [r.call_id for r in catalog.where(tables, "language = 'en' AND num_turns = 1").collect()] == ["a"]
    assert tables["reject_reasons"].count() == 2
    assert [r.call_id for r in catalog.select_ids(spark, tables, "SELECT call_id FROM calls WHERE language LIKE 'hi%'").collect()] == ["b"]
    assert catalog.any_case("a LIKE 'x like y'") == "a ILIKE 'x like y'"
    with pytest.raises(ValueError, match="queries"):
        catalog.select_ids(spark, tables, "DROP TABLE calls")
    with pytest.raises(Exception):
        catalog.where(tables, "1 = 1; DROP TABLE calls")
    plan = catalog.Invalidation(catalog.where(tables, "call_id = 'a'"), ["validate"], ["validate", "segment"])
    assert {r.stage: r.rows for r in plan.preview({"validate": calls, "segment": turns}).collect()} == {"validate": 2, "segment": 1}
    assert plan.apply({"validate": calls, "segment": turns})["segment"].isEmpty()


def test_small_helpers(spark):
    assert sets.spans("1,3-5", 1, 9) == [1, 3, 4, 5]
    with pytest.raises(ValueError):
        sets.spans("0", 1, 3)
    row = spark.createDataFrame([(1,)], "x int").select(
        text.join_words(F.array(F.lit("Hi"), F.lit(","), F.lit("you"), F.lit("."))), text.clip_name(F.lit("c"), F.lit(7)), text.clip_parts(F.lit("c_turn_1000.wav")), text.duration_text(F.lit(3725.0)), text.bytes_text(F.lit(1_500_000)), text.percent(F.lit(1), F.lit(0)),
        text.call_id_of(F.lit("/in/k/full_normalized.wav")), text.data_uri(F.encode(F.lit("x" * 100), "utf-8")), text.strip(F.lit("  a b \x1f")),
    ).first()
    assert list(row)[:7] == ["Hi, you.", "c_turn_007.wav", None, "1h 2m", "1.5 MB", "n/a", "k"]
    assert "\n" not in row[7] and row[8] == "a b"


def sine(seconds, rate=16000, level=0.5, hz=440):
    return (level * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)).astype(np.float32)


def test_wav_round_trip_and_errors():
    x = np.stack([sine(0.1), sine(0.1, hz=200)], axis=1)
    y, rate = wav.decode(wav.encode(x, 16000))
    assert rate == 16000 and y.shape == x.shape and np.abs(y - x).max() < 1e-4
    whole = wav.encode(x, 16000)
    for bad in (b"", b"RIFFxxxxWAVE", wav.encode(np.zeros(0), 8000), whole[:30], wav.encode(x, 0), whole[:22] + b"\0\0" + whole[24:]):
        with pytest.raises(ValueError):
            wav.decode(bad)
    assert wav.header(whole) == (16000, 2, 1600)
    assert wav.channels_first(x).shape == (2, 1600) and wav.channels_first(x[:, 0]).shape == (1, 1600)


def test_audio_measures():
    x = np.concatenate([np.zeros(16000, np.float32), sine(1.0), np.zeros(16000, np.float32)])
    assert 16000 <= len(wav.trim(x)) <= 16000 + 4 * 2048
    assert len(wav.resample(sine(1.0), 16000, 24000)) == 24000
    assert np.abs(wav.resample(sine(1.0), 16000, 24000)[500:-500] - sine(1.0, 24000)[500:-500]).max() < 5e-3
    assert abs(wav.loudness(wav.normalize(sine(2.0), 16000), 16000) + 23.0) < 0.1
    assert abs(np.abs(wav.normalize(sine(0.1), 16000)).max() - 0.9) < 1e-3
    assert wav.estimate_snr(x) > 40 and wav.estimate_snr(x[:10]) == 0.0
    noisy = (np.random.default_rng(0).standard_normal(60000) * np.linspace(0.01, 0.5, 60000)).astype(np.float32)
    levels = sorted(math.sqrt(float(np.mean(noisy[i * 512 : i * 512 + 2048].astype(np.float64) ** 2))) for i in range(1 + (60000 - 2048) // 512))
    k = len(levels) // 10
    assert k > 5 and abs(wav.estimate_snr(noisy) - 20 * math.log10(sum(levels[-k:]) / sum(levels[:k]))) < 1e-3
    assert [wav.issue(v, 16000) for v in (np.zeros(0, np.float32), np.zeros(16000, np.float32), sine(1.0, level=0.03), sine(0.1), sine(1.0))] == ["mostly_silence", "mostly_silence", "low_energy", "mostly_silence", None]
    assert wav.issue(sine(2.0) * np.linspace(1, 0.1, 32000).astype(np.float32), 16000) == "tail_decay"


def test_recursion_by_blocks_is_exact():
    x = np.random.default_rng(1).standard_normal(2000)
    b, a = np.array([0.5, -0.3, 0.2]), np.array([1.0, -1.2, 0.5])
    y = np.zeros(len(x))
    for i in range(len(x)):
        y[i] = sum(b[k] * x[i - k] for k in range(3) if i >= k) - sum(a[k] * y[i - k] for k in (1, 2) if i >= k)
    for size in (1, 63, 64, 500, 2000):  # whatever the blocks are
        one = measures.Biquad(b, a)
        assert np.abs(np.concatenate([one(x[at : at + size]) for at in range(0, len(x), size)]) - y).max() < 1e-9


def test_audio_stages(spark, tmp_path):
    for name, data in (("a.wav", wav.encode(np.stack([sine(6), sine(6, hz=300)], axis=1), 16000)), ("b.WAV", b"junk"), ("c.txt", b"x")):
        (tmp_path / name).write_bytes(data)
    files = wav.scan(spark, str(tmp_path))
    info = {r.call_id: r for r in wav.headers(wav.whole_calls(files)).collect()}
    assert info["a"].frames == 96000 and info["a"].channels == 2 and not info["b"].ok and len(info) == 2
    made = wav.prepare(files).collect()
    assert sorted(r.part for r in made if r.error is None) == ["channel_0", "channel_1", "full_normalized"] and sum(r.error is not None for r in made) == 1
    turns = spark.createDataFrame([("a", 0, "s", 0.0, 4.0, "x"), ("a", 1, "t", 4.0, 4.1, "y"), ("z", 0, "s", 0.0, 1.0, "q")], TURN)
    audio = spark.createDataFrame([r for r in made if r.part == "full_normalized"], wav.PREPARED)
    about = {r.call_id: r for r in wav.recording_metadata(wav.prepare(files)).collect()}
    assert about["a"].output_files == ["full_normalized.wav", "channel_0.wav", "channel_1.wav"] and about["b"].error and about["b"].output_files == []
    assert (about["a"].original_format, about["a"].output_bit_depth, about["a"].target_lufs, about["a"].processed_at[:2]) == ("wav", 16, -23.0, "20")
    wavfiles.write_files(wav.prepare(files).withColumn("name", F.concat("part", F.lit(".wav"))), str(tmp_path / "out"))
    assert wav.decode((tmp_path / "out" / "a" / "channel_1.wav").read_bytes())[1] == 24000
    assert {r.name for r in wav.under(spark, str(tmp_path / "out")).collect()} == {"a/full_normalized.wav", "a/channel_0.wav", "a/channel_1.wav"}
    broken = audio.unionByName(audio.withColumn("call_id", F.lit("z")).withColumn("content", F.lit(b"RIFF")))
    assert [(r.call_id, r.error) for r in wav.clips(turns, broken).where("error IS NOT NULL").collect()] == [("z", "ValueError: not a WAV file")]
    assert all(r.uri.startswith("data:audio/wav;base64,UklGR") for r in wav.clip_uris(turns, audio).collect())
    clips = {r.idx: r for r in wav.clips(turns, audio).collect()}
    assert clips[0].audio_issue is None and clips[1].audio_issue == "mostly_silence" and len(clips) == 2
    kept, calls, _ = stages.screen(turns, spark.createDataFrame([("a", False, []), ("z", False, [])], "call_id string, rejected boolean, reject_reasons array<string>"), wav.clips(turns, audio))
    assert kept.count() == 0 and calls.where("rejected").count() == 2


class Echo:
    def complete(self, prompts, max_tokens):
        if any("bad" in p for p in prompts):
            raise RuntimeError("down")
        if "[0]" in prompts[0]:
            return ['{"confidence": 0.9, "issues": [], "assignments": [{"index": 0, "speaker": "b", "name": "Bo", "issues": []}]}' if "half" not in p else '{"assignments": [{"index": 0' for p in prompts]
        return ["1. CLEAN\n2. SENSITIVE"] * len(prompts)

    def transcribe(self, content, num_speakers, language):
        return json.dumps([{"speaker": "a", "start": 0.0, "end": 1.0, "text": "hi"}, {"speaker": "b", "start": 1.0, "end": 2.0, "text": "yes"}])


def test_model_stages(spark):
    turns = spark.createDataFrame([("c", 0, "a", 0.0, 5.0, "x"), ("c", 1, "b", 5.0, 9.0, "y"), ("d", 0, "a", 0.0, 1.0, "bad"), ("h", 0, "a", 0.0, 1.0, "half")], TURN)
    clean, failed = stages.scrub(turns, Echo)
    assert [(r.call_id, r.idx) for r in clean.orderBy("call_id", "idx").collect()] == [("c", 0), ("h", 0)]
    assert failed.first().error == "RuntimeError: down"
    calls = spark.createDataFrame([("c", "en", 2), ("d", "en", 2), ("e", "fr", 2), ("h", "en", 2)], "call_id string, language string, num_speakers int")
    judged, fixed, held = stages.validate(calls, turns, Echo)
    assert {r.call_id: (r.rejected, r.reject_reasons) for r in judged.collect()} == {"c": (False, []), "e": (True, ["language_not_allowed"])}
    assert [r.speaker for r in fixed.orderBy("idx").collect()] == ["b", "b"]
    assert {(r.call_id, r.error) for r in held.collect()} == {("d", "RuntimeError: down"), ("h", "not accepted")}
    heard, who, bad = stages.diarize(spark.createDataFrame([("k", b"1")], "call_id string, content binary"), Echo, language="en")
    assert heard.count() == 2 and who.first().num_speakers == 2 and bad.isEmpty()
    tried = models.isolated(turns, "text", "answer", Echo, lambda m, x: m.complete([x], 5)[0], accept=lambda a: False)
    assert {r.error for r in models.succeeded(tried, "answer")[1].collect()} == {"not accepted", "RuntimeError: down"}


def test_models_are_told_apart_and_asked_in_batches(spark):
    made = [lambda: "one", lambda: "two"]
    assert [models.built(f) for f in made] == ["one", "two"] and models.key_of(made[0]) == models.key_of(made[0])
    asked = []

    class Counting:
        def complete(self, prompts, max_tokens):
            asked.append(list(prompts))
            return ["no" if p == "b" and len(asked) < 3 else f"<{p}>" for p in prompts]

    import pandas as pd

    frames = []
    models._with_answers, whole = (lambda rows, out, answers: frames.append(answers(pd.DataFrame({"p": ["a", "b", "c"]})))), models._with_answers
    try:
        models.completed(None, "p", "out", Counting, 9, lambda x: x, lambda a: a != "no")
    finally:
        models._with_answers = whole
    assert asked == [["a", "b", "c"], ["b"], ["b"]] and [x["value"] for x in frames[0]] == ["<a>", "<b>", "<c>"]
    for text, found in (('{"assignments": []}', []), ("```json\n[{\"index\": 1}]\n```", [{"index": 1}]), ('so {"assignments": [{"index": 2}]} ok', [{"index": 2}]), ('{"assignments": [', None), ('{"a": 1}', None), ("assignments", None), ("[1]", None)):
        assert models.assignments_in(text) == found


def test_first_n_of_an_order(spark):
    import random

    from turnloom.operators import dataset

    rng = random.Random(1)
    values = [rng.choice([-(2**63), 2**63 - 1, rng.randrange(-(2**63), 2**63), 7, 7]) for _ in range(300)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "idx int, o bigint")
    plain = sorted((v, i) for i, v in enumerate(values))
    for n in (1, 2, 57, 299, 300):
        assert sorted((r.o, r.idx) for r in dataset.first_n(rows, n, "o", "idx", cells=16, few=3).collect()) == plain[:n]
    assert dataset.first_n(rows.where("false"), 1, "o", "idx").isEmpty()


def test_pipeline_resumes(spark, tmp_path):
    seen = []

    def stage(name, value):
        def run(tables):
            seen.append(name)
            return spark.createDataFrame([(value,)], "x int")

        return run

    def broken(tables):
        raise RuntimeError("no")

    manifest, steps = pipeline.Manifest({"a": 1}), ["diarize", "scrub", "validate"]
    with pytest.raises(RuntimeError):
        pipeline.run(spark, str(tmp_path), {"diarize": stage("diarize", 1), "scrub": stage("scrub", 2), "validate": broken}, steps, manifest)
    assert manifest.rest(steps) == ["validate"] and not manifest.complete("validate")
    again = pipeline.Manifest.parsed(manifest.text())
    assert again.config == {"a": 1} and again.resumed_at
    tables = pipeline.run(spark, str(tmp_path), {"validate": lambda t: t["scrub"]}, again.rest(steps), again)
    assert seen == ["diarize", "scrub"] and tables["validate"].first().x == 2
    root = str(tmp_path / "own")
    for _ in range(2):  # the second run finds the manifest of the first one and only reads
        own = pipeline.run(spark, root, {"diarize": stage("diarize", 5)}, ["diarize"])
        assert own["diarize"].first().x == 5
    assert seen == ["diarize", "scrub", "diarize"] and json.loads((tmp_path / "own" / "manifest.json").read_text())["steps"]["diarize"]["status"] == "complete"
    assert pipeline.chosen_steps("2-4", {"SKIP_SCRUB": "1"}) == ["diarize", "validate"] and pipeline.chosen_steps("label,scrub", {}) == ["scrub", "label"]


def test_stream_intake(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.range(3).withColumnRenamed("id", "call_id").write.parquet(source)
    stream = lambda: intake.new_files(spark, source, "call_id bigint")
    intake.run_available(stream(), out, check, key="call_id")
    spark.range(2, 5).withColumnRenamed("id", "call_id").write.mode("append").parquet(source)
    intake.run_available(stream(), out, check, key="call_id")
    intake.run_available(stream(), out, check, key="call_id")
    assert sorted(r.call_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    plain, log = str(tmp_path / "plain"), str(tmp_path / "log")
    assert intake.run_available(stream(), plain, log) == 1 and intake.run_available(stream(), plain, log) == 0
    assert spark.read.parquet(plain).count() == 6


def test_documents(spark, tmp_path):
    doc = {"call_id": "c", "mode": "m", "language": "en", "num_speakers": 1, "turns": [{"speaker": "a", "start": 0.0, "end": 1.5, "text": "é"}]}
    (tmp_path / "c.json").write_text(json.dumps(doc, indent=1))
    calls = documents.read_calls(spark, str(tmp_path / "c.json"))
    turns = documents.long_turns(calls)
    assert turns.first().text == "é"
    assert documents.nested_calls(calls.drop("turns"), turns).first().turns[0].end == 1.5
    documents.write_lines(spark.createDataFrame([("a.wav", "é", 1.0)], "audio string, text string, duration double"), str(tmp_path / "lines"), 1)
    assert documents.read_lines(spark, str(tmp_path / "lines")).first().text == "é"
    assert [r.split for r in documents.read_manifests(spark, str(tmp_path / "lines"), str(tmp_path / "none")).collect()] == ["train"]
    documents.write_documents(calls.drop("source"), str(tmp_path / "docs"))
    assert documents.read_json(spark, str(tmp_path / "docs" / "call_id=c"), "call_id string, language string").first().language == "en"
    assert documents.read_json(spark, str(tmp_path / "none"), "a int", spark.range(2)).count() == 2
    raw = {"results": {"items": [{"type": "pronunciation", "start_time": "0.10", "end_time": "0.2", "alternatives": [{"content": "Hi"}]}], "speaker_labels": {"segments": [{"speaker_label": "s", "items": [{"start_time": "0.10"}]}]}}}
    (tmp_path / "w.json").write_text(json.dumps(raw))
    words, labels = documents.read_cloud_result(spark, str(tmp_path / "w.json"))
    assert dialogue.words_to_turns(words, labels).first().speaker == "s"


def test_report(spark):
    rows = stats.dashboard([stats.long_form(spark.createDataFrame([(1, 2.5)], "a int, b double"), "x")])
    assert "2.5" in stats.render(rows) and math.isclose(rows.agg(F.sum("value")).first()[0], 3.5)


def test_functions_for_sql(spark):
    from turnloom.functions import vectors

    spark.udtf.register("verdicts", review.verdict_udtf())
    assert [tuple(r) for r in spark.sql("SELECT * FROM verdicts('1. CLEAN\n x\n2. sensitive')").collect()] == [(0, 1, False), (2, 2, True)]
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0])], "k string, v array<double>")
    assert rows.groupBy("k").agg(vectors.mean_vector_udaf()("v").alias("v")).first().v == [2.0, 3.0]


def test_audio_of_calls(spark):
    calls = spark.createDataFrame([("a",), ("b",), ("c",)], "call_id string")
    files = spark.createDataFrame([("a", "/x/a/full_normalized.wav"), ("a", "/x/a.wav"), ("b", "/x/b.wav")], "call_id string, path string")
    made = {r.call_id: (r.path, r.error) for r in wav.audio_of_calls(calls, files).collect()}
    assert made == {"a": ("/x/a/full_normalized.wav", None), "b": ("/x/b.wav", None), "c": (None, "no audio for call c")}
