"""Composite stages: each takes and returns long tables.

Answers of models are written as a table in the shared folder before a stage's tables are made of them: a model is asked once, however many of
these are read, and not again when an executor is lost.  ``validation_answers`` gives them alone, for runs that make them a step of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom import models
from turnloom.functions.text import clip_name
from turnloom.operators import dataset, dialogue, review, screening, voiceprint
from turnloom.plans.tables import stored
from turnloom.schemas import CONTEXT_TURNS, KEEP_MAX, KEEP_MIN, MERGE_GAP, PARSE_RETRIES, SCRUB_BATCH, TURN, VALIDATION_BATCH
from turnloom.sources.documents import write_lines
from turnloom.sources.wavfiles import write_files


def diarize(files: DataFrame, factory: Callable[[], models.Transcriber], num_speakers: int | None = None, language: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transcribe recordings; return turns, calls and the quarantine."""
    heard = models.isolated(files.select("call_id", "content"), "content", "answer", factory, lambda m, x: m.transcribe(x, num_speakers, language))
    good, bad = models.succeeded(stored(heard.drop("content"), "transcripts"), "answer")
    segment = "array<struct<speaker:string,start:double,end:double,text:string>>"
    rows = good.select("call_id", F.posexplode(F.from_json("answer", segment)).alias("seg", "s")).select("call_id", "seg", "s.speaker", F.col("s.start").alias("start_s"), F.col("s.end").alias("end_s"), "s.text")
    turns = dialogue.segments_to_turns(rows)
    calls = dialogue.call_speakers(turns).select("call_id", F.lit(language).alias("language"), "num_speakers")
    return turns, calls, bad


def diarize_words(words: DataFrame, labels: DataFrame, language: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Turns and calls of word-level transcripts with speaker labels; see ``sources.documents.read_cloud_result``."""
    turns = dialogue.words_to_turns(words, labels)
    return turns, dialogue.call_speakers(turns).select("call_id", F.lit(language).alias("language"), "num_speakers")


def diarize_timeline(segments: DataFrame, words: DataFrame, timeline: DataFrame, language: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Turns and calls of segments (call_id, seg, start_s, end_s, text), their words (call_id, seg, mid_s) and a speaker timeline.

    A segment has the speaker of most of its words, or, without words, the one in its middle.
    """
    voted = dialogue.majority_speaker(dialogue.speakers_at(words, timeline), ["call_id", "seg"])
    plain = segments.join(voted.select("call_id", "seg"), ["call_id", "seg"], "left_anti").withColumn("mid_s", (F.col("start_s") + F.col("end_s")) / 2)
    middle = dialogue.speakers_at(plain, timeline).select("call_id", "seg", "speaker")
    turns = dialogue.segments_to_turns(segments.drop("speaker").join(voted.unionByName(middle), ["call_id", "seg"]))
    return turns, dialogue.call_speakers(turns).select("call_id", F.lit(language).alias("language"), "num_speakers")


def diarize_answers(files: DataFrame, factory: Callable[[], models.Transcriber], num_speakers: int | None = None, language: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turns, calls and the quarantine of a model that hears a recording and writes down who says what; its turns have no times."""
    heard = models.isolated(files.select("call_id", "content"), "content", "answer", factory, lambda m, x: m.transcribe(x, num_speakers, language))
    good, bad = models.succeeded(stored(heard.drop("content"), "answers"), "answer")
    turns = review.scored_turns(good.select("call_id", F.col("answer").alias("response")))
    return turns, dialogue.call_speakers(turns).select("call_id", F.lit(language).alias("language"), "num_speakers"), bad


# The modes by name; any other name means the timeline.
BACK_ENDS = {"aws": diarize_words, "whisperx": diarize, "mlx": diarize_timeline, "llamacpp": diarize_answers}


def diarize_by_mode(mode: str, *inputs: object, **options: object) -> tuple[DataFrame, ...]:
    """Turns, calls and, where a model is asked here, the quarantine of the back end that a mode names, with its own inputs."""
    return BACK_ENDS.get(mode, diarize_timeline)(*inputs, **options)


def scrub(turns: DataFrame, factory: Callable[[], models.Scorer], prompt: Callable[[str], str] = lambda body: body, size: int = SCRUB_BATCH) -> tuple[DataFrame, DataFrame]:
    """Remove the turns that the model calls sensitive; return turns and the quarantine of batches, whose turns stay out.

    A call with a batch in quarantine is held back as a whole.
    """
    asked = review.numbered_turns(turns, size)
    answered = models.completed(asked, "prompt", "answer", factory, 20 * size, prompt)
    good, bad = models.succeeded(stored(answered, "scrub-answers"), "answer")
    lines = review.response_lines(good.select("call_id", (F.col("batch") * size).alias("offset"), F.col("answer").alias("response")))
    whole = turns.join(bad.select("call_id").distinct(), "call_id", "left_anti")
    return review.without_sensitive(whole, review.scrub_flags(lines)), bad


def _indexed(row: dict) -> str:
    return f"[{row['idx']}] {row['speaker']} ({row['start_s']:.1f}s - {row['end_s']:.1f}s): {row['text'] or ''}"


def with_context(before: list[dict], turns: list[dict]) -> str:
    """The body of a prompt for turns, after those that were corrected already."""
    parts = ["CORRECTED SO FAR (not to be answered):", *map(_indexed, before), ""] if before else []
    return "\n".join([*parts, *map(_indexed, turns)])


def validation_answers(calls: DataFrame, turns: DataFrame, factory: Callable[[], models.Scorer], allowed: tuple[str, ...] = ("en",), size: int = VALIDATION_BATCH, prompt: Callable[[str], str] = lambda body: body) -> DataFrame:
    """The model's answers (call_id, batch, answer, response: the answer parsed) about the calls that pass the cheap gate.

    Calls of one batch are asked for in batches of prompts; longer ones batch by batch, with the last ``CONTEXT_TURNS`` turns as corrected so
    far.  How long a call is, is a column of its turns, so both ways share one exchange of them.
    """
    gated = review.language_gate(calls, allowed).where("NOT rejected")
    shown = turns.join(gated.select("call_id"), "call_id", "left_semi").select("call_id", "idx", "speaker", "start_s", "end_s", "text")
    sized = shown.withColumn("_top", F.max("idx").over(Window.partitionBy("call_id")))
    short, long = (sized.where(F.col("_top") < size).drop("_top"), sized.where(F.col("_top") >= size).drop("_top"))
    once = models.completed(review.indexed_turns(short, size), "prompt", "answer", factory, 8192, prompt, lambda text: models.assignments_in(text) is not None, PARSE_RETRIES)
    often = models.carried_answers(long, size, CONTEXT_TURNS, factory, lambda before, part: prompt(with_context(before, part)), 8192, PARSE_RETRIES)
    return once.select("call_id", "batch", "answer").unionByName(often).withColumn("response", review.validation_response(F.col("answer")["value"]))


def validate(calls: DataFrame, turns: DataFrame, factory: Callable[[], models.Scorer], allowed: tuple[str, ...] = ("en",), size: int = VALIDATION_BATCH, prompt: Callable[[str], str] = lambda body: body) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Gate calls, let the model correct speakers, and gate again; return calls, turns and the quarantine."""
    return validated(calls, turns, stored(validation_answers(calls, turns, factory, allowed, size, prompt), "validation-answers"), allowed)


def validated(calls: DataFrame, turns: DataFrame, answers: DataFrame, allowed: tuple[str, ...] = ("en",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, turns and the quarantine by a table of answers.

    The cheap gate comes first, so the model sees only calls that pass it.  A call without a usable answer to each of its batches is in
    quarantine: it is neither among the calls nor among the turns.
    """
    gated = review.language_gate(calls, allowed)
    open_calls = gated.where("NOT rejected").drop("reject_reasons", "rejected")
    good, bad = models.succeeded(answers, "answer")
    held = bad.select("call_id").distinct()
    parsed = good.join(held, "call_id", "left_anti").withColumnRenamed("response", "r").where("r IS NOT NULL")
    assigned = parsed.select("call_id", F.posexplode("r.assignments").alias("pos", "a")).select("call_id", F.col("a.index").alias("a_index"), "pos", "a.speaker", "a.name", "a.issues")
    fixed = review.apply_assignments(turns.join(held, "call_id", "left_anti"), assigned)
    timed = review.timing_issues(fixed, dialogue.duration(fixed))
    judged = review.batch_confidence(parsed.select("call_id", "batch", "r.confidence", "r.issues"))
    names = review.speaker_names(fixed)
    passed = review.confidence_gate(open_calls.join(held, "call_id", "left_anti").join(judged, "call_id", "left").withColumn("confidence", F.coalesce("confidence", F.lit(-1.0))).join(names, "call_id", "left"))
    refused = gated.where("rejected")
    return passed.unionByName(refused, allowMissingColumns=True), timed, bad.drop("response")


def segment(turns: DataFrame, max_gap: float = MERGE_GAP) -> DataFrame:
    """Merge turns and number them from 1."""
    merged = dialogue.merge_turns(turns, max_gap)
    return merged.withColumn("duration", F.round(dialogue.duration(merged), 3))


def screen(turns: DataFrame, calls: DataFrame, clips: DataFrame | None = None, shortest: float = KEEP_MIN, longest: float = KEEP_MAX) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop turns and calls; return kept turns, calls with counts and sorted reject reasons, and all turns with their codes.

    File-level rejections and cheap rules come before anything about audio, so clips are judged for what is left only.
    """
    refused = calls.where(screening.file_rejected()).select("call_id")
    open_turns = turns.join(refused, "call_id", "left_anti")
    if clips is not None:
        judged = clips.select("call_id", "idx", F.lit(True).alias("has_audio"), "audio_issue")
        open_turns = open_turns.join(judged, ["call_id", "idx"], "left")
    coded = screening.drop_codes(open_turns, dialogue.duration(open_turns), shortest, longest)
    fate = screening.survivors(coded)
    stated = F.coalesce("reject_reasons", F.array().cast("array<string>"))
    known = calls.select("call_id", *[c for c in ("language",) if c in calls.columns], screening.file_rejected().alias("_refused"), stated.alias("_stated"))
    whole = known.join(fate, "call_id", "left").join(screening.removed_map(coded), "call_id", "left")
    reasons = F.when(F.col("_refused"), F.col("_stated")).otherwise(F.array(F.coalesce("reject_reason", F.when(F.col("original_turn_count").isNull(), F.lit("all_turns_filtered")))))
    whole = whole.withColumn("reject_reasons", screening.sorted_reasons(reasons)).withColumn("rejected", F.size("reject_reasons") > 0).drop("_refused", "_stated")
    return screening.final_turns(coded, fate), whole, coded


def rejections(turns: DataFrame, calls: DataFrame) -> DataFrame:
    """The reject form of calls as ``screen`` returns them: sorted distinct reasons, how many turns there were, and none that are left."""
    before = turns.groupBy("call_id").agg(F.count("*").cast("int").alias("original_turn_count"))
    out = calls.where("rejected").select("call_id", "rejected", "reject_reasons").join(before, "call_id", "left").withColumn("original_turn_count", F.coalesce("original_turn_count", F.lit(0)))
    return out.withColumn("filtered_turn_count", F.lit(0)).withColumn("turns", F.array().cast(f"array<{TURN}>"))


def embed_speakers(turns: DataFrame, clips: DataFrame, factory: Callable[[], models.Encoder], rate: int = 16000) -> DataFrame:
    """Vectors (call_id, speaker, idx, embedding, error) of the longest turns of each speaker; clips: call_id, idx, n_samples, sample_rate, content."""
    top = voiceprint.longest_turns(turns).select("call_id", "speaker", "idx")
    return models.embedded(top.join(clips.select("call_id", "idx", "n_samples", "sample_rate", "content"), ["call_id", "idx"]), factory, rate).drop("content")


def label(turns: DataFrame, vectors: DataFrame, print_: DataFrame, model: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Label turns as me or other by voiceprint; return turns and matches with flags.  vectors: call_id, speaker, idx, embedding."""
    top = voiceprint.longest_turns(turns)
    used = top.join(vectors.select("call_id", "idx", "embedding"), ["call_id", "idx"], "left")
    usable = used.groupBy("call_id", "speaker").agg(F.count("*").alias("usable"))
    means = used.select("call_id", "speaker").distinct().join(voiceprint.speaker_vectors(used), ["call_id", "speaker"], "left")
    matches = voiceprint.quality_flags(voiceprint.best_match(voiceprint.similarities(means, print_, model)), usable)
    return voiceprint.label_turns(turns, matches), matches


def manifests(rows: DataFrame, audio: str = "audio") -> tuple[DataFrame, DataFrame]:
    """The train and the val manifest of exported rows, in order of calls and turns."""
    made = [dataset.manifest(rows.where(F.col("split") == part).orderBy("call_id", "idx"), audio) for part in ("train", "val")]
    return made[0], made[1]


def export_files(rows: DataFrame, clips: DataFrame, root: str, files: int | None = None) -> None:
    """Write a training set: the rows' clips (call_id, idx, content) as files, and both manifests with the paths of these files.

    A row without a clip is left out of the manifest; all files appear together, before the manifests do.
    """
    named = rows.join(clips.where("content IS NOT NULL").select("call_id", "idx", "content"), ["call_id", "idx"]).withColumn("name", clip_name(F.col("call_id"), F.col("idx")))
    kept = stored(named.withColumn("audio", F.concat_ws("/", F.lit(root.rstrip("/")), "split", "name")), "export")
    write_files(kept, root, "split", mode="overwrite")
    for part, made in zip(("train", "val"), manifests(kept), strict=True):
        write_lines(made, f"{root.rstrip('/')}/{part}.jsonl", files)


def export(turns: DataFrame, languages: tuple[str, ...] | None = None, cap: int = 50, share: float = 0.06) -> DataFrame:
    """Rows of the training set: own turns in the chosen languages, capped a call, split into train and val."""
    chosen = dataset.own_turns(turns.where(dataset.in_languages(F.col("language"), languages)))
    return dataset.split(dataset.cap_turns(chosen, cap), share)
