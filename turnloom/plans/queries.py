"""Queries over the derived calls, one for each operator, with the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.fixtures import Views, duck
from turnloom.functions import signal, text, vectors
from turnloom.operators import catalog, checkpoints, dataset, dialogue, review, screening, sets, stats, voiceprint

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the views under a name, with its SQL."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = duck(sql)
        return f

    return add


def r6(c: str) -> Column:
    return (F.round(c, 6) + 0.0).alias(c)  # no negative zero


@query("g1_call_speakers", "SELECT call_id, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers, CAST(count(DISTINCT speaker) AS INT) AS num_speakers FROM {turns} GROUP BY call_id")
def _(v):
    return dialogue.call_speakers(v.turns).select("call_id", F.array_join("speakers", ",").alias("speakers"), "num_speakers")


@query("g2_text_chars", "SELECT call_id, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM {turns} GROUP BY call_id")
def _(v):
    return dialogue.call_text_chars(v.turns)


@query("g3_turn_duration", "SELECT call_id, idx, round(greatest(0.0, end_s - start_s), 6) AS duration FROM {turns}")
def _(v):
    return v.turns.select("call_id", "idx", F.round(dialogue.duration(v.turns), 6).alias("duration"))


@query("g4_call_span", "SELECT call_id, round(max(end_s) - min(start_s), 6) AS span_s FROM {turns} GROUP BY call_id")
def _(v):
    return dialogue.call_span(v.turns).select("call_id", r6("span_s"))


ISLANDS = """
    WITH s AS ({source}),
    t AS (SELECT *, CASE WHEN {same} THEN 0 ELSE 1 END AS nw FROM s WINDOW w AS (PARTITION BY call_id ORDER BY {order})),
    i AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY call_id ORDER BY {order}) - 1 AS BIGINT) AS island FROM t)
"""


def islands(source: str, same: str, order: str) -> str:
    return ISLANDS.replace("{source}", source).replace("{same}", same).replace("{order}", order)


@query("f1_segments_to_turns", islands("SELECT call_id, seg, speaker, start_s, end_s, trim(text, chr(32)||chr(9)||chr(10)||chr(13)) AS text FROM {segments} WHERE length(trim(text, chr(32)||chr(9)||chr(10)||chr(13))) > 0", "speaker = lag(speaker) OVER w", "seg") + """
    SELECT call_id, island AS idx, arg_min(speaker, seg) AS speaker, round(arg_min(start_s, seg), 6) AS start_s, round(arg_max(end_s, seg), 6) AS end_s, string_agg(text, ' ' ORDER BY seg) AS text FROM i GROUP BY call_id, island""")
def _(v):
    return dialogue.segments_to_turns(v.segments, 6)


ROUNDED = "CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"  # halves up by the number as it is written, as Spark rounds


@query("f1_rounded_turns", islands("SELECT call_id, seg, speaker, start_s, end_s, trim(text, chr(32)||chr(9)||chr(10)||chr(13)) AS text FROM {segments} WHERE length(trim(text, chr(32)||chr(9)||chr(10)||chr(13))) > 0", "speaker = lag(speaker) OVER w", "seg")
    + f" SELECT call_id, island AS idx, {ROUNDED.format(c='arg_min(start_s, seg)')} AS start_s, {ROUNDED.format(c='arg_max(end_s, seg)')} AS end_s FROM i GROUP BY call_id, island")
def _(v):
    return dialogue.segments_to_turns(v.segments).select("call_id", "idx", "start_s", "end_s")


MERGED = islands("SELECT * FROM {turns}", "speaker = lag(speaker) OVER w AND start_s - lag(end_s) OVER w <= 0.5", "idx") + """,
    m AS (SELECT call_id, island AS idx, arg_min(speaker, idx) AS speaker, arg_min(start_s, idx) AS start_s, arg_max(end_s, idx) AS end_s, string_agg(text, ' ' ORDER BY idx) AS text, count(*) AS merged_from, min(idx) AS first_idx FROM i GROUP BY call_id, island)"""


@query("f2_merge_turns", MERGED + " SELECT call_id, idx, speaker, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, text, merged_from, CAST(idx + 1 AS INT) AS turn FROM m")
def _(v):
    return dialogue.merge_turns(v.turns).select("call_id", "idx", "speaker", r6("start_s"), r6("end_s"), "text", "merged_from", "turn")


LABELLED_ITEMS = """
    WITH last_label AS (SELECT call_id, start_time, arg_max(speaker, seg) AS label FROM {word_labels} GROUP BY call_id, start_time),
    known AS (SELECT i.*, last_value(l.label IGNORE NULLS) OVER (PARTITION BY i.call_id ORDER BY i.ord ROWS UNBOUNDED PRECEDING) AS speaker
              FROM {items} i LEFT JOIN last_label l ON l.call_id = i.call_id AND l.start_time = i.start_time)"""


@query("j1_word_speakers", LABELLED_ITEMS + " SELECT call_id, ord, kind, content, speaker FROM known")
def _(v):
    return dialogue.speakers_of_words(v.items, v.word_labels.drop("ord").withColumnRenamed("seg", "ord")).select("call_id", "ord", "kind", "content", "speaker")


@query("f3_words_to_turns", LABELLED_ITEMS + """,
    p AS (SELECT *, last_value(CASE WHEN kind = 'pronunciation' THEN ord END IGNORE NULLS) OVER (PARTITION BY call_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_ord FROM known),
    q AS (SELECT p.*, b.speaker AS before, p.kind = 'pronunciation' AND (p.last_ord IS NULL OR b.speaker IS DISTINCT FROM p.speaker) AS opens FROM p LEFT JOIN known b ON b.call_id = p.call_id AND b.ord = p.last_ord),
    z AS (SELECT *, CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY call_id ORDER BY ord) - 1 AS BIGINT) AS island FROM q),
    y AS (SELECT *, row_number() OVER (PARTITION BY call_id, island ORDER BY ord) AS rn FROM z WHERE island >= 0)
    SELECT call_id, island AS idx, arg_min(speaker, ord) FILTER (kind = 'pronunciation') AS speaker, arg_min(CAST(start_time AS DOUBLE), ord) FILTER (kind = 'pronunciation') AS start_s,
      arg_max(CAST(end_time AS DOUBLE), ord) FILTER (kind = 'pronunciation') AS end_s,
      string_agg(CASE WHEN rn = 1 OR content = '' OR instr('.,!?;:''")-', content) > 0 THEN content ELSE ' ' || content END, '' ORDER BY ord) AS text
    FROM y GROUP BY call_id, island""")
def _(v):
    return dialogue.words_to_turns(v.items, v.word_labels.drop("ord").withColumnRenamed("seg", "ord"))


@query("f4_batches", "SELECT call_id, CAST(floor(idx / 3) AS BIGINT) AS batch, count(*) AS n, CAST(min(idx) AS BIGINT) AS first_idx FROM {turns} GROUP BY ALL")
def _(v):
    return dialogue.batches(v.turns, 3).groupBy("call_id", "batch").agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"))


@query("f8_speaker_samples", "SELECT call_id, speaker, string_agg(substring(text, 1, 80), '|' ORDER BY idx) AS samples, min(idx) AS first_idx FROM (SELECT *, row_number() OVER (PARTITION BY call_id, speaker ORDER BY idx) AS rn FROM {turns}) WHERE rn <= 3 GROUP BY call_id, speaker")
def _(v):
    return dialogue.speaker_samples(v.turns).withColumn("samples", F.array_join("samples", "|"))


LOOKED_UP = """
    WITH r AS (SELECT w.call_id, w.idx, w.k, w.word, t.speaker, row_number() OVER (PARTITION BY w.call_id, w.idx, w.k ORDER BY
        CASE WHEN t.start_s <= w.mid_s AND w.mid_s <= t.end_s THEN 0 ELSE 1 END,
        CASE WHEN t.start_s <= w.mid_s AND w.mid_s <= t.end_s THEN 0.0 ELSE least(abs(w.mid_s - t.start_s), abs(w.mid_s - t.end_s)) END, t.ord) AS rn
      FROM {words} w JOIN {timeline} t ON t.call_id = w.call_id)"""


@query("j2_speaker_lookup", LOOKED_UP + " SELECT call_id, idx, CAST(k AS INT) AS k, word, speaker FROM r WHERE rn = 1")
def _(v):
    return dialogue.speakers_at(v.words, v.timeline).select("call_id", "idx", "k", "word", "speaker")


@query("g5_majority_speaker", LOOKED_UP + ", c AS (SELECT call_id, idx, speaker, count(*) AS n FROM r WHERE rn = 1 GROUP BY ALL) SELECT call_id, idx, speaker FROM (SELECT *, row_number() OVER (PARTITION BY call_id, idx ORDER BY n DESC, speaker) AS q FROM c) WHERE q = 1")
def _(v):
    return dialogue.majority_speaker(dialogue.speakers_at(v.words, v.timeline), ["call_id", "idx"])


FLAGS = "WITH f AS (SELECT call_id, idx, strpos(upper(line), 'SENSITIVE') > 0 AS sensitive FROM {verdicts})"


def _verdict_lines(v: Views) -> DataFrame:
    return v.verdicts.select("call_id", (F.floor(F.col("idx") / 20) * 20).alias("offset"), F.col("idx").alias("line_no"), "line")


@query("x6_scrub_flags", FLAGS + " SELECT * FROM f")
def _(v):
    return review.scrub_flags(_verdict_lines(v))


@query("c2_without_sensitive", FLAGS + " SELECT t.call_id, t.idx, t.speaker FROM {turns} t LEFT JOIN f ON f.call_id = t.call_id AND f.idx = t.idx WHERE NOT coalesce(f.sensitive, false)")
def _(v):
    return review.without_sensitive(v.turns, review.scrub_flags(_verdict_lines(v))).select("call_id", "idx", "speaker")


@query("j11_zip_flags", FLAGS + " SELECT t.call_id, t.idx, coalesce(f.sensitive, false) AS sensitive FROM {turns} t LEFT JOIN f ON f.call_id = t.call_id AND f.idx = t.idx")
def _(v):
    return dialogue.zip_flags(v.turns, review.scrub_flags(_verdict_lines(v)), "sensitive").select("call_id", "idx", "sensitive")


@query("x8_numbered_prompt", "SELECT call_id, CAST(floor(idx / 4) AS BIGINT) AS batch, string_agg(CAST(idx % 4 + 1 AS VARCHAR) || '. [' || speaker || '] ' || text, chr(10) ORDER BY idx) AS prompt, count(*) AS n_turns FROM {turns} GROUP BY ALL")
def _(v):
    return review.numbered_turns(v.turns, 4)


TENTHS = "CAST(({ms} + 50) // 100 // 10 AS VARCHAR) || '.' || CAST(({ms} + 50) // 100 % 10 AS VARCHAR) || 's'"


def tenths(c: str) -> str:
    """SQL of seconds that are whole milliseconds, with one decimal, halves up."""
    return TENTHS.replace("{ms}", f"CAST(round({c} * 1000) AS BIGINT)")


@query("f6_indexed_prompt", f"SELECT call_id, CAST(floor(idx / 4) AS BIGINT) AS batch, string_agg(printf('[%d] %s (', idx, speaker) || {tenths('start_s')} || ' - ' || {tenths('end_s')} || '): ' || text, chr(10) ORDER BY idx) AS prompt, count(*) AS n_turns FROM {{turns}} GROUP BY ALL")
def _(v):
    return review.indexed_turns(v.turns, 4)


@query("x9_language_code", "SELECT doc_id, lower(string_split(upper(lang) || '-XX', '-')[1]) AS code FROM documents")
def _(v):
    return v.documents.select("doc_id", text.language_code(F.concat(F.upper("lang"), F.lit("-XX"))).alias("code"))


@query("c3_language_gate", "SELECT call_id, concat_ws(',', CASE WHEN language NOT IN ('en', 'fr') THEN 'language_not_allowed' END, CASE WHEN num_speakers < 2 THEN 'mono_speaker' END) AS reasons, language NOT IN ('en', 'fr') OR num_speakers < 2 AS rejected FROM {calls}")
def _(v):
    return review.language_gate(v.calls, ("en", "fr")).select("call_id", F.array_join("reject_reasons", ",").alias("reasons"), "rejected")


@query("c4_timing_issues", "SELECT call_id, idx, concat_ws(',', issue, CASE WHEN end_s - start_s < 3 THEN 'too_short' END, CASE WHEN end_s - start_s > 60 THEN 'too_long' END) AS issues FROM {judged}")
def _(v):
    rows = v.judged.withColumn("issues", F.array_compact(F.array("issue")))
    return review.timing_issues(rows, dialogue.duration(rows), 3.0).select("call_id", "idx", F.array_join("issues", ",").alias("issues"))


def _responses(v: Views) -> DataFrame:
    return v.calls.select("call_id").join(v.responses, "call_id", "left").select("call_id", F.coalesce("confidence", F.lit(-1.0)).alias("confidence"), F.when(F.col("file_issue") != "", F.array("file_issue")).otherwise(F.array().cast("array<string>")).alias("issues"))


@query("c6_confidence_gate", "SELECT c.call_id, coalesce(r.confidence, -1.0) AS confidence, concat_ws(',', nullif(r.file_issue, ''), CASE WHEN r.confidence < 0.6 THEN 'low_confidence' END) AS reasons FROM {calls} c LEFT JOIN {responses} r ON r.call_id = c.call_id")
def _(v):
    return review.confidence_gate(_responses(v)).select("call_id", "confidence", F.array_join("reject_reasons", ",").alias("reasons"))


ASSIGNED = """
    WITH a AS (SELECT call_id, a_index, arg_max(speaker, pos) AS speaker, arg_max(name, pos) AS name FROM {assignments} GROUP BY call_id, a_index),
    t2 AS (SELECT t.call_id, t.idx, coalesce(a.speaker, t.speaker) AS speaker, t.speaker AS original_speaker, a.name FROM {turns} t LEFT JOIN a ON a.call_id = t.call_id AND a.a_index = t.idx)"""


@query("j3_assignments", ASSIGNED + " SELECT call_id, idx, speaker, original_speaker, speaker <> original_speaker AS changed FROM t2")
def _(v):
    return review.apply_assignments(v.turns, v.assignments).select("call_id", "idx", "speaker", "original_speaker", "changed")


@query("g10_speaker_names", ASSIGNED + " SELECT call_id, string_agg(speaker || '=' || name, ',' ORDER BY speaker) AS names FROM (SELECT call_id, speaker, arg_max(name, idx) AS name FROM t2 WHERE length(name) > 0 GROUP BY call_id, speaker) GROUP BY call_id")
def _(v):
    named = review.speaker_names(review.apply_assignments(v.turns, v.assignments))
    return named.select("call_id", F.array_join(F.transform(F.array_sort(F.map_entries("speaker_names")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("names"))


@query("g11_change_count", ASSIGNED + " SELECT call_id, count(*) FILTER (speaker <> original_speaker) AS changes FROM t2 GROUP BY call_id")
def _(v):
    return review.apply_assignments(v.turns, v.assignments).groupBy("call_id").agg(F.count_if("changed").alias("changes"))


@query("g7_batch_confidence", """
    WITH b AS (SELECT t.call_id, t.idx AS batch, CASE WHEN t.idx % 3 = 2 THEN -1.0 ELSE r.confidence - CAST(t.idx AS DOUBLE)/100 END AS confidence, CASE WHEN t.idx % 2 = 0 THEN r.file_issue ELSE 'language_mismatch' END AS issue FROM {turns} t JOIN {responses} r ON r.call_id = t.call_id)
    SELECT call_id, round(coalesce(min(confidence) FILTER (confidence >= 0), -1.0), 6) AS confidence, (SELECT string_agg(issue, ',' ORDER BY f) FROM (SELECT issue, min(batch) AS f FROM b b2 WHERE b2.call_id = b.call_id AND issue <> '' GROUP BY issue)) AS issues FROM b GROUP BY call_id""")
def _(v):
    rows = v.turns.join(v.responses, "call_id").select("call_id", F.col("idx").alias("batch"), F.when(F.col("idx") % 3 == 2, -1.0).otherwise(F.col("confidence") - F.col("idx").cast("double") / 100).alias("confidence"), F.array_remove(F.array(F.when(F.col("idx") % 2 == 0, F.col("file_issue")).otherwise("language_mismatch")), "").alias("issues"))
    return review.batch_confidence(rows).select("call_id", r6("confidence"), F.when(F.size("issues") > 0, F.array_join("issues", ",")).alias("issues"))


@query("g9_turn_issue_set", "SELECT call_id, string_agg(DISTINCT issue, ',' ORDER BY issue) AS turn_issues FROM (SELECT call_id, issue FROM {judged} UNION ALL SELECT call_id, audio_issue FROM {judged}) GROUP BY call_id")
def _(v):
    rows = v.judged.withColumn("issues", F.array_compact(F.array("issue", "audio_issue")))
    return review.turn_issue_set(rows).select("call_id", F.when(F.size("turn_issues") > 0, F.array_join("turn_issues", ",")).alias("turn_issues"))


@query("x7_validation_response", """
    SELECT call_id, CASE WHEN call_id % 4 = 3 THEN NULL WHEN call_id % 4 = 2 THEN -1.0 ELSE confidence END AS confidence,
      CASE WHEN call_id % 4 = 3 THEN NULL WHEN call_id % 4 = 2 OR file_issue = '' THEN '' ELSE file_issue END AS issues,
      CASE WHEN call_id % 4 = 3 THEN NULL ELSE (SELECT string_agg(a.a_index || ':' || a.speaker || ':' || a.name, ',' ORDER BY a.a_index, a.pos) FROM {assignments} a WHERE a.call_id = r.call_id) END AS assigned
    FROM {responses} r""")
def _(v):
    one = F.to_json(F.struct(F.col("a_index").alias("index"), "speaker", "name", F.array(F.lit("made_up")).alias("issues")))
    listed = v.assignments.groupBy("call_id").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a_index", "pos", one.alias("body")))), lambda a: a["body"]), ", "), F.lit("]")).alias("list"))
    issues = F.when(F.col("file_issue") == "", F.lit('"made_up"')).otherwise(F.concat(F.lit('"'), "file_issue", F.lit('", "made_up"')))
    body = F.concat(F.lit('{"confidence": '), F.col("confidence").cast("string"), F.lit(', "issues": ['), issues, F.lit('], "assignments": '), "list", F.lit("}"))
    kind = F.col("call_id") % 4
    text_ = F.when(kind == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(kind == 1, F.concat(F.lit("Sure:\n"), body, F.lit("\nDone."))).when(kind == 2, F.col("list")).otherwise(F.concat(F.lit("{broken "), body))
    rows = v.responses.join(listed, "call_id").select("call_id", review.validation_response(text_).alias("r"))
    said = F.transform("r.assignments", lambda a: F.concat_ws(":", a["index"].cast("string"), a["speaker"], a["name"]))
    return rows.select("call_id", "r.confidence", F.array_join("r.issues", ",").alias("issues"), F.array_join(said, ",").alias("assigned"))


@query("x4_json_text", """
    WITH t AS (SELECT conv_id, turn, chr(123) || '"n": ' || turn || ', "text": ' || to_json(text) || chr(125) AS obj, '[' || turn || ', ' || to_json(text) || ']' AS arr FROM conversations),
    o AS (SELECT *, strpos(arr, chr(123)) AS first, CASE WHEN strpos(arr, chr(125)) > 0 THEN length(arr) - strpos(reverse(arr), chr(125)) + 1 ELSE 0 END AS last FROM t),
    p AS (SELECT *, CASE WHEN first > 0 AND last > first THEN substring(arr, first, last - first + 1) END AS inner_ FROM o)
    SELECT conv_id, turn, CASE WHEN turn % 5 = 3 THEN NULL WHEN turn % 5 <> 2 THEN obj WHEN inner_ IS NULL THEN arr WHEN json_valid(inner_) THEN inner_ END AS found FROM p""")
def _(v):
    """Objects and arrays around every given text; brackets in a text count as they stand."""
    quoted = F.regexp_replace(F.to_json(F.struct("text")), r'^\{"text":|\}$', "")
    obj = F.concat(F.lit('{"n": '), F.col("turn").cast("string"), F.lit(', "text": '), quoted, F.lit("}"))
    arr = F.concat(F.lit("["), F.col("turn").cast("string"), F.lit(", "), quoted, F.lit("]"))
    kind = F.col("turn") % 5
    noisy = F.when(kind == 0, F.concat(F.lit("Here: "), obj, F.lit(" ok"))).when(kind == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```"))).when(kind == 2, F.concat(F.lit("So "), arr, F.lit(" it is"))).when(kind == 3, F.concat(F.lit("{bad "), arr, F.lit("}"))).otherwise(obj)
    return v.conversations.select("conv_id", "turn", text.json_text(noisy).alias("found"))


SPOKEN = "trim(regexp_replace(text, '[\\s\\x1c-\\x1f\\x85\\xa0]+', ' ', 'g'))"
SCORED = f"""
    WITH t AS (SELECT call_id, idx, {SPOKEN} AS text FROM {{turns}})
    SELECT call_id * 1000 + idx AS item, CAST(n AS INT) AS pos, CASE WHEN idx % 3 = 2 THEN 'Speaker_1' WHEN idx % 3 = 1 AND n = 1 THEN 'UNKNOWN' ELSE 'Speaker_' || CAST(n + 1 AS VARCHAR) END AS speaker, CASE WHEN n = 0 THEN text ELSE 'yes ' || text END AS text
    FROM t, (SELECT unnest([0, 1]) AS n) WHERE n = 0 OR idx % 3 < 2"""


def scored_answers(v: Views) -> DataFrame:
    """Answers (call_id, response) in each of the three forms about every turn: lines by speaker, a list in a fence, and plain text."""
    said = F.trim(F.regexp_replace("text", r"[\s\x1c-\x1f\x85\xa0]+", " "))
    lines = F.concat(F.lit("Speaker 1: "), said, F.lit("\nSpeaker_2 : yes "), said)
    listed = F.concat(F.lit("```json\n"), F.to_json(F.array(F.struct(F.lit("Speaker_1").alias("speaker"), said.alias("text")), F.struct(F.lit(None).cast("string").alias("speaker"), F.concat(F.lit("yes "), said).alias("text")))), F.lit("\n```"))
    kind = F.col("idx") % 3
    return v.turns.select((F.col("call_id") * 1000 + F.col("idx")).alias("call_id"), F.when(kind == 0, lines).when(kind == 1, listed).otherwise(said).alias("response"))


@query("x5_scored_turns", SCORED)
def _(v):
    return review.scored_turns(scored_answers(v)).select(F.col("call_id").alias("item"), F.col("idx").alias("pos"), "speaker", "text")


CASCADE = """
    WITH d AS (SELECT *, greatest(0.0, end_s - start_s) AS dur FROM {judged}),
    k AS (SELECT call_id, idx, dur, has_audio, CASE WHEN issue IS NOT NULL THEN issue WHEN dur < 3 THEN 'too_short' WHEN dur > 45 THEN 'too_long' WHEN NOT has_audio THEN NULL ELSE audio_issue END AS code,
      issue IS NULL AND dur BETWEEN 3 AND 45 AND NOT has_audio AS missing_audio FROM d),
    s AS (SELECT call_id, count(*) AS original_turn_count, count(*) FILTER (code IS NULL AND NOT missing_audio) AS filtered_turn_count FROM k GROUP BY call_id)"""


def _coded(v: Views) -> DataFrame:
    rows = v.judged.withColumn("issues", F.array_compact(F.array("issue")))
    return screening.drop_codes(rows, dialogue.duration(rows))


@query("c8_drop_cascade", CASCADE + " SELECT call_id, idx, coalesce(code, '') AS codes, missing_audio, code IS NULL AND NOT missing_audio AS kept FROM k")
def _(v):
    return _coded(v).select("call_id", "idx", F.array_join("drop_codes", ",").alias("codes"), "missing_audio", "kept")


@query("c9_survivors", CASCADE + " SELECT *, CASE WHEN filtered_turn_count = 0 THEN 'all_turns_filtered' WHEN filtered_turn_count = 1 THEN 'single_turn' END AS reject_reason, filtered_turn_count <= 1 AS rejected FROM s")
def _(v):
    return screening.survivors(_coded(v))


@query("g6_removed_counts", CASCADE + " SELECT call_id, code, count(*) AS n FROM k WHERE code IS NOT NULL GROUP BY call_id, code")
def _(v):
    return screening.removed_counts(_coded(v))


@query("c16_final_turns", CASCADE + " SELECT k.call_id, k.idx FROM k JOIN s ON s.call_id = k.call_id WHERE k.code IS NULL AND NOT k.missing_audio AND s.filtered_turn_count > 1")
def _(v):
    coded = _coded(v)
    return screening.final_turns(coded, screening.survivors(coded)).select("call_id", "idx")


FRAMES4 = "WITH f AS (SELECT clip_id, CAST(floor(i / 4) AS INT) AS frame, 20 * log10(sqrt(avg(v*v) + 1e-12) + 1e-12) AS db FROM {samples} GROUP BY ALL)"


@query("w7_frame_db", FRAMES4 + " SELECT clip_id, frame, round(db, 4) AS db FROM f")
def _(v):
    return v.clips.select("clip_id", F.posexplode(signal.frame_db(F.col("samples"), 4)).alias("frame", "db")).withColumn("db", F.round("db", 4))


@query("w8_audio_issue", FRAMES4 + """,
    c AS (SELECT clip_id, 20 * log10(sqrt(avg(v*v) + 1e-10) + 1e-12) AS level FROM {samples} GROUP BY clip_id),
    a AS (SELECT clip_id, count(*) FILTER (db > -30) AS speech, avg(db) FILTER (db > -30 AND frame < 5) AS head, avg(db) FILTER (db > -30 AND frame >= 10) AS tail FROM f GROUP BY clip_id)
    SELECT clip_id, CASE WHEN level < -40 THEN 'mostly_silence' WHEN level < -30 THEN 'low_energy' WHEN speech < 10 OR head IS NULL OR tail IS NULL THEN 'mostly_silence' WHEN head - tail > 5 THEN 'tail_decay' END AS issue FROM c JOIN a USING (clip_id)""")
def _(v):
    return v.clips.select("clip_id", signal.audio_issue(F.col("samples"), 4).alias("issue"))


@query("w9_snr", """
    WITH f AS (SELECT s.clip_id, k.frame, sqrt(avg(s.v*s.v)) AS level FROM {samples} s JOIN (SELECT unnest(range(0, 61)) AS frame) k ON s.i >= k.frame AND s.i < k.frame + 4 GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY level) AS rn, count(*) OVER (PARTITION BY clip_id) AS n FROM f)
    SELECT clip_id, round(20 * log10((avg(level) FILTER (rn > n - n // 10) + 1e-10) / (avg(level) FILTER (rn <= n // 10) + 1e-10)), 4) + 0.0 AS snr FROM r GROUP BY clip_id""")
def _(v):
    return v.clips.select("clip_id", (F.round(signal.snr(F.col("samples"), 4, 1), 4) + 0.0).alias("snr"))


@query("w4_trim_bounds", """
    WITH f AS (SELECT s.clip_id, k.frame, 20 * log10(sqrt(avg(s.v*s.v)) + 1e-10) > -25 AS loud FROM {samples} s JOIN (SELECT unnest(range(0, 15)) AS frame) k ON s.i >= k.frame * 4 AND s.i < k.frame * 4 + 8 GROUP BY ALL)
    SELECT clip_id, CAST(coalesce(min(frame) FILTER (loud) * 4, 0) AS BIGINT) AS first, CAST(coalesce(least(64, max(frame) FILTER (loud) * 4 + 8), 64) AS BIGINT) AS last FROM f GROUP BY clip_id""")
def _(v):
    return v.clips.select("clip_id", signal.trim_bounds(F.col("samples"), 8, 4, -25.0).alias("b")).select("clip_id", "b.first", "b.last")


@query("x15_cut", "SELECT clip_id, count(*) FILTER (i >= 10 AND i < 41) AS n, round(sum(v) FILTER (i >= 10 AND i < 41), 6) AS total FROM {samples} GROUP BY clip_id")
def _(v):
    part = signal.cut(F.col("samples"), F.lit(1.05), F.lit(4.19), 10)
    return v.clips.select("clip_id", F.size(part).cast("bigint").alias("n"), F.round(F.aggregate(part, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("w1_to_mono", "SELECT clip_id, round(sum((v + v * v) / 2), 6) AS total, round(max(greatest(-1.0, least(1.0, v * 4))), 6) AS peak FROM {samples} GROUP BY clip_id")
def _(v):
    both = signal.to_mono(F.array(F.col("samples"), F.transform("samples", lambda x: x * x)))
    return v.clips.select("clip_id", F.round(F.aggregate(both, F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.round(F.array_max(signal.clip_samples(F.transform("samples", lambda x: x * 4))), 6).alias("peak"))


@query("s1_longest_turns", "SELECT call_id, idx, speaker, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY call_id, speaker ORDER BY round(end_s - start_s, 6) DESC, idx) AS INT) AS rank FROM {turns}) WHERE rank <= 2")
def _(v):
    rows = v.turns.withColumn("duration", F.round(dialogue.duration(v.turns), 6))
    return voiceprint.longest_turns(rows, k=2).select("call_id", "idx", "speaker", "rank")


MEANS = """
    WITH x AS (SELECT call_id, speaker, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM {vectors}),
    m AS (SELECT call_id, speaker, pos, avg(CAST(x AS DOUBLE)) AS x FROM x GROUP BY ALL),
    p AS (SELECT pos, avg(CAST(x AS DOUBLE)) AS x FROM x WHERE label = 0 GROUP BY pos),
    c AS (SELECT m.call_id, m.speaker, sum(m.x * p.x) / (sqrt(sum(m.x * m.x)) * sqrt(sum(p.x * p.x))) AS similarity FROM m JOIN p ON p.pos = m.pos GROUP BY ALL),
    b AS (SELECT call_id, arg_max(speaker, similarity) AS best_speaker, max(similarity) AS best_similarity, CASE WHEN count(*) > 1 THEN max(similarity) - min(similarity) END AS margin FROM c GROUP BY call_id)"""


def _scored(v: Views) -> DataFrame:
    return voiceprint.similarities(voiceprint.speaker_vectors(v.vectors), voiceprint.enroll(v.vectors.where("label = 0"), "made-up", "label-0"), "made-up")


@query("g12_mean_vector", MEANS + " SELECT call_id, speaker, CAST(pos AS INT) AS pos, round(x, 6) + 0.0 AS x FROM m")
def _(v):
    return voiceprint.speaker_vectors(v.vectors).select("call_id", "speaker", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.round("x", 6) + 0.0)


@query("x14_cosine", MEANS + " SELECT call_id, speaker, round(similarity, 6) + 0.0 AS similarity FROM c")
def _(v):
    return _scored(v).select("call_id", "speaker", r6("similarity"))


@query("s7_best_match", MEANS + " SELECT call_id, best_speaker, round(best_similarity, 6) AS best_similarity, round(margin, 6) AS margin FROM b")
def _(v):
    return voiceprint.best_match(_scored(v)).select("call_id", "best_speaker", r6("best_similarity"), r6("margin"))


@query("p7_quality_flags", MEANS + """, u AS (SELECT call_id, speaker, count(*) FILTER (embedding[1] > 0) AS usable FROM {vectors} GROUP BY ALL)
    SELECT b.call_id, concat_ws(',', CASE WHEN best_similarity < 0.1 THEN 'low_similarity' END, CASE WHEN margin < 0.05 THEN 'ambiguous_match' END,
      (SELECT string_agg('insufficient_audio:' || speaker, ',' ORDER BY speaker) FROM u WHERE u.call_id = b.call_id AND usable > 0 AND usable < 4)) AS flags FROM b""")
def _(v):
    usable = v.vectors.groupBy("call_id", "speaker").agg(F.count_if(F.col("embedding")[0] > 0).alias("usable"))
    return voiceprint.quality_flags(voiceprint.best_match(_scored(v)), usable, 0.1, 0.05, 4).select("call_id", F.array_join("flags", ",").alias("flags"))


@query("j7_label_turns", MEANS + " SELECT t.call_id, t.idx, t.speaker, CASE WHEN t.speaker = b.best_speaker THEN 'me' ELSE 'other' END AS speaker_label FROM {turns} t JOIN b ON b.call_id = t.call_id")
def _(v):
    return voiceprint.label_turns(v.turns, voiceprint.best_match(_scored(v))).select("call_id", "idx", "speaker", "speaker_label")


@query("c11_languages", "SELECT call_id, language FROM {calls} WHERE language LIKE 'en%' OR language LIKE 'fr%'")
def _(v):
    return v.calls.where(dataset.in_languages(F.col("language"), ("en", "fr"))).select("call_id", "language")


OWN = "WITH o AS (SELECT * FROM {labelled} WHERE speaker_label = 'me' AND has_audio AND length(text) > 0), d AS (SELECT *, (call_id*7919 + idx*104729) % 1000003 AS draw FROM o)"


def draw() -> Column:
    """An order that both engines can compute."""
    return (F.col("call_id") * 7919 + F.col("idx") * 104729) % 1000003


@query("c12_own_turns", OWN + " SELECT call_id, idx, language FROM o")
def _(v):
    return dataset.own_turns(v.labelled).select("call_id", "idx", "language")


@query("s3_cap_turns", OWN + " SELECT call_id, idx FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY draw, idx) AS rn FROM d) WHERE rn <= 2")
def _(v):
    return dataset.cap_turns(dataset.own_turns(v.labelled), 2, draw()).select("call_id", "idx")


SPLIT = OWN + ", n AS (SELECT CASE WHEN count(*) <= 20 THEN 0 ELSE greatest(1, CAST(round_even(count(*) * 0.06, 0) AS BIGINT)) END AS n_val FROM o), s AS (SELECT d.*, CASE WHEN row_number() OVER (ORDER BY draw, call_id, idx) <= n.n_val THEN 'val' ELSE 'train' END AS split FROM d, n)"


@query("s4_split", SPLIT + " SELECT call_id, idx, split FROM s")
def _(v):
    return dataset.split(dataset.own_turns(v.labelled), order=draw()).select("call_id", "idx", "split")


@query("g13_language_counts", SPLIT + " SELECT split, language, count(*) AS n FROM s GROUP BY split, language")
def _(v):
    return dataset.language_counts(dataset.split(dataset.own_turns(v.labelled), order=draw()))


@query("g14_call_export_stats", OWN + ", e AS (SELECT call_id, least(2, count(*)) AS n FROM o GROUP BY call_id) SELECT l.call_id, count(*) FILTER (speaker_label <> 'me') AS skipped_other, count(*) FILTER (speaker_label = 'me') AS capped_from, coalesce(max(e.n), 0) AS exported, count(*) FILTER (speaker_label = 'me') > 2 AS capped FROM {labelled} l LEFT JOIN e ON e.call_id = l.call_id GROUP BY l.call_id")
def _(v):
    return dataset.call_export_stats(v.labelled, dataset.cap_turns(dataset.own_turns(v.labelled), 2, draw()), 2)


@query("m12_manifest_rows", "SELECT '/data/' || CAST(call_id AS VARCHAR) || '_turn_' || printf('%03d', idx) || '.wav' AS audio, trim(text, chr(32)||chr(9)||chr(10)||chr(13)) AS text, round(duration, 3) AS duration FROM {labelled} WHERE speaker_label = 'me' AND has_audio")
def _(v):
    rows = dataset.own_turns(v.labelled).withColumn("audio", F.concat(F.lit("old/place/"), text.clip_name(F.col("call_id"), F.col("idx")))).withColumn("_lang", F.col("language"))
    return dataset.rewritten(dataset.public(dataset.manifest(rows)), "/data")


STEPS = "WITH s AS (SELECT DISTINCT step - step % 50 AS step FROM {checkpoints}), m AS (SELECT step, away, loss FROM (SELECT s.step, abs(s.step - c.step) AS away, c.loss, row_number() OVER (PARTITION BY s.step ORDER BY abs(s.step - c.step), c.loss) AS rn FROM s JOIN {checkpoints} c ON c.step BETWEEN s.step - 10 AND s.step + 10) WHERE rn = 1)"


def _steps(v: Views) -> DataFrame:
    names = v.checkpoints.select(F.concat(F.lit("step_"), (F.col("step") - F.col("step") % 50).cast("string")).alias("name")).distinct()
    return checkpoints.step_numbers(names)


@query("j9_nearest_losses", STEPS + " SELECT step, away, loss FROM m")
def _(v):
    return checkpoints.nearest_losses(_steps(v), v.checkpoints)


@query("g25_best_step", STEPS + " SELECT step AS best_step, loss AS best_loss FROM m ORDER BY loss, step LIMIT 1")
def _(v):
    return checkpoints.best_step(_steps(v), checkpoints.nearest_losses(_steps(v), v.checkpoints))


def _catalog(v: Views) -> dict[str, DataFrame]:
    reviewed = review.confidence_gate(_responses(v)).join(v.calls, "call_id")
    rows = v.judged.withColumn("issues", F.array_compact(F.array("issue", "audio_issue")))
    files = v.turns.groupBy("call_id").agg(F.max("end_s").alias("duration"), F.lit(20.0).alias("snr"))
    return catalog.shred(reviewed, rows, files)


ISSUES = "WITH ti AS (SELECT call_id, idx, issue FROM {judged} WHERE issue IS NOT NULL UNION ALL SELECT call_id, idx, audio_issue FROM {judged} WHERE audio_issue IS NOT NULL)"


@query("a12_catalog_calls", "SELECT c.call_id, c.language, c.num_speakers, count(t.idx) AS num_turns, round(max(t.end_s), 6) AS duration FROM {calls} c LEFT JOIN {turns} t ON t.call_id = c.call_id GROUP BY ALL")
def _(v):
    return _catalog(v)["calls"].select("call_id", "language", "num_speakers", "num_turns", r6("duration"))


@query("q2_where", "SELECT DISTINCT call_id FROM {calls} WHERE language LIKE 'f%' AND num_speakers >= 1")
def _(v):
    return catalog.where(_catalog(v), "language LIKE 'f%' AND num_speakers >= 1")


@query("q3_first_column", ISSUES + " SELECT DISTINCT CAST(c.call_id AS VARCHAR) AS call_id FROM {calls} c JOIN ti ON ti.call_id = c.call_id WHERE ti.issue = 'low_energy'")
def _(v):
    return catalog.select_ids(v.spark, _catalog(v), "SELECT c.call_id AS anything, 1 AS more FROM calls c JOIN turn_issues i ON i.call_id = c.call_id WHERE i.issue = 'low_energy'")


@query("q4_any_case_like", ISSUES + " SELECT DISTINCT CAST(call_id AS VARCHAR) AS call_id FROM {calls} WHERE language ILIKE 'E%' AND num_speakers BETWEEN 1 AND 2 AND call_id IN (SELECT call_id FROM ti)")
def _(v):
    return catalog.select_ids(v.spark, _catalog(v), "SELECT call_id FROM calls WHERE language LIKE 'E%' AND num_speakers BETWEEN 1 AND 2 AND call_id IN (SELECT call_id FROM turn_issues)")


@query("g22_issue_counts", ISSUES + " SELECT c.call_id, count(ti.issue) AS n FROM (SELECT DISTINCT call_id FROM {calls}) c LEFT JOIN ti ON ti.call_id = c.call_id GROUP BY c.call_id")
def _(v):
    tables = _catalog(v)
    return catalog.issue_counts(tables, tables["calls"].select("call_id"))


GONE = "SELECT '{what}' AS what, '{stage}' AS stage, count(*) AS rows FROM {table} t LEFT JOIN {calls} c ON c.call_id = t.call_id WHERE {cond}"


def gone(what: str, stage: str, table: str, cond: str) -> str:
    """SQL of the rows of a stage that go or stay."""
    return GONE.replace("{what}", what).replace("{stage}", stage).replace("{table}", table).replace("{cond}", cond)


@query("b12_invalidation", " UNION ALL ".join([
    gone("goes", "segment", "{turns}", "c.language = 'de'"), gone("goes", "filter", "{judged}", "c.language = 'de'"),
    gone("stays", "validate", "{calls}", "true"), gone("stays", "segment", "{turns}", "c.language IS DISTINCT FROM 'de'"), gone("stays", "filter", "{judged}", "c.language IS DISTINCT FROM 'de'"),
]))
def _(v):
    tables = {"validate": v.calls, "segment": v.turns, "filter": v.judged}
    plan = catalog.Invalidation(catalog.where(_catalog(v), "language = 'de'"), ["segment"], ["validate", "segment", "filter"])
    out = plan.preview(tables).select(F.lit("goes").alias("what"), "stage", "rows")
    for stage, left in plan.apply(tables).items():
        out = out.unionByName(left.agg(F.count("*").alias("rows")).select(F.lit("stays").alias("what"), F.lit(stage).alias("stage"), "rows"))
    return out


@query("q6_listing", ISSUES + " SELECT c.call_id, count(ti.issue) AS n FROM (SELECT DISTINCT call_id FROM {calls} WHERE language = 'fr') c LEFT JOIN ti ON ti.call_id = c.call_id GROUP BY c.call_id")
def _(v):
    tables = _catalog(v)
    return catalog.Invalidation(catalog.where(tables, "language = 'fr'"), ["segment"], ["segment"]).listing(tables)


@query("u3_first_wins", "SELECT text_len, min(doc_id) AS doc_id FROM (SELECT length(text) AS text_len, doc_id FROM documents) GROUP BY text_len")
def _(v):
    return sets.first_rows(v.documents.select(F.length("text").cast("bigint").alias("text_len"), "doc_id"), ["text_len"], "doc_id")


@query("u5_pending", "SELECT call_id FROM {calls} WHERE call_id NOT IN (SELECT call_id FROM {responses})")
def _(v):
    return sets.pending(v.calls, v.responses).select("call_id")


@query("u6_ordered_distinct", "SELECT call_id, string_agg(speaker, ',' ORDER BY f) AS speakers FROM (SELECT call_id, speaker, min(idx) AS f FROM {turns} GROUP BY ALL) GROUP BY call_id")
def _(v):
    return v.turns.groupBy("call_id").agg(F.array_join(F.array_distinct(dialogue.in_order("speaker", "idx")), ",").alias("speakers"))


LANGS = "WITH l AS (SELECT language AS lang, sum(duration) AS d FROM {labelled} GROUP BY language), k AS (SELECT *, row_number() OVER (ORDER BY d DESC, lang) AS rn FROM l), g AS (SELECT CASE WHEN rn <= 2 AND d >= 1 THEN lang ELSE 'other' END AS label, sum(d) AS seconds FROM k GROUP BY 1)"


@query("g15_language_totals", LANGS + " SELECT label, round(seconds, 3) AS seconds, round(seconds / sum(seconds) OVER (), 6) AS share FROM g WHERE label <> 'other' OR seconds >= 1")
def _(v):
    return stats.language_totals(v.labelled, "language", "duration", 2).select("label", F.round("seconds", 3).alias("seconds"), r6("share"))


def long_sql(stage: str, source: str, metrics: dict[str, str]) -> str:
    """SQL of a one-row aggregate as rows (stage, metric, value)."""
    return " UNION ALL ".join(f"SELECT '{stage}' AS stage, '{m}' AS metric, round(CAST({e} AS DOUBLE), 3) AS value FROM {source}" for m, e in metrics.items())


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", F.round("value", 3))


@query("g16_preprocess_stats", "WITH f AS (SELECT call_id, max(end_s) AS duration, sum(length(text)) AS length FROM {turns} GROUP BY call_id) " + long_sql("preprocess", "f", {"files": "count(*)", "seconds": "sum(duration)", "bytes": "sum(length)"}))
def _(v):
    return _rounded(stats.preprocess_stats(v.turns.groupBy("call_id").agg(F.max("end_s").alias("duration"), F.sum(F.length("text")).alias("length"))))


@query("g17_review_stats", "WITH s AS (SELECT call_id, count(*) AS num_turns, max(end_s) - min(start_s) AS seconds FROM {turns} GROUP BY call_id), c AS (SELECT s.*, coalesce(r.confidence < 0.6 OR r.file_issue <> '', false) AS rejected FROM s JOIN {calls} USING (call_id) LEFT JOIN {responses} r ON r.call_id = s.call_id) " + long_sql("validate", "c", {"calls": "count(*)", "turns": "sum(num_turns)", "seconds": "sum(seconds)", "accepted": "count(*) FILTER (NOT rejected)", "rejected": "count(*) FILTER (rejected)"}))
def _(v):
    size = v.turns.groupBy("call_id").agg(F.count("*").alias("num_turns"))
    rows = review.confidence_gate(_responses(v)).join(size, "call_id").join(dialogue.call_span(v.turns), "call_id").withColumn("total_duration", F.lit(None).cast("double")).withColumn("duration", F.lit(None).cast("double"))
    return _rounded(stats.review_stats(rows.withColumn("seconds", stats.call_seconds())))


@query("g18_screening_stats", CASCADE + ", x AS (SELECT *, filtered_turn_count > 1 AS ok FROM s) " + long_sql("filter", "x", {"calls": "count(*)", "accepted": "count(*) FILTER (ok)", "kept": "coalesce(sum(filtered_turn_count) FILTER (ok), 0)", "removed": "coalesce(sum(original_turn_count - filtered_turn_count) FILTER (ok), 0)", "keep_rate": "sum(filtered_turn_count) FILTER (ok) / sum(original_turn_count) FILTER (ok)", "turns_per_call": "avg(filtered_turn_count) FILTER (ok)"}))
def _(v):
    return _rounded(stats.screening_stats(screening.survivors(_coded(v))))


@query("g19_segment_stats", MERGED + ", c AS (SELECT call_id, count(*) AS n, max(end_s) - min(start_s) AS seconds FROM m GROUP BY call_id) " + long_sql("segment", "c", {"calls": "count(*)", "turns": "sum(n)", "seconds": "sum(seconds)"}) + " UNION ALL SELECT 'segment', 'mean_bytes', round(avg(length(text)), 3) FROM m")
def _(v):
    merged = dialogue.merge_turns(v.turns)
    calls = merged.groupBy("call_id").agg(F.count("*").alias("num_turns"), (F.max("end_s") - F.min("start_s")).alias("seconds"))
    return _rounded(stats.segment_stats(calls, merged.select(F.length("text").alias("length"))))


@query("g20_label_stats", LANGS.replace("FROM {labelled}", "FROM {labelled} WHERE speaker_label = 'me'") + ", x AS (SELECT * FROM {labelled}) " + long_sql("label", "x", {"me_turns": "count(*) FILTER (speaker_label = 'me')", "other_turns": "count(*) FILTER (speaker_label <> 'me')", "me_seconds": "sum(duration) FILTER (speaker_label = 'me')"}) + """
    UNION ALL SELECT 'label', 'flagged_calls', CAST(count(*) FILTER (num_speakers < 2 OR language = 'de') AS DOUBLE) FROM {calls}
    UNION ALL SELECT 'label', 'flag:low_similarity', CAST(count(*) AS DOUBLE) FROM {calls} WHERE num_speakers < 2 HAVING count(*) > 0
    UNION ALL SELECT 'label', 'flag:ambiguous_match', CAST(count(*) AS DOUBLE) FROM {calls} WHERE language = 'de' HAVING count(*) > 0
    UNION ALL SELECT 'label', 'me_seconds:' || label, round(seconds, 3) FROM g WHERE label <> 'other' OR seconds >= 1""")
def _(v):
    flags = v.calls.select("call_id", F.array_compact(F.array(F.when(F.col("num_speakers") < 2, F.lit("low_similarity")), F.when(F.col("language") == "de", F.lit("ambiguous_match")))).alias("flags"))
    return _rounded(stats.label_stats(v.labelled, flags, 2))


@query("g21_export_stats", SPLIT + " SELECT 'finetune' AS stage, split || '_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM s GROUP BY split UNION ALL SELECT 'finetune', split || '_seconds', 0.0 FROM s GROUP BY split UNION ALL SELECT 'finetune', 'seconds', round(sum(duration), 3) FROM {labelled}")
def _(v):
    rows = dataset.split(dataset.own_turns(v.labelled), order=draw()).withColumn("duration", F.lit(None).cast("double"))
    return _rounded(stats.export_stats(rows, v.labelled.select("duration")))


@query("s5_reason_ranks", "WITH r AS (SELECT file_issue AS reason FROM {responses} WHERE file_issue <> '' UNION ALL SELECT 'low_confidence' FROM {responses} WHERE confidence < 0.6) SELECT reason, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, reason) AS INT) AS rank FROM r GROUP BY reason")
def _(v):
    return stats.reason_ranks(review.confidence_gate(_responses(v)).select(F.explode("reject_reasons").alias("reason")))


@query("x10_formats", """SELECT doc_id, CASE WHEN n_chars IS NULL THEN 'n/a' WHEN n_chars >= 1000000000 THEN CAST((n_chars + 5000000) // 1000000000 AS VARCHAR) || printf('.%02d GB', (n_chars + 5000000) // 10000000 % 100)
    WHEN n_chars >= 1000000 THEN CAST((n_chars + 50000) // 1000000 AS VARCHAR) || printf('.%d MB', (n_chars + 50000) // 100000 % 10) WHEN n_chars >= 1000 THEN CAST((n_chars + 50) // 1000 AS VARCHAR) || printf('.%d KB', (n_chars + 50) // 100 % 10)
    ELSE printf('%d B', n_chars) END AS size,
    CASE WHEN n_chars >= 3600 THEN printf('%dh %dm', n_chars // 3600, (n_chars % 3600) // 60) WHEN n_chars >= 60 THEN printf('%dm %ds', n_chars // 60, n_chars % 60) WHEN n_chars IS NOT NULL THEN printf('%.1fs', CAST(n_chars AS DOUBLE)) END AS duration FROM documents""")
def _(v):
    return v.documents.select("doc_id", text.bytes_text(F.col("n_chars")).alias("size"), text.duration_text(F.col("n_chars")).alias("duration"))


@query("x11_clip_names", "SELECT call_id, idx, CAST(call_id AS VARCHAR) || '_turn_' || printf('%03d', idx) || '.wav' AS name, CAST(idx AS INT) AS turn FROM {turns}")
def _(v):
    name = text.clip_name(F.col("call_id"), F.col("idx"))
    return v.turns.select("call_id", "idx", name.alias("name"), text.clip_parts(name)["turn"].alias("turn"))


@query("x2_join_words", """SELECT conv_id, turn, array_to_string(list_transform(string_split(text, ' '), lambda w, i: CASE WHEN i = 1 OR strpos('.,!?;:''")-', w) > 0 THEN w ELSE ' ' || w END), '') AS joined FROM conversations""")
def _(v):
    return v.conversations.select("conv_id", "turn", text.join_words(F.split("text", " ")).alias("joined"))


@query("a8_call_ids", "SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN CAST(vec_id AS VARCHAR) ELSE 'clip.' || CAST(vec_id AS VARCHAR) END AS call_id FROM embeddings")
def _(v):
    path = F.when(F.col("vec_id") % 2 == 0, F.concat(F.lit("/in/"), F.col("vec_id").cast("string"), F.lit("/full_normalized.wav"))).otherwise(F.concat(F.lit("/in/clip."), F.col("vec_id").cast("string"), F.lit(".WAV")))
    return v.embeddings.select("vec_id", text.call_id_of(path).alias("call_id"))


CURATED = MERGED + """,
    d AS (SELECT *, round(greatest(0.0, end_s - start_s), 3) AS dur FROM m),
    k AS (SELECT *, CASE WHEN dur < 3 THEN 'too_short' WHEN dur > 45 THEN 'too_long' END AS code FROM d)
    SELECT k.call_id, c.language, count(*) AS original_turn_count, count(*) FILTER (code IS NULL) AS filtered_turn_count, count(*) FILTER (code = 'too_short') AS too_short, count(*) FILTER (code = 'too_long') AS too_long,
      count(*) FILTER (code IS NULL) <= 1 AS rejected FROM k JOIN {calls} c ON c.call_id = k.call_id GROUP BY k.call_id, c.language"""


@query("p_curation", CURATED)
def curation(v):
    """Per call: merged turns, kept turns, removal counts and the verdict."""
    from turnloom.plans import stages

    _, calls, _ = stages.screen(stages.segment(v.turns), v.calls.withColumn("rejected", F.lit(False)).withColumn("reject_reasons", F.array().cast("array<string>")))
    count = lambda code: F.coalesce(F.try_element_at("filter_removed", F.lit(code)), F.lit(0)).cast("bigint").alias(code)
    return calls.select("call_id", "language", "original_turn_count", "filtered_turn_count", count("too_short"), count("too_long"), "rejected")


@query("p_wav_round_trip", "SELECT clip_id, count(*) AS frames, CAST(sum(trunc(v * 16384)) AS BIGINT) AS total FROM {samples} GROUP BY clip_id")
def _(v):
    from turnloom.sources import wav

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            # samples on the grid of 16 bits, so that the round trip is exact
            sounds = [wav.decode(wav.encode(np.trunc(np.array(x) * 16384) / 32767, 16000))[0][:, 0] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sounds], pa.int64()), pa.array([round(float((s.astype("float64") * 32768).sum())) for s in sounds], pa.int64())], names=["clip_id", "frames", "total"])

    return v.clips.mapInArrow(run, "clip_id bigint, frames bigint, total bigint")


@query("m5_isolation", "SELECT call_id, idx, idx % 4 <> 3 AS ok FROM {turns}")
def _(v):
    from turnloom import models

    def factory():
        return None

    def call(_, x):
        if x % 4 == 3:
            raise RuntimeError("refused")
        return str(x)

    return models.isolated(v.turns.select("call_id", "idx"), "idx", "answer", factory, call).select("call_id", "idx", "answer.ok")


@query("f5_carried_context", """
    WITH RECURSIVE n AS (SELECT *, CAST(row_number() OVER (PARTITION BY call_id ORDER BY idx) - 1 AS BIGINT) AS k FROM {turns}),
    r AS (SELECT call_id, idx, k, CASE WHEN length(text) % 2 = 0 THEN 'spk_0' ELSE speaker END AS speaker FROM n WHERE k < 2
      UNION ALL SELECT n.call_id, n.idx, n.k, CASE WHEN length(n.text) % 2 = 0 THEN r.speaker ELSE n.speaker END FROM r JOIN n ON n.call_id = r.call_id AND n.k = r.k + 2)
    SELECT call_id, idx, speaker FROM r""")
def _(v):
    """The stand-in model gives a turn of even length the speaker that the turn two before has now: a chain through all batches."""
    from turnloom import models

    def factory():
        return None

    def call(_, before, part):
        own = [None, None, *before][-2:] if len(before) >= 2 else [None, None]
        made = []
        for row in part:
            old = own[len(made)]
            made.append((old["speaker"] if old else "spk_0") if len(row["text"]) % 2 == 0 else row["speaker"])
        return made

    return models.carried(v.turns.select("call_id", "idx", "speaker", "text"), 2, 10, factory, call).select("call_id", "idx", "speaker")


WORD_TURNS = ORACLES["f3_words_to_turns"]


@query("p2_word_calls")
def _(v):
    from turnloom.plans import stages

    return stages.diarize_words(v.items, v.word_labels.drop("ord").withColumnRenamed("seg", "ord"), "en")[1]


ORACLES["p2_word_calls"] = f"SELECT call_id, 'en' AS language, CAST(count(DISTINCT speaker) AS INT) AS num_speakers FROM ({WORD_TURNS}) GROUP BY call_id"


@query("p2_timeline_turns", LOOKED_UP + """,
    c AS (SELECT call_id, idx, speaker, count(*) AS n FROM r WHERE rn = 1 GROUP BY ALL),
    m AS (SELECT call_id, idx * 2 AS seg, speaker FROM (SELECT *, row_number() OVER (PARTITION BY call_id, idx ORDER BY n DESC, speaker) AS q FROM c) WHERE q = 1),
    z AS (SELECT s.call_id, s.seg, t.speaker, row_number() OVER (PARTITION BY s.call_id, s.seg ORDER BY CASE WHEN t.start_s <= s.mid AND s.mid <= t.end_s THEN 0 ELSE 1 END,
        CASE WHEN t.start_s <= s.mid AND s.mid <= t.end_s THEN 0.0 ELSE least(abs(s.mid - t.start_s), abs(s.mid - t.end_s)) END, t.ord) AS rn
      FROM (SELECT call_id, idx * 2 + 1 AS seg, (start_s + end_s) / 2 AS mid FROM {turns}) s JOIN {timeline} t ON t.call_id = s.call_id),
    k AS (SELECT call_id, seg, speaker FROM m UNION ALL SELECT call_id, seg, speaker FROM z WHERE rn = 1),
    g AS (SELECT call_id, idx * 2 AS seg, text FROM {turns} UNION ALL SELECT call_id, idx * 2 + 1, 'yes' FROM {turns}),
    s AS (SELECT g.call_id, g.seg, k.speaker, trim(g.text, chr(32)||chr(9)||chr(10)||chr(13)) AS text FROM g JOIN k ON k.call_id = g.call_id AND k.seg = g.seg WHERE length(trim(g.text, chr(32)||chr(9)||chr(10)||chr(13))) > 0),
    b AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER w THEN 0 ELSE 1 END AS nw FROM s WINDOW w AS (PARTITION BY call_id ORDER BY seg)),
    i AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY call_id ORDER BY seg) - 1 AS BIGINT) AS island FROM b)
    SELECT call_id, island AS idx, arg_min(speaker, seg) AS speaker, string_agg(text, ' ' ORDER BY seg) AS text FROM i GROUP BY call_id, island""")
def _(v):
    """Each turn is a segment with all its words, and another one without any, whose speaker is the one in its middle."""
    from turnloom.plans import stages

    spoken = v.turns.select("call_id", (F.col("idx") * 2).alias("seg"), "start_s", "end_s", "text")
    segments = spoken.unionByName(spoken.withColumn("seg", F.col("seg") + 1).withColumn("text", F.lit("yes")))
    words = v.words.select("call_id", (F.col("idx") * 2).alias("seg"), "mid_s")
    return stages.diarize_timeline(segments, words, v.timeline)[0].select("call_id", "idx", "speaker", "text")


class _Reviewer:
    """A stand-in model: it answers from what the prompt shows, so the SQL can say what it answers."""

    def complete(self, prompts, max_tokens):
        import json
        import re

        out = []
        for p in prompts:
            shown = re.findall(r"(?m)^\[(\d+)\] (\S+) \(", p)
            start = int(shown[-1][0]) // 4 * 4
            before, rows = [r for r in shown if int(r[0]) < start], [r for r in shown if int(r[0]) >= start]
            first = before[-1][1] if before else rows[0][1]
            made = [{"index": int(i), "speaker": first if int(i) % 2 == 0 else s, "name": "", "issues": []} for i, s in rows]
            out.append("none" if len(rows) == 3 else json.dumps({"confidence": 0.5 if len(rows) == 1 else 0.9, "issues": [], "assignments": made}))
        return out


BLOCKS3 = """
    WITH RECURSIVE o AS (SELECT t.* FROM {turns} t JOIN {calls} c ON c.call_id = t.call_id WHERE c.language IN ('en', 'fr') AND c.num_speakers >= 2),
    n AS (SELECT call_id, count(*) AS n FROM o GROUP BY call_id),
    r AS (SELECT o.call_id, o.idx, o.speaker AS first, o.speaker FROM o WHERE o.idx = 0
      UNION ALL SELECT o.call_id, o.idx, CASE WHEN o.idx % 4 = 0 THEN r.speaker ELSE r.first END, CASE WHEN o.idx % 2 = 0 THEN CASE WHEN o.idx % 4 = 0 THEN r.speaker ELSE r.first END ELSE o.speaker END
      FROM r JOIN o ON o.call_id = r.call_id AND o.idx = r.idx + 1),
    held AS (SELECT call_id FROM n WHERE n % 4 = 3)"""


@query("p4_validated_turns", BLOCKS3 + " SELECT t.call_id, t.idx, coalesce(r.speaker, t.speaker) AS speaker FROM {turns} t LEFT JOIN r ON r.call_id = t.call_id AND r.idx = t.idx WHERE t.call_id NOT IN (SELECT call_id FROM held)")
def _(v):
    from turnloom.plans import stages

    return stages.validate(v.calls, v.turns, _Reviewer, ("en", "fr"), 4)[1].select("call_id", "idx", "speaker")


@query("p4_validated_calls", BLOCKS3 + """
    SELECT c.call_id, concat_ws(',', CASE WHEN language NOT IN ('en', 'fr') THEN 'language_not_allowed' END, CASE WHEN num_speakers < 2 THEN 'mono_speaker' END, CASE WHEN n.n % 4 = 1 THEN 'low_confidence' END) AS reasons,
      CAST(CASE WHEN n.n IS NULL THEN NULL WHEN n.n % 4 = 1 THEN 0.5 ELSE 0.9 END AS DOUBLE) AS confidence
    FROM {calls} c LEFT JOIN n ON n.call_id = c.call_id WHERE c.call_id NOT IN (SELECT call_id FROM held)""")
def _(v):
    from turnloom.plans import stages

    return stages.validate(v.calls, v.turns, _Reviewer, ("en", "fr"), 4)[0].select("call_id", F.array_join("reject_reasons", ",").alias("reasons"), "confidence")


@query("m5_quarantine", BLOCKS3 + " SELECT call_id, CAST(n // 4 AS BIGINT) AS batch, 'not accepted' AS error FROM n WHERE n % 4 = 3")
def _(v):
    from turnloom.plans import stages

    return stages.validate(v.calls, v.turns, _Reviewer, ("en", "fr"), 4)[2].select("call_id", "batch", "error")


@query("m7_embeddings", "SELECT vec_id AS clip_id, CASE WHEN vec_id % 5 = 0 THEN NULL WHEN vec_id % 7 = 0 THEN NULL ELSE CAST(64 AS INT) END AS size, vec_id % 7 = 0 AS failed FROM embeddings")
def _(v):
    from turnloom import models

    class Lengths:
        def embed(self, content):
            from turnloom.sources import wav

            return [float(len(wav.decode(content)[0]))]

    def clip(batches):
        import numpy as np
        import pyarrow as pa

        from turnloom.sources import wav

        for b in batches:
            ids = b.column(0).to_pylist()
            n = [16 if i % 5 == 0 else 64 for i in ids]
            sounds = [wav.encode(np.array(x[:k]), 100) for x, k in zip(b.column(1).to_pylist(), n, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array([8 if i % 7 == 0 else 64 for i in ids], pa.int32()), pa.array(sounds, pa.binary())], names=["clip_id", "n_samples", "sample_rate", "content"])

    clips = v.clips.select("clip_id", "samples").mapInArrow(clip, "clip_id bigint, n_samples bigint, sample_rate int, content binary")
    return models.embedded(clips, Lengths, 64).select("clip_id", F.col("embedding")[0].cast("int").alias("size"), F.col("error").isNotNull().alias("failed"))


@query("u7_reject_form", """
    WITH d AS (SELECT *, greatest(0.0, end_s - start_s) AS dur FROM {judged}), x AS (SELECT c.call_id, r.confidence < 0.6 AS low, r.file_issue FROM {calls} c LEFT JOIN {responses} r ON r.call_id = c.call_id),
    f AS (SELECT call_id, concat_ws(',', CASE WHEN low THEN 'low_confidence' END, nullif(file_issue, '')) AS reasons FROM x WHERE low OR file_issue <> ''),
    k AS (SELECT call_id, issue IS NULL AND dur BETWEEN 3 AND 45 AND has_audio AND audio_issue IS NULL AS kept FROM d),
    s AS (SELECT call_id, count(*) AS n, count(*) FILTER (kept) AS left FROM k GROUP BY call_id)
    SELECT c.call_id, coalesce(f.reasons, CASE s.left WHEN 0 THEN 'all_turns_filtered' ELSE 'single_turn' END) AS reasons, CAST(s.n AS INT) AS original_turn_count, CAST(0 AS INT) AS filtered_turn_count, CAST(0 AS INT) AS n_turns
    FROM {calls} c JOIN s ON s.call_id = c.call_id LEFT JOIN f ON f.call_id = c.call_id WHERE f.call_id IS NOT NULL OR s.left <= 1""")
def _(v):
    from turnloom.plans import stages

    turns = v.judged.withColumn("issues", F.array_compact(F.array("issue")))
    clips = v.judged.where("has_audio").select("call_id", "idx", "audio_issue")
    calls = v.calls.join(review.confidence_gate(_responses(v)), "call_id")
    _, whole, _ = stages.screen(turns.drop("has_audio", "audio_issue"), calls, clips)
    out = stages.rejections(turns, whole)
    return out.select("call_id", F.array_join("reject_reasons", ",").alias("reasons"), "original_turn_count", "filtered_turn_count", F.size("turns").alias("n_turns"))


@query("c7_file_rejections", "SELECT c.call_id FROM {calls} c JOIN {responses} r ON r.call_id = c.call_id WHERE r.confidence < 0.6 OR r.file_issue <> ''")
def _(v):
    return review.confidence_gate(_responses(v)).where(screening.file_rejected()).select("call_id")


@query("c5_known_issues", "SELECT call_id, idx, concat_ws(',', issue, issue) AS issues FROM {judged}")
def _(v):
    return v.judged.select("call_id", "idx", F.array_join(review.known_turn_issues(F.array_compact(F.array("issue", F.lit("made_up"), "audio_issue", "issue"))), ",").alias("issues"))


@query("s2_manifests", SPLIT + " SELECT CAST(row_number() OVER (PARTITION BY split ORDER BY call_id, idx) AS INT) AS place, split, '/c/' || call_id || '_turn_' || printf('%03d', idx) || '.wav' AS audio FROM s")
def _(v):
    from pyspark.sql import Window

    from turnloom.plans import stages

    rows = dataset.split(dataset.own_turns(v.labelled), order=draw()).withColumn("audio", F.concat(F.lit("/c/"), text.clip_name(F.col("call_id"), F.col("idx"))))
    both = dataset.combined(*[m.withColumn("_at", F.monotonically_increasing_id()) for m in stages.manifests(rows)])
    return both.select(F.row_number().over(Window.partitionBy("split").orderBy("_at")).alias("place"), "split", "audio")


@query("b10_data_uri", "SELECT conv_id, turn, 'data:audio/wav;base64,' || to_base64(encode(text)) AS uri FROM conversations")
def _(v):
    return v.conversations.select("conv_id", "turn", text.data_uri(F.col("text").cast("binary")).alias("uri"))


@query("x1_strip", "SELECT doc_id, trim(text, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(133)||chr(160)) AS text FROM (SELECT doc_id, chr(160)||chr(9)||chr(28)||text||chr(133)||' '||chr(31) AS text FROM documents)")
def _(v):
    edge = F.concat(F.lit("\xa0\t\x1c"), "text", F.lit("\x85 \x1f"))
    return v.documents.select("doc_id", text.strip(edge).alias("text"))


from turnloom.plans import table_queries  # noqa: E402, F401  (registers the queries that write and read tables)
