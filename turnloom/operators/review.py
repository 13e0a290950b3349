"""Model judgements: prompts, responses, and the gates that they pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import json_text, strip, unfenced
from turnloom.operators.dialogue import in_order
from turnloom.schemas import ASSIGNMENT, FILE_ISSUES, MAX_TURN, MIN_CONFIDENCE, MIN_TURN, MODEL_TURN_ISSUES, TURN_ISSUES, VALIDATION_RESPONSE


def _no_codes() -> Column:
    return F.array().cast("array<string>")


def numbered_turns(turns: DataFrame, size: int) -> DataFrame:
    """One prompt body a batch: ``i. [speaker] text``, numbered from 1 in the batch."""
    line = F.format_string("%d. [%s] %s", (F.col("idx") % size + 1).cast("int"), F.col("speaker"), F.coalesce("text", F.lit("")))
    return turns.groupBy("call_id", F.floor(F.col("idx") / size).alias("batch")).agg(F.array_join(in_order(line, "idx"), "\n").alias("prompt"), F.count("*").alias("n_turns"))


def indexed_turns(turns: DataFrame, size: int) -> DataFrame:
    """One prompt body a batch: ``[index] speaker (start - end): text``, indexed in the call."""
    line = F.format_string("[%d] %s (%.1fs - %.1fs): %s", F.col("idx").cast("int"), F.col("speaker"), F.col("start_s"), F.col("end_s"), F.coalesce("text", F.lit("")))
    return turns.groupBy("call_id", F.floor(F.col("idx") / size).alias("batch")).agg(F.array_join(in_order(line, "idx"), "\n").alias("prompt"), F.count("*").alias("n_turns"))


def scrub_flags(lines: DataFrame) -> DataFrame:
    """Flags from verdict lines (call_id, batch offset ``offset``, ``line_no``, ``line``): ``N. ... SENSITIVE ...``.

    The last line about a turn counts.
    """
    parts = F.split("line", r"\.", 2)
    digits = strip(parts[0])
    judged = lines.where(F.size(parts) == 2).where(digits.rlike(r"^\d+$")).select("call_id", (F.col("offset") + digits.cast("bigint") - 1).alias("idx"), "line_no", F.instr(F.upper(parts[1]), "SENSITIVE").cast("boolean").alias("sensitive"))
    return judged.groupBy("call_id", "idx").agg(F.max_by("sensitive", "line_no").alias("sensitive"))


def response_lines(responses: DataFrame) -> DataFrame:
    """Lines of scrub responses (call_id, offset, response)."""
    return responses.select("call_id", "offset", F.posexplode(F.split("response", "\n")).alias("line_no", "line"))


def without_sensitive(turns: DataFrame, flags: DataFrame) -> DataFrame:
    """Turns that are not flagged."""
    return turns.join(flags.where("sensitive").select("call_id", "idx"), ["call_id", "idx"], "left_anti")


def scored_turns(responses: DataFrame) -> DataFrame:
    """Turns of a speech model's answer (call_id, response): a JSON list, else ``Speaker N:`` lines, else the whole text as one turn.

    A code fence around the answer is taken off; an item of a list without a speaker is UNKNOWN, and one without text is left out.
    """
    turn = "array<struct<speaker:string,text:string>>"
    pattern = F.lit(r"(?m)^(Speaker[_ ]?\d+)\s*:\s*(.+)")
    item = lambda t: F.struct(F.coalesce(t["speaker"], F.lit("UNKNOWN")).alias("speaker"), strip(t["text"]).alias("text"))
    # one step after the other, so that each is computed once for all that reads it
    rows = responses.select("call_id", unfenced(F.col("response")).alias("_bare"))
    rows = rows.withColumn("_json", json_text(F.col("_bare")))
    rows = rows.withColumn("_listed", F.filter(F.from_json("_json", turn), lambda t: F.length(strip(F.coalesce(t["text"], F.lit("")))) > 0))
    rows = rows.withColumn("_who", F.regexp_extract_all("_bare", pattern, 1)).withColumn("_what", F.regexp_extract_all("_bare", pattern, 2))
    said = F.arrays_zip(F.transform("_who", lambda s: F.regexp_replace(s, " ", "_")).alias("speaker"), F.transform("_what", strip).alias("text"))
    whole = F.filter(F.array(F.struct(F.lit("Speaker_1").alias("speaker"), F.col("_bare").alias("text"))), lambda t: F.length(t["text"]) > 0)
    turns = F.when(F.size("_listed") > 0, F.transform("_listed", item)).when(F.size("_who") > 0, said).otherwise(whole)
    return rows.select("call_id", F.posexplode(turns).alias("idx", "t")).select("call_id", "idx", "t.speaker", "t.text", F.lit(0.0).alias("start_s"), F.lit(0.0).alias("end_s"))


def validation_response(response: Column) -> Column:
    """Struct (confidence, issues, assignments) of a response: an object with assignments, or a bare list of them; else null."""
    body = json_text(response)
    whole = F.from_json(body, VALIDATION_RESPONSE)
    listed = F.from_json(body, f"array<{ASSIGNMENT}>")
    known = F.filter(F.coalesce(whole["issues"], _no_codes()), lambda x: x.isin(*TURN_ISSUES, *FILE_ISSUES))
    as_object = F.struct(F.coalesce(whole["confidence"], F.lit(-1.0)).alias("confidence"), known.alias("issues"), whole["assignments"].alias("assignments"))
    as_list = F.struct(F.lit(-1.0).alias("confidence"), _no_codes().alias("issues"), listed.alias("assignments"))
    return F.when(body.startswith("{") & whole["assignments"].isNotNull(), as_object).when(body.startswith("["), as_list)


def language_gate(calls: DataFrame, allowed: tuple[str, ...] = ("en",)) -> DataFrame:
    """Add ``reject_reasons`` and ``rejected``: the language is not among those allowed, and fewer than two speakers."""
    reasons = F.array_compact(F.array(F.when(~F.coalesce(F.col("language").isin(*allowed), F.lit(False)), F.lit("language_not_allowed")), F.when(F.col("num_speakers") < 2, F.lit("mono_speaker"))))
    return calls.withColumn("reject_reasons", reasons).withColumn("rejected", F.size("reject_reasons") > 0)


def timing_issues(turns: DataFrame, duration: Column, shortest: float = MIN_TURN, longest: float = MAX_TURN) -> DataFrame:
    """Append timing codes to ``issues``, also where the code is there already."""
    codes = F.array_compact(F.array(F.when(duration < shortest, F.lit("too_short")), F.when(duration > longest, F.lit("too_long"))))
    return turns.withColumn("issues", F.concat(F.coalesce("issues", _no_codes()), codes))


def known_turn_issues(issues: Column) -> Column:
    """Only the codes of turns; repeated codes stay."""
    return F.filter(F.coalesce(issues, _no_codes()), lambda x: x.isin(*TURN_ISSUES))


def apply_assignments(turns: DataFrame, assignments: DataFrame) -> DataFrame:
    """Take speakers, names and issues from assignments (call_id, a_index, pos, speaker[, name, issues]) by index.

    The last of several assignments counts; turns without one keep their speaker; indexes without a turn are ignored.
    """
    names = [c for c in ("speaker", "name", "issues") if c in assignments.columns]
    last = assignments.groupBy("call_id", F.col("a_index").alias("idx")).agg(F.max_by(F.struct(*names), "pos").alias("_a"))
    joined = turns.join(last, ["call_id", "idx"], "left").withColumn("original_speaker", F.col("speaker")).withColumn("speaker", F.coalesce("_a.speaker", "speaker"))
    if "name" in names:
        joined = joined.withColumn("name", F.col("_a.name"))
    if "issues" in names:
        joined = joined.withColumn("issues", known_turn_issues(F.col("_a.issues")))
    return joined.withColumn("changed", F.col("speaker") != F.col("original_speaker")).drop("_a")


def speaker_names(turns: DataFrame) -> DataFrame:
    """The last name that is not empty, for each speaker, as a map a call."""
    last = turns.where(F.length(F.coalesce("name", F.lit(""))) > 0).groupBy("call_id", "speaker").agg(F.max_by("name", "idx").alias("name"))
    return last.groupBy("call_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker", "name")))).alias("speaker_names"))


def batch_confidence(responses: DataFrame) -> DataFrame:
    """For each call the least confidence that is not negative, else -1, and its distinct file issues in order of batches."""
    issues = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("batch", F.coalesce("issues", _no_codes()).alias("issues")))), lambda s: s["issues"]))
    return responses.groupBy("call_id").agg(F.coalesce(F.min(F.when(F.col("confidence") >= 0, F.col("confidence"))), F.lit(-1.0)).alias("confidence"), F.array_distinct(issues).alias("issues"))


def turn_issue_set(turns: DataFrame) -> DataFrame:
    """Sorted distinct issue codes over the turns of each call."""
    return turns.groupBy("call_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("issues", _no_codes()))))).alias("turn_issues"))


def confidence_gate(calls: DataFrame, least: float = MIN_CONFIDENCE) -> DataFrame:
    """Add ``reject_reasons`` and ``rejected``: file issues of the model, and a known confidence below ``least``."""
    found = F.filter(F.coalesce("issues", _no_codes()), lambda x: x.isin(*FILE_ISSUES))
    low = F.array_compact(F.array(F.when((F.col("confidence") >= 0) & (F.col("confidence") < least), F.lit("low_confidence"))))
    return calls.withColumn("reject_reasons", F.concat(found, low)).withColumn("rejected", F.size("reject_reasons") > 0)


def model_turn_issues(issues: Column) -> Column:
    """The issues that a model may state about a turn."""
    return F.filter(F.coalesce(issues, _no_codes()), lambda x: x.isin(*MODEL_TURN_ISSUES))


def verdict_udtf():
    """A table function for SQL: (line_no, turn, sensitive) of a scrub response."""

    @F.udtf(returnType="line_no: int, turn: int, sensitive: boolean")
    class Verdicts:
        def eval(self, response: str):
            for k, line in enumerate((response or "").split("\n")):
                left, dot, right = line.partition(".")
                if dot and left.strip().isdigit():
                    yield k, int(left), "SENSITIVE" in right.upper()

    return Verdicts
