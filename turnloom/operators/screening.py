"""The drop cascade over turns and the survival rules of calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.schemas import KEEP_MAX, KEEP_MIN, REJECT_REASONS, TURN_ISSUES


def file_rejected() -> Column:
    """Whether a call is rejected for a reason that counts here; other rejections are taken back."""
    return F.coalesce(F.col("rejected"), F.lit(False)) & F.arrays_overlap(F.coalesce("reject_reasons", F.array().cast("array<string>")), F.array(*map(F.lit, REJECT_REASONS)))


def drop_codes(turns: DataFrame, duration: Column, shortest: float = KEEP_MIN, longest: float = KEEP_MAX) -> DataFrame:
    """Add ``drop_codes``, ``missing_audio`` and ``kept``; the first rule that fits decides.

    Validation codes (each is counted, repeats too), too short, too long, no audio (dropped without a code), audio issue.  Columns used if
    present: issues, has_audio, audio_issue.
    """
    issues = F.col("issues") if "issues" in turns.columns else F.array().cast("array<string>")
    has_audio = F.coalesce(F.col("has_audio"), F.lit(False)) if "has_audio" in turns.columns else F.lit(True)
    defect = F.col("audio_issue") if "audio_issue" in turns.columns else F.lit(None).cast("string")
    stated = F.filter(F.coalesce(issues, F.array().cast("array<string>")), lambda x: x.isin(*TURN_ISSUES))
    none = F.array().cast("array<string>")
    codes = F.when(F.size(stated) > 0, stated).when(duration < shortest, F.array(F.lit("too_short"))).when(duration > longest, F.array(F.lit("too_long"))).when(~has_audio, none).when(defect.isNotNull(), F.array(defect)).otherwise(none)
    timely = (F.size(stated) == 0) & (duration >= shortest) & (duration <= longest)
    return turns.withColumn("drop_codes", codes).withColumn("missing_audio", timely & ~has_audio).withColumn("kept", (F.size("drop_codes") == 0) & ~F.col("missing_audio"))


def survivors(turns: DataFrame) -> DataFrame:
    """Per call: turns before and after, and the reason if none or one is left."""
    counted = turns.groupBy("call_id").agg(F.count("*").alias("original_turn_count"), F.count_if("kept").alias("filtered_turn_count"))
    reason = F.when(F.col("filtered_turn_count") == 0, "all_turns_filtered").when(F.col("filtered_turn_count") == 1, "single_turn")
    return counted.withColumn("reject_reason", reason).withColumn("rejected", F.col("reject_reason").isNotNull())


def sorted_reasons(reasons: Column) -> Column:
    """Distinct reasons in order, nulls left out."""
    return F.array_sort(F.array_distinct(F.array_compact(reasons)))


def removed_counts(turns: DataFrame) -> DataFrame:
    """How often each code dropped a turn, a row for each call and code."""
    return turns.select("call_id", F.explode("drop_codes").alias("code")).groupBy("call_id", "code").agg(F.count("*").alias("n"))


def removed_map(turns: DataFrame) -> DataFrame:
    """The same as one map a call."""
    return removed_counts(turns).groupBy("call_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", F.col("n").cast("int").alias("n"))))).alias("filter_removed"))


def final_turns(turns: DataFrame, calls: DataFrame) -> DataFrame:
    """Kept turns of calls that survive, without the columns that only screening needs."""
    alive = calls.where("NOT rejected").select("call_id")
    kept = turns.where("kept").join(alive, "call_id", "left_semi")
    return kept.drop("issues", "drop_codes", "missing_audio", "kept", "audio_issue", "has_audio")
