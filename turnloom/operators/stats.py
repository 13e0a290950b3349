"""Stage statistics as long tables (stage, metric, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import language_code


def language_totals(rows: DataFrame, language: str, seconds: str, top: int = 4, least: float = 1.0) -> DataFrame:
    """Duration by language: the ``top`` longest of at least a second, all others as ``other``, with shares of the total."""
    sums = rows.groupBy(F.coalesce(language_code(F.col(language)), F.lit("unknown")).alias("lang")).agg(F.sum(seconds).alias("d"))
    ranked = sums.withColumn("rank", F.row_number().over(Window.orderBy(F.col("d").desc(), "lang")))  # one row a language
    named = ranked.withColumn("label", F.when((F.col("rank") <= top) & (F.col("d") >= least), F.col("lang")).otherwise("other"))
    out = named.groupBy("label").agg(F.sum("d").alias("seconds")).withColumn("share", F.col("seconds") / F.sum("seconds").over(Window.partitionBy(F.lit(1))))
    return out.where((F.col("label") != "other") | (F.col("seconds") >= least))


def call_seconds() -> Column:
    """Duration of a call document: its total, else its duration, else its span."""
    return F.coalesce("total_duration", "duration", "span_s")


def long_form(row: DataFrame, stage: str) -> DataFrame:
    """A one-row table of numbers as rows (stage, metric, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns])
    return row.select(F.lit(stage).alias("stage"), F.explode(pairs).alias("p")).select("stage", "p.metric", "p.value")


def preprocess_stats(files: DataFrame) -> DataFrame:
    """Files, seconds and bytes."""
    return long_form(files.agg(F.count("*").alias("files"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("seconds"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")), "preprocess")


def review_stats(calls: DataFrame, stage: str = "validate") -> DataFrame:
    """Calls, turns, seconds, accepted and rejected calls."""
    rejected = F.coalesce(F.col("rejected"), F.lit(False))
    return long_form(calls.agg(F.count("*").alias("calls"), F.sum("num_turns").alias("turns"), F.sum("seconds").alias("seconds"), F.count_if(~rejected).alias("accepted"), F.count_if(rejected).alias("rejected")), stage)


def screening_stats(calls: DataFrame) -> DataFrame:
    """Accepted calls, kept and removed turns, keep rate and averages over accepted calls."""
    ok = ~F.coalesce(F.col("rejected"), F.lit(False))
    kept = F.sum(F.when(ok, F.col("filtered_turn_count")).otherwise(0))
    removed = F.sum(F.when(ok, F.greatest(F.lit(0), F.col("original_turn_count") - F.col("filtered_turn_count"))).otherwise(0))
    return long_form(calls.agg(F.count("*").alias("calls"), F.count_if(ok).alias("accepted"), kept.alias("kept"), removed.alias("removed"), F.when(kept + removed > 0, kept / (kept + removed)).alias("keep_rate"), F.avg(F.when(ok, F.col("filtered_turn_count"))).alias("turns_per_call")), "filter")


def segment_stats(calls: DataFrame, clips: DataFrame | None = None) -> DataFrame:
    """Calls, turns and seconds of segmented calls, and the mean size of their clips."""
    own = long_form(calls.agg(F.count("*").alias("calls"), F.sum("num_turns").alias("turns"), F.sum("seconds").alias("seconds")), "segment")
    return own if clips is None else own.unionByName(long_form(clips.agg(F.avg("length").alias("mean_bytes")), "segment"))


def reason_ranks(reasons: DataFrame) -> DataFrame:
    """Reasons by falling count, equal ones by name."""
    return reasons.groupBy("reason").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "reason")))  # one row a reason


def label_stats(turns: DataFrame, flags: DataFrame, top: int = 4) -> DataFrame:
    """Turns of me and of others, seconds of me in all and by language, flagged calls, and how often each flag was raised."""
    me = F.col("speaker_label") == "me"
    own = turns.agg(F.count_if(me).alias("me_turns"), F.count_if(~me).alias("other_turns"), F.coalesce(F.sum(F.when(me, F.col("duration"))), F.lit(0.0)).alias("me_seconds"))
    out = long_form(own, "label").unionByName(long_form(flags.agg(F.count_if(F.size("flags") > 0).alias("flagged_calls")), "label"))
    raised = flags.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").cast("double").alias("value"))
    out = out.unionByName(raised.select(F.lit("label").alias("stage"), F.concat(F.lit("flag:"), "flag").alias("metric"), "value"))
    if "language" not in turns.columns:
        return out
    by = language_totals(turns.where(me & F.col("language").isNotNull()), "language", "duration", top)
    return out.unionByName(by.select(F.lit("label").alias("stage"), F.concat(F.lit("me_seconds:"), "label").alias("metric"), F.col("seconds").alias("value")))


def export_stats(rows: DataFrame, clips: DataFrame | None = None) -> DataFrame:
    """Rows and seconds by split, and seconds in all: if the manifests state none, those of the clips."""
    own = rows.groupBy("split").agg(F.count("*").alias("rows"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("seconds"))
    pairs = own.select(F.lit("finetune").alias("stage"), F.explode(F.array(F.struct(F.concat("split", F.lit("_rows")).alias("metric"), F.col("rows").cast("double").alias("value")), F.struct(F.concat("split", F.lit("_seconds")).alias("metric"), F.col("seconds").alias("value")))).alias("p"))
    total = rows.agg(F.coalesce(F.sum("duration"), F.lit(0.0)).alias("seconds"))
    if clips is not None:
        spare = clips.agg(F.coalesce(F.sum("duration"), F.lit(0.0)).alias("spare"))
        total = total.join(spare).select(F.when(F.col("seconds") == 0, F.col("spare")).otherwise(F.col("seconds")).alias("seconds"))  # one row each
    return pairs.select("stage", "p.metric", "p.value").unionByName(long_form(total, "finetune"))


def stage_rollup(stages: dict[str, DataFrame]) -> DataFrame:
    """Calls, turns and seconds by stage and language, by stage, and over all, in one pass: stage, language, level (0, 1, 3), calls, turns, seconds.

    stages: rows with call_id, language and seconds, one a turn.  ``level`` tells a total's null from a language that is not known.
    """
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("stage"), "call_id", language_code(F.col("language")).alias("language"), "seconds") for name, df in stages.items()])
    calls = rows.groupBy("stage", "language", "call_id").agg(F.count("*").alias("turns"), F.sum("seconds").alias("seconds"))  # so that counting calls needs no distinct
    return calls.rollup("stage", "language").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("calls"), F.sum("turns").alias("turns"), F.sum("seconds").alias("seconds"))


def dashboard(parts: list[DataFrame]) -> DataFrame:
    """All stage tables as one."""
    return reduce(DataFrame.unionByName, parts)


def render(rows: DataFrame, width: int = 60) -> str:
    """A boxed text report of a dashboard, which has a few rows a stage."""
    lines, inner = [], width - 4
    for stage, metric, value in rows.orderBy("stage", "metric").collect():
        if not lines or lines[-1][0] != stage:
            lines.append((stage, "+" + "-" * (width - 2) + "+"))
            lines.append((stage, f"| {stage:<{inner}} |"))
        text = "n/a" if value is None else f"{value:,.2f}".rstrip("0").rstrip(".")
        lines.append((stage, f"| {metric + ':':<{inner - 20}}{text:>20} |"))
    return "\n".join([x for _, x in lines] + (["+" + "-" * (width - 2) + "+"] if lines else []))
