"""Segments, words and turns of calls.

All of these partition by ``call_id`` alone, so one exchange serves a chain of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import attached, strip
from turnloom.schemas import MERGE_GAP


def duration(turns: DataFrame) -> Column:
    """Duration of a turn: its own if stated, else from its times, never below zero."""
    start, end = F.coalesce(F.col("start_s"), F.lit(0.0)), F.coalesce(F.col("end_s"), F.lit(0.0))
    stated = F.col("duration") if "duration" in turns.columns else F.lit(None).cast("double")
    return F.greatest(F.lit(0.0), F.coalesce(stated, end - start))


def in_order(value: str | Column, by: str) -> Column:
    """Values of a group as an array in the order of ``by``."""
    value = F.col(value) if isinstance(value, str) else value
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(by).alias("k"), value.alias("v")))), lambda s: s["v"])


def _islands(rows: DataFrame, order: str, breaks: Column) -> DataFrame:
    by_call = Window.partitionBy("call_id").orderBy(order)
    flagged = rows.withColumn("_new", F.coalesce(breaks, F.lit(True)).cast("int"))
    return flagged.withColumn("island", F.sum("_new").over(by_call.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_new")


def segments_to_turns(segments: DataFrame, digits: int = 2) -> DataFrame:
    """Join consecutive segments of one speaker, blank ones left out, into turns with rounded times."""
    spoken = segments.withColumn("text", strip(F.col("text"))).where(F.length("text") > 0)
    before = F.lag("speaker").over(Window.partitionBy("call_id").orderBy("seg"))
    runs = _islands(spoken.withColumn("_before", before), "seg", ~F.col("_before").eqNullSafe(F.col("speaker")) | F.col("_before").isNull())
    return runs.groupBy("call_id", F.col("island").alias("idx")).agg(
        F.min_by("speaker", "seg").alias("speaker"), F.round(F.min_by("start_s", "seg"), digits).alias("start_s"), F.round(F.max_by("end_s", "seg"), digits).alias("end_s"), F.array_join(in_order("text", "seg"), " ").alias("text")
    )


def merge_turns(turns: DataFrame, max_gap: float = MERGE_GAP) -> DataFrame:
    """Join turns of one speaker whose gap to the turn before is at most ``max_gap``; overlaps count as joined.

    The end is that of the last turn.  Issues, where present, become their ordered distinct union when turns are joined, and stay as they are otherwise.
    """
    w = Window.partitionBy("call_id").orderBy("idx")
    marked = turns.withColumn("_speaker", F.lag("speaker").over(w)).withColumn("_end", F.lag("end_s").over(w))
    runs = _islands(marked, "idx", ~(F.col("_speaker").eqNullSafe(F.col("speaker")) & (F.col("start_s") - F.col("_end") <= max_gap)))
    aggs = [
        F.min_by("speaker", "idx").alias("speaker"), F.min_by("start_s", "idx").alias("start_s"), F.max_by("end_s", "idx").alias("end_s"),
        F.array_join(in_order(F.coalesce("text", F.lit("")), "idx"), " ").alias("text"), F.count("*").alias("merged_from"), F.min("idx").alias("first_idx"),
    ]
    if "issues" in turns.columns:
        every = F.flatten(in_order(F.coalesce("issues", F.array().cast("array<string>")), "idx"))
        aggs.append(F.when(F.count("*") > 1, F.array_distinct(every)).otherwise(every).alias("issues"))
    return runs.groupBy("call_id", F.col("island").alias("idx")).agg(*aggs).withColumn("turn", (F.col("idx") + 1).cast("int"))


def speakers_of_words(words: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``speaker`` to the words (call_id, ord, kind, content, start_time, end_time) from labels by their start time as text.

    Of several labels for one time the last counts; a word without a label takes the speaker of the word before.
    """
    last = labels.groupBy("call_id", "start_time").agg(F.max_by("speaker", "ord").alias("_label"))
    found = words.join(last, ["call_id", "start_time"], "left")
    carry = Window.partitionBy("call_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return found.withColumn("speaker", F.last(F.when(F.col("kind") == "pronunciation", F.col("_label")), ignorenulls=True).over(carry)).drop("_label")


def words_to_turns(words: DataFrame, labels: DataFrame) -> DataFrame:
    """Turns of a word-level transcript; punctuation belongs to the turn that is open, and is dropped before the first word."""
    known = speakers_of_words(words, labels)
    w = Window.partitionBy("call_id").orderBy("ord")
    before = F.last(F.when(F.col("kind") == "pronunciation", F.struct("speaker")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = known.withColumn("_before", before)
    opens = (F.col("kind") == "pronunciation") & (F.col("_before").isNull() | ~F.col("_before.speaker").eqNullSafe(F.col("speaker")))
    runs = marked.withColumn("island", F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).where("island >= 0")
    word = F.col("kind") == "pronunciation"
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("ord", "content"))), lambda s: s["content"])
    spaced = F.transform(pieces, lambda x, i: F.when((i == 0) | attached(x), x).otherwise(F.concat(F.lit(" "), x)))
    return runs.groupBy("call_id", F.col("island").alias("idx")).agg(
        F.min_by(F.when(word, F.col("speaker")), F.when(word, F.col("ord"))).alias("speaker"),
        F.min_by(F.when(word, F.col("start_time").cast("double")), F.when(word, F.col("ord"))).alias("start_s"),
        F.max_by(F.when(word, F.col("end_time").cast("double")), F.when(word, F.col("ord"))).alias("end_s"),
        F.array_join(spaced, "").alias("text"),
    )


STEPS = "at_s double, side int, next_s double, holder string, left_s double, left_ord bigint, left_who string, right_s double, right_ord bigint, right_who string"


def call_steps(start: np.ndarray, end: np.ndarray, order: list, who: list) -> list[tuple]:
    """The steps of one call's intervals, which are in timeline order.

    Between two neighbouring borders, and at each border, the intervals that hold a time are the same.  In the order of the timeline each
    interval takes those of its stretches that are still free, and each stretch is taken once, so the cost is that of sorting.
    """
    border = np.unique(np.concatenate([start, end]))
    n, low, high = len(border), np.searchsorted(border, start), np.searchsorted(border, end)
    holder, free = [-1] * (2 * n), list(range(2 * n + 1))  # 2i: border i, 2i + 1: what follows it; free: the next free stretch from here

    def next_free(i: int) -> int:
        while free[i] != i:
            free[i] = free[free[i]]
            i = free[i]
        return i

    for k, (a, b) in enumerate(zip((2 * low).tolist(), (2 * high).tolist(), strict=True)):
        i = next_free(a)
        while i <= b:
            holder[i], free[i] = k, i + 1
            i = next_free(i)
    first = np.full(n, len(start))  # the earliest interval with a border here
    np.minimum.at(first, low, np.arange(len(start)))
    np.minimum.at(first, high, np.arange(len(start)))
    none = (None, None, None)
    edges = [(t, order[k], who[k]) for t, k in zip(border.tolist(), first.tolist(), strict=True)] + [none]
    out = [(float("-inf"), 2, None, *none, *edges[0])]
    for j in range(2 * n):
        i, k = j // 2, holder[j]
        if k < 0:
            out.append((edges[i][0], 2 * (j % 2), None, *edges[i], *(edges[i + 1] if j % 2 else none)))
        elif j == 0 or holder[j - 1] != k:
            out.append((edges[i][0], 2 * (j % 2), who[k], *none, *none))
    return [(*x[:2], y[0], *x[2:]) for x, y in zip(out, [*out[1:], (None,)], strict=True)]


def timeline_steps(timeline: DataFrame) -> DataFrame:
    """A timeline (call_id, ord, start_s, end_s, speaker) as a function of time: a row wherever the answer to "who speaks now" changes.

    ``holder`` speaks from ``at_s`` on (``side`` 0: including it, 2: after it) up to the next row; without a holder, the nearest borders on
    both sides are there.  Calls stream through a task one after the other, so it holds one call's timeline at a time; intervals without a
    start or an end are left out.
    """
    rows = timeline.select("call_id", F.col("ord").cast("bigint").alias("ord"), F.col("start_s").cast("double").alias("start_s"), F.col("end_s").cast("double").alias("end_s"), "speaker")
    kind = timeline.schema["call_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.float64(), pa.int32(), pa.float64(), pa.string(), pa.float64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.string()]
        held: list[pa.RecordBatch] = []

        def made(table: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
            start, end = (table.column(c).to_numpy() for c in ("start_s", "end_s"))
            ids, order, who = (table.column(c).to_pylist() for c in ("call_id", "ord", "speaker"))
            calls, steps = [], []
            for a, b in itertools.pairwise(bounds):
                steps += call_steps(start[a:b], end[a:b], order[a:b], who[a:b])
                calls += [ids[a]] * (len(steps) - len(calls))
            columns = [pa.array([x[j] for x in steps], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([pa.array(calls, table.schema.field("call_id").type), *columns], names=["call_id", *(x.split()[0] for x in STEPS.split(", "))])

        def cuts(table: pa.Table) -> list[int]:
            codes = table.column("call_id").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            return (np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist()

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if len(held) > 1 and held[0].column("call_id")[0] == batch.column("call_id")[batch.num_rows - 1]:
                continue  # still the same call
            table = pa.Table.from_batches(held)
            if inner := cuts(table):
                yield from made(table.slice(0, inner[-1]), [0, *inner])
                held = table.slice(inner[-1]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from made(table, [0, *cuts(table), table.num_rows])

    laid = rows.where("start_s IS NOT NULL AND end_s IS NOT NULL").repartition("call_id").sortWithinPartitions("call_id", "ord")
    return laid.mapInArrow(run, f"call_id {kind}, {STEPS}")


def speakers_at(points: DataFrame, timeline: DataFrame, at: str = "mid_s", bin_s: float | None = None) -> DataFrame:
    """Add ``speaker``: that of the first interval, in timeline order, that holds the time, ends included; else of the nearest one.

    Points and the steps of the timeline are sorted by time together, and each point takes the last step before it: one exchange, nothing is
    multiplied, and memory does not grow with a call.  With ``bin_s`` a call is split into bins of so many seconds, each of which knows the step
    that it begins in, so a call that holds a large part of all points is as many tasks as bins; this costs one more exchange, for points
    before the first and after the last border.  Without a timeline, or without a time: UNKNOWN.
    """
    steps = timeline_steps(timeline)
    value = F.struct("holder", "left_s", "left_ord", "left_who", "right_s", "right_ord", "right_who").alias("_step")
    time = F.col(at).cast("double")
    keys = ["call_id"]
    marked = points.withColumn("_at", time).withColumn("_side", F.lit(1))
    known = steps.select("call_id", F.col("at_s").alias("_at"), F.col("side").alias("_side"), value, "next_s")
    if bin_s is not None:
        keys.append("_bin")
        of = lambda c: F.floor(c / F.lit(float(bin_s)))
        begin = F.when(F.col("_at") == float("-inf"), F.col("next_s")).otherwise(F.col("_at"))
        marked = marked.withColumn("_bin", of(F.col("_at")))
        known = known.withColumn("_bin", F.explode(F.sequence(of(begin), of(F.coalesce("next_s", begin)))))
    order = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = marked.unionByName(known.drop("next_s"), allowMissingColumns=True)
    found = both.withColumn("_step", F.last("_step", ignorenulls=True).over(order)).where("_side = 1")
    step, near = F.col("_step"), F.col("_at")
    left, right = F.abs(near - step["left_s"]), F.abs(near - step["right_s"])
    nearer = F.when(step["right_s"].isNull() | (left < right) | ((left == right) & (step["left_ord"] <= step["right_ord"])), step["left_who"]).otherwise(step["right_who"])
    nearest = F.when(step["left_s"].isNull(), step["right_who"]).otherwise(nearer)
    held = F.when(step["left_s"].isNull() & step["right_s"].isNull(), step["holder"]).otherwise(nearest)
    if bin_s is not None:
        ends = steps.groupBy("call_id").agg(F.max(F.when(F.col("at_s") == float("-inf"), F.col("right_s"))).alias("_begin"), F.max(F.when(F.col("at_s") == float("-inf"), F.struct("right_who"))).alias("_first"), F.max(F.when(F.col("next_s").isNull(), F.struct("left_who"))).alias("_last"))
        beyond = F.when(near < F.col("_begin"), F.col("_first.right_who")).otherwise(F.col("_last.left_who"))
        found = found.join(ends, "call_id", "left")
        held = F.when(step.isNotNull(), held).when(near.isNotNull(), beyond)
    return found.withColumn("speaker", F.coalesce(held, F.lit("UNKNOWN"))).select(*points.columns, "speaker")


def majority_speaker(words: DataFrame, keys: list[str]) -> DataFrame:
    """The most frequent speaker of each group; of equals, the first by name."""
    return words.groupBy(*keys).agg(F.mode("speaker", True).alias("speaker"))


def call_speakers(turns: DataFrame) -> DataFrame:
    """Sorted distinct speakers and their number for each call."""
    return turns.groupBy("call_id").agg(F.array_sort(F.collect_set("speaker")).alias("speakers")).withColumn("num_speakers", F.size("speakers"))


def call_text_chars(turns: DataFrame) -> DataFrame:
    """Sum of the turns' characters for each call."""
    return turns.groupBy("call_id").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


def call_span(turns: DataFrame) -> DataFrame:
    """Latest end less earliest start of each call."""
    return turns.groupBy("call_id").agg(F.coalesce(F.max("end_s") - F.min("start_s"), F.lit(0.0)).alias("span_s"))


def batches(turns: DataFrame, size: int) -> DataFrame:
    """Add ``batch`` and ``offset``: blocks of ``size`` turns by position."""
    return turns.withColumn("batch", F.floor(F.col("idx") / size)).withColumn("offset", F.col("batch") * size)


def speaker_samples(turns: DataFrame, k: int = 3, chars: int = 80) -> DataFrame:
    """The first ``k`` texts of each speaker, cut to ``chars`` characters."""
    w = Window.partitionBy("call_id", "speaker").orderBy("idx")
    first = turns.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return first.groupBy("call_id", "speaker").agg(in_order(F.substring(F.coalesce("text", F.lit("")), 1, chars), "idx").alias("samples"), F.min("idx").alias("first_idx"))


def zip_flags(turns: DataFrame, flags: DataFrame, name: str) -> DataFrame:
    """Join flags to turns by position; a missing flag is false."""
    return turns.join(flags.select("call_id", "idx", name), ["call_id", "idx"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
