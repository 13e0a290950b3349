"""Training manifests: language filter, cap a call, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import strip
from turnloom.plans.tables import new_path, written


def in_languages(language: Column, codes: tuple[str, ...] | None) -> Column:
    """Whether the language begins with one of the codes; all pass without codes."""
    if not codes:
        return F.lit(True)
    low = F.lower(F.coalesce(language, F.lit("")))
    return F.exists(F.array(*map(F.lit, codes)), lambda c: low.startswith(c))


def own_turns(turns: DataFrame, label: str = "me") -> DataFrame:
    """Turns of the labelled speaker that have audio and text."""
    audio = F.coalesce(F.col("has_audio"), F.lit(False)) if "has_audio" in turns.columns else F.lit(True)
    return turns.where((F.col("speaker_label") == label) & audio & (F.length(strip(F.coalesce("text", F.lit("")))) > 0))


def shuffled(*keys: str, seed: int = 0) -> Column:
    """A fixed pseudo-random order that does not depend on the layout of the data."""
    return F.xxhash64(F.lit(seed), *keys)


def cap_turns(turns: DataFrame, cap: int = 50, order: Column | None = None) -> DataFrame:
    """At most ``cap`` turns of each call, drawn in a fixed pseudo-random order."""
    draw = shuffled("call_id", "idx") if order is None else order
    w = Window.partitionBy("call_id").orderBy(draw, "idx")
    return turns.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= cap).drop("_rank")


def holdout_size(total: int, share: float = 0.06, least: int = 20) -> int:
    """Rows that go to validation: none of up to ``least``, else a share of at least one."""
    return 0 if total <= least else max(1, round(total * share))


def first_n(rows: DataFrame, n: int, order: str, *keys: str, cells: int = 4096, few: int = 100_000) -> DataFrame:
    """The ``n`` least rows by a whole-number column and then by keys, for ``n`` up to the number of rows.

    The range of the order is cut into cells, whose counts tell which one holds the n-th row; that cell is cut again until it holds ``few``
    rows.  Only rows of the last cell are ranked.
    """
    low, high = rows.agg(F.min(order), F.max(order)).first()
    whole, rest = F.lit(False), n
    while low is not None:
        shift = max(0, (high - low).bit_length() - cells.bit_length() + 2)
        counts = rows.where(F.col(order).between(low, high)).groupBy(F.shiftright(order, shift).alias("cell")).agg(F.count("*")).collect()  # at most ``cells`` rows
        for cell, k in sorted(map(tuple, counts)):
            if rest <= k:
                break
            rest -= k
        low, high = max(low, cell << shift), min(high, (cell + 1 << shift) - 1)
        whole = F.col(order) < low
        if shift == 0 or k <= few:
            break
    last = rows.where(F.col(order).between(low, high)).orderBy(order, *keys).limit(rest) if low is not None else rows.where(F.lit(False))
    return rows.where(whole).unionByName(last)


def split(rows: DataFrame, share: float = 0.06, order: Column | None = None) -> DataFrame:
    """Add ``split``: the first rows in a fixed pseudo-random order are val, the rest train.

    The order of all rows is stored once; counting and cutting read that table, so what made the rows runs twice, not once a pass.
    """
    draw = shuffled("call_id", "idx", seed=1) if order is None else order
    keys, counts = written(rows.select("call_id", "idx", draw.alias("_order")), new_path(rows.sparkSession, "split"))
    n = holdout_size(counts["rows"], share)
    if n == 0:
        return rows.withColumn("split", F.lit("train"))
    held = first_n(keys, n, "_order", "call_id", "idx").select("call_id", "idx", F.lit("val").alias("split"))
    return rows.join(held, ["call_id", "idx"], "left").withColumn("split", F.coalesce("split", F.lit("train")))


def manifest(rows: DataFrame, audio: str = "audio") -> DataFrame:
    """Manifest rows with durations of three decimals; columns that begin with ``_`` are private and left out."""
    made = rows.select(F.col(audio).alias("audio"), strip(F.col("text")).alias("text"), F.round("duration", 3).alias("duration"), *[c for c in rows.columns if c.startswith("_")])
    return public(made)


def combined(train: DataFrame, val: DataFrame) -> DataFrame:
    """Both manifests as one, with ``split``."""
    return train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")), allowMissingColumns=True)


def public(rows: DataFrame) -> DataFrame:
    """Without columns whose names begin with ``_``."""
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


def rewritten(rows: DataFrame, root: str) -> DataFrame:
    """Manifest rows whose audio paths, and reference paths if present, are moved under a new root."""
    for c in ("audio", "ref_audio"):
        if c in rows.columns:
            rows = rows.withColumn(c, F.concat(F.lit(root.rstrip("/") + "/"), F.element_at(F.split(c, "/"), -1)))
    return rows


def checked(rows: DataFrame) -> int:
    """Number of manifest rows; an empty manifest or a row without audio or text is an error."""
    n, bad = rows.agg(F.count("*"), F.count_if(F.col("audio").isNull() | F.col("text").isNull())).first()
    if not n:
        raise ValueError("the training manifest is empty")
    if bad:
        raise ValueError(f"{bad} manifest rows lack audio or text")
    return n


def language_counts(rows: DataFrame) -> DataFrame:
    """Rows by split and language."""
    return rows.groupBy("split", "language").agg(F.count("*").alias("n"))


def call_export_stats(turns: DataFrame, exported: DataFrame, cap: int = 50) -> DataFrame:
    """Per call: exported turns, turns of others, and how many there were before the cap."""
    counted = turns.groupBy("call_id").agg(F.count_if(F.col("speaker_label") != "me").alias("skipped_other"), F.count_if(F.col("speaker_label") == "me").alias("capped_from"))
    out = exported.groupBy("call_id").agg(F.count("*").alias("exported"))
    return counted.join(out, "call_id", "left").withColumn("exported", F.coalesce("exported", F.lit(0).cast("bigint"))).withColumn("capped", F.col("capped_from") > cap)
