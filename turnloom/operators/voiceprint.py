"""Matching speakers to a voiceprint by their embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.vectors import cosine, mean_vectors
from turnloom.schemas import MIN_MARGIN, MIN_SIMILARITY


def longest_turns(turns: DataFrame, duration: str = "duration", k: int = 10) -> DataFrame:
    """The ``k`` longest turns of each speaker; of equals, the earlier ones."""
    w = Window.partitionBy("call_id", "speaker").orderBy(F.col(duration).desc(), F.col("idx"))
    return turns.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def long_enough(clips: DataFrame, rate: int, seconds: float = 0.5, samples: str = "n_samples") -> DataFrame:
    """Clips of at least ``seconds``."""
    return clips.where(F.col(samples) >= int(seconds * rate))


def speaker_vectors(clips: DataFrame, vector: str = "embedding") -> DataFrame:
    """Mean vector of each call's speakers; null vectors are left out."""
    return mean_vectors(clips.where(F.col(vector).isNotNull()), ["call_id", "speaker"], vector)


def enroll(clips: DataFrame, model: str, source: str, vector: str = "embedding") -> DataFrame:
    """One voiceprint row with its provenance."""
    return mean_vectors(clips, [], vector).select(vector, F.lit(model).alias("model"), F.lit(source).alias("subfolder"))


def similarities(speakers: DataFrame, voiceprint: DataFrame, model: str | None = None, vector: str = "embedding") -> DataFrame:
    """Cosine of each speaker to the voiceprint, which is one row; a speaker without a vector gets -1.

    With ``model``, a voiceprint of another model is an error.
    """
    print_ = voiceprint.limit(1)
    if model is not None:
        print_ = print_.where(F.assert_true(F.col("model") == model, F.lit(f"the voiceprint was not made by {model}")).isNull())
    one = F.broadcast(print_.select(F.col(vector).alias("_print")))  # one row
    return speakers.join(one).withColumn("similarity", F.coalesce(cosine(F.col(vector), F.col("_print")), F.lit(-1.0))).drop("_print")


def best_match(scored: DataFrame) -> DataFrame:
    """Per call the most similar speaker (of equals the first by name), its similarity and the margin to the second."""
    w = Window.partitionBy("call_id").orderBy(F.col("similarity").desc(), F.col("speaker"))
    ranked = scored.withColumn("rank", F.row_number().over(w)).where("rank <= 2")
    best, second = F.max(F.when(F.col("rank") == 1, F.col("similarity"))), F.max(F.when(F.col("rank") == 2, F.col("similarity")))
    return ranked.groupBy("call_id").agg(F.max(F.when(F.col("rank") == 1, F.col("speaker"))).alias("best_speaker"), best.alias("best_similarity"), (best - second).alias("margin"))


def quality_flags(matches: DataFrame, usable: DataFrame, least: float = MIN_SIMILARITY, margin: float = MIN_MARGIN, clips: int = 3) -> DataFrame:
    """Add ``flags``: low similarity, ambiguous match, and speakers with few usable clips (call_id, speaker, usable)."""
    few = usable.where((F.col("usable") > 0) & (F.col("usable") < clips)).groupBy("call_id").agg(F.transform(F.array_sort(F.collect_list("speaker")), lambda s: F.concat(F.lit("insufficient_audio:"), s)).alias("_few"))
    own = F.array_compact(F.array(F.when(F.col("best_similarity") < least, F.lit("low_similarity")), F.when(F.col("margin") < margin, F.lit("ambiguous_match"))))
    return matches.join(few, "call_id", "left").withColumn("flags", F.concat(own, F.coalesce("_few", F.array().cast("array<string>")))).drop("_few")


def label_turns(turns: DataFrame, matches: DataFrame) -> DataFrame:
    """Add ``speaker_label``: me for the best speaker of the call, other for the rest."""
    found = turns.join(matches.select("call_id", "best_speaker"), "call_id")
    return found.withColumn("speaker_label", F.when(F.col("speaker") == F.col("best_speaker"), "me").otherwise("other")).drop("best_speaker")
