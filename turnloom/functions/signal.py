"""Signal columns over arrays of samples.

They are meant for short arrays and frame statistics; whole recordings go through the Arrow functions of ``turnloom.sources.wav``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.schemas import LOW_ENERGY_DB, MAX_DECAY_DB, SILENCE_DB, SPEECH_FLOOR_DB


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def frames(samples: Column, size: int, hop: int | None = None) -> Column:
    """Array of whole frames; what is left at the end is dropped."""
    hop = size if hop is None else hop
    n = F.floor((F.size(samples) - size) / hop).cast("int")
    starts = F.when(F.size(samples) >= size, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(samples, i * hop + 1, size))


def rms(samples: Column, floor: float = 0.0) -> Column:
    """Root mean square."""
    return F.sqrt(_mean(F.transform(samples, lambda x: x * x)) + floor)


def decibels(value: Column, floor: float) -> Column:
    """20 log10 of a value above a floor."""
    return 20.0 * F.log10(value + floor)


def frame_db(samples: Column, size: int) -> Column:
    """Level of each frame that does not overlap another."""
    return F.transform(frames(samples, size), lambda f: decibels(rms(f, 1e-12), 1e-12))


def audio_issue(samples: Column, size: int, silence_db: float = SILENCE_DB, low_db: float = LOW_ENERGY_DB, floor_db: float = SPEECH_FLOOR_DB, decay_db: float = MAX_DECAY_DB, least: int = 10) -> Column:
    """The first defect of a clip, else null."""
    level = decibels(rms(samples, 1e-10), 1e-12)
    db = frame_db(samples, size)
    n = F.size(db)
    speech = F.filter(db, lambda x: x > floor_db)
    head = F.filter(F.slice(db, 1, F.floor(n / 3).cast("int")), lambda x: x > floor_db)
    skip = F.floor(n * 2 / 3).cast("int")
    tail = F.filter(F.slice(db, skip + 1, n), lambda x: x > floor_db)
    return (
        F.when(F.coalesce(F.size(samples), F.lit(0)) <= 0, "mostly_silence")
        .when(level < silence_db, "mostly_silence")
        .when(level < low_db, "low_energy")
        .when(n < least, "mostly_silence")
        .when(F.size(speech) < least, "mostly_silence")
        .when((F.size(head) == 0) | (F.size(tail) == 0), "mostly_silence")
        .when(_mean(head) - _mean(tail) > decay_db, "tail_decay")
    )


def snr(samples: Column, size: int = 2048, hop: int = 512) -> Column:
    """Ratio of the mean level of the loudest tenth of overlapping frames to that of the quietest, in decibels; 0 without a whole frame."""
    level = F.array_sort(F.transform(frames(samples, size, hop), lambda f: rms(f)))
    k = F.greatest(F.lit(1), F.floor(F.size(level) / 10)).cast("int")
    noise, signal = _mean(F.slice(level, 1, k)), _mean(F.slice(level, F.size(level) - k + 1, k))
    return F.when(F.size(level) > 0, 20.0 * F.log10((signal + 1e-10) / (noise + 1e-10))).otherwise(0.0)


def trim_bounds(samples: Column, size: int = 2048, hop: int = 512, silence_db: float = SILENCE_DB) -> Column:
    """Struct (first, last): the samples from the first loud frame to the end of the last; everything if no frame is loud."""
    loud = F.transform(frames(samples, size, hop), lambda f: decibels(rms(f), 1e-10) > silence_db)
    first = F.array_position(loud, True)
    last = F.size(loud) - F.array_position(F.reverse(loud), True)
    whole = F.struct(F.lit(0).cast("bigint").alias("first"), F.size(samples).cast("bigint").alias("last"))
    cut = F.struct(((first - 1) * hop).cast("bigint").alias("first"), F.least(F.size(samples).cast("bigint"), (last * hop + size).cast("bigint")).alias("last"))
    return F.when(F.coalesce(first, F.lit(0)) > 0, cut).otherwise(whole)


def sample_index(seconds: Column, rate: Column | int, length: Column) -> Column:
    """Sample of a time, cut off toward zero and held within the clip."""
    return F.greatest(F.lit(0), F.least(length.cast("bigint"), (seconds * rate).cast("bigint")))


def cut(samples: Column, start: Column, end: Column, rate: Column | int) -> Column:
    """The samples between two times."""
    a, b = sample_index(start, rate, F.size(samples)), sample_index(end, rate, F.size(samples))
    return F.slice(samples, (a + 1).cast("int"), F.greatest(F.lit(0), b - a).cast("int"))


def to_mono(channels: Column) -> Column:
    """Mean over an array of channels of equal length."""
    total = F.aggregate(F.slice(channels, 2, F.size(channels)), channels[0], lambda a, c: F.zip_with(a, c, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.size(channels))


def clip_samples(samples: Column) -> Column:
    """Samples held within -1 and 1."""
    return F.transform(samples, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))
