"""PCM audio: scanning, decoding and cutting inside tasks.

Recordings stay binary rows; samples exist only inside an Arrow batch.  Other containers need a decoder that the caller plugs in, and another
resampler can be plugged in too.  A recording that cannot be read is a row with its error; the others go on.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions.text import call_id_of, data_uri, utc_iso
from turnloom.schemas import AUDIO_SUFFIXES, SILENCE_DB
from turnloom.sources import measures, riff, wavfiles

Decoder = Callable[[bytes], tuple[np.ndarray, int]]
Resampler = Callable[[np.ndarray, int, int], np.ndarray]


def scan(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Audio files of a folder by suffix, without regard to case: path, modificationTime, length, content, call_id."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.where(suffix.isin(*AUDIO_SUFFIXES)).withColumn("call_id", call_id_of(F.col("path")))


def under(spark: SparkSession, prefix: str) -> DataFrame:
    """All files below a prefix of a store that Spark reads, with their names relative to it; folder markers are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    name = F.regexp_replace("path", "^.*?" + re.escape(prefix.rstrip("/").split("://")[-1].lstrip("/")) + "/", "")
    return files.where(~F.col("path").endswith("/") & ~((F.col("length") == 0) & F.col("path").endswith("_$folder$"))).withColumn("name", name)


def whole_calls(files: DataFrame, name: str = "full_normalized.wav") -> DataFrame:
    """One file a call: its whole recording; the plain files only if there is no whole recording at all."""
    marked = files.withColumn("_whole", F.element_at(F.split("path", "/"), -1) == name)
    any_whole = F.broadcast(marked.agg(F.coalesce(F.max("_whole"), F.lit(False)).alias("_any")))  # one row
    return marked.join(any_whole).where(F.col("_whole") | ~F.col("_any")).drop("_whole", "_any")


def header(content: bytes) -> tuple[int, int, int]:
    """Rate, channels and frames of a WAV from its header alone."""
    return riff.frames_of(riff.in_memory(content))


def decode(content: bytes) -> tuple[np.ndarray, int]:
    """Samples (frames x channels, float32 within -1 and 1) and rate of a PCM or float WAV; ValueError for anything else."""
    source = riff.in_memory(content)
    (kind, channels, rate, _, _, bits), start, end = riff.chunks(source)
    step = channels * bits // 8
    x = riff.samples_of(source.read(start, (end - start) // step * step), kind, bits)
    if not len(x):
        raise ValueError("no audio frames")
    return x.reshape(-1, channels), rate


def wav_head(size: int, channels: int, rate: int) -> bytes:
    """The header of a 16-bit PCM WAV of ``size`` bytes."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, 1, channels, rate, rate * channels * 2, channels * 2, 16, b"data", size)


def pcm(samples: np.ndarray) -> bytes:
    """Samples as 16 bits, held within -1 and 1."""
    return np.round(np.clip(np.asarray(samples, dtype=np.float64), -1.0, 1.0) * 32767).astype("<i2").tobytes()


def encode(samples: np.ndarray, rate: int) -> bytes:
    """A 16-bit PCM WAV of samples (frames, or frames x channels), held within -1 and 1."""
    body = pcm(samples)
    return wav_head(len(body), 1 if np.ndim(samples) == 1 else np.shape(samples)[1], rate) + body


def mono(samples: np.ndarray) -> np.ndarray:
    """Mean over channels."""
    return samples if samples.ndim == 1 else samples.mean(axis=1, dtype=np.float32)


def channels_first(samples: np.ndarray) -> np.ndarray:
    """Samples as channels x frames."""
    return samples[None, :] if samples.ndim == 1 else np.ascontiguousarray(samples.T)


def split_channels(samples: np.ndarray) -> list[np.ndarray]:
    """One array a channel."""
    return [samples] if samples.ndim == 1 else [np.ascontiguousarray(samples[:, k]) for k in range(samples.shape[1])]


def resample(samples: np.ndarray, rate: int, to: int, taps: int = 32) -> np.ndarray:
    """Windowed-sinc resampling of one channel."""
    if rate == to or not len(samples):
        return samples
    bank = measures.Resampler(rate, to, taps)
    return np.concatenate([*(bank(samples[at : at + measures.BLOCK]) for at in range(0, len(samples), measures.BLOCK)), bank.end()]).astype(np.float32)


def frame_levels(samples: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Root mean square of each whole frame."""
    return np.sqrt(measures.mean_squares(samples, size, hop))


def loud_bounds(levels: np.ndarray, n: int, silence_db: float, size: int, hop: int) -> tuple[int, int]:
    """The samples from the first loud frame to the end of the last; all of them if no frame is loud."""
    loud = np.flatnonzero(20 * np.log10(levels + 1e-10) > silence_db)
    return (int(loud[0]) * hop, min(n, int(loud[-1]) * hop + size)) if len(loud) else (0, n)


def trim(samples: np.ndarray, silence_db: float = SILENCE_DB, size: int = 2048, hop: int = 512) -> np.ndarray:
    """From the first loud frame of the mean over channels to the end of the last; unchanged if no frame is loud."""
    first, last = loud_bounds(frame_levels(mono(samples), size, hop), len(samples), silence_db, size, hop)
    return samples[first:last]


def loudness(samples: np.ndarray, rate: int) -> float:
    """Integrated loudness in LUFS (samples: frames, or frames x channels)."""
    x = samples.reshape(len(samples), -1)
    meter = measures.Loudness(rate, x.shape[1])
    for at in range(0, len(x), measures.BLOCK):
        meter.add(x[at : at + measures.BLOCK])
    return meter.value()


def gain_to(target: float, level: float, peak: float, frames: int, rate: int) -> float:
    """The factor to the target loudness; for less than 0.4 s to a peak of 0.9; 1 for silence."""
    if frames < 0.4 * rate:
        return 0.9 / peak if peak else 1.0
    return 10 ** ((target - level) / 20) if np.isfinite(level) else 1.0


def normalize(samples: np.ndarray, rate: int, target: float = -23.0) -> np.ndarray:
    """At the target loudness; a clip of less than 0.4 s at a peak of 0.9; silence unchanged."""
    short = len(samples) < 0.4 * rate
    return (samples * gain_to(target, 0.0 if short else loudness(samples, rate), float(np.abs(samples).max(initial=0.0)), len(samples), rate)).astype(np.float32)


def snr_of(levels: np.ndarray) -> float:
    """Decibels between the mean levels of the loudest and the quietest tenth of frames; 0 without a whole frame."""
    level = np.sort(levels.astype(np.float64))
    if not len(level):
        return 0.0
    k = max(1, len(level) // 10)
    return float(20 * np.log10((level[-k:].mean() + 1e-10) / (level[:k].mean() + 1e-10)))


def estimate_snr(samples: np.ndarray, size: int = 2048, hop: int = 512) -> float:
    """The ratio of loud to quiet frames of the mean over channels."""
    return snr_of(frame_levels(mono(samples), size, hop))


def cut(samples: np.ndarray, rate: int, start: float, end: float) -> np.ndarray:
    """Samples between two times, cut off toward zero and held within the clip."""
    a, b = (max(0, min(len(samples), int(t * rate))) for t in (start, end))
    return samples[a:b]


INFO = "path string, call_id string, ok boolean, error string, sample_rate int, channels int, frames bigint, duration double"


def headers(files: DataFrame, decoder: Decoder | None = None) -> DataFrame:
    """Rate, channels, frames and seconds of each file; a bad file is a row with its error.

    Files are asked by byte ranges at their paths, so their contents are neither scanned nor sent to Python; see ``wavfiles.headers_under`` for
    a scan that does the listing too.  A ``decoder`` for other containers gets whole contents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            if decoder is None:
                for path, call, length in zip(*(batch.column(c).to_pylist() for c in ("path", "call_id", "length")), strict=True):
                    system, place = wavfiles.opened(path)
                    _, _, _, ok, error, *about = wavfiles.header_row(system, place, path, length)
                    rows.append((path, call, ok, error, *about))
            else:
                for path, call, content in zip(*(batch.column(c).to_pylist() for c in ("path", "call_id", "content")), strict=True):
                    try:
                        x, rate = decoder(content)
                        rows.append((path, call, True, None, rate, x.shape[1], len(x), len(x) / rate))
                    except Exception as e:  # whatever a decoder raises: the file fails, the others go on
                        rows.append((path, call, False, f"{type(e).__name__}: {e}", None, None, None, None))
            yield _batch(rows, INFO)

    return files.select("path", "call_id", "length" if decoder is None else "content").mapInArrow(run, INFO)


_TYPES = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _TYPES[t]) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


PREPARED = (
    "call_id string, part string, original_file string, original_format string, original_sample_rate int, original_channels int, original_duration_seconds double, "
    "output_sample_rate int, output_bit_depth int, output_duration_seconds double, target_lufs double, silence_threshold_db double, snr_db double, error string, content binary"
)


Blocks = Callable[[], Iterator[np.ndarray]]


def sliced(samples: np.ndarray) -> Blocks:
    """Samples (frames x channels) that are there already, block by block."""
    return lambda: (samples[at : at + measures.BLOCK] for at in range(0, len(samples), measures.BLOCK))


def resampled(blocks: Blocks, channels: int, rate: int, to: int) -> Blocks:
    """Blocks at another rate."""
    if rate == to:
        return blocks

    def run() -> Iterator[np.ndarray]:
        banks = [measures.Resampler(rate, to) for _ in range(channels)]
        for block in blocks():
            yield np.stack([bank(block[:, c]) for c, bank in enumerate(banks)], axis=1).astype(np.float32)
        yield np.stack([bank.end() for bank in banks], axis=1).astype(np.float32)

    return run


def within(blocks: Blocks, first: int, last: int) -> Iterator[np.ndarray]:
    """The blocks' samples between two places."""
    at = 0
    for block in blocks():
        part = block[max(0, first - at) : max(0, last - at)]
        at += len(block)
        if len(part):
            yield part


def levelled(blocks: Blocks, channels: int, rate: int, target: float, silence_db: float, size: int = 2048, hop: int = 512) -> tuple[int, float, list[bytes]]:
    """Trim and level a recording in three passes over its blocks: frame levels; loudness of what is left; samples of 16 bits.

    Returns frames, SNR and the bodies of the mix and of each channel.  Beside the bodies, only a few numbers a hop are held.
    """
    whole = measures.Energies(size, hop)
    for block in blocks():
        whole.add(mono(block))
    first, last = loud_bounds(np.sqrt(whole.mean_squares()), whole.n, silence_db, size, hop)
    meter, peak = measures.Loudness(rate, channels), 0.0
    for block in within(blocks, first, last):
        peak = max(peak, float(np.abs(block).max()))
        meter.add(block)
    gain = gain_to(target, meter.value() if last - first >= 0.4 * rate else 0.0, peak, last - first, rate)
    bodies, left = [bytearray() for _ in range(1 + channels)], measures.Energies(size, hop)
    for block in within(blocks, first, last):
        block = (block * gain).astype(np.float32)
        mixed = mono(block)
        left.add(mixed)
        for body, sound in zip(bodies, (mixed, *block.T), strict=True):
            body += pcm(sound)
    return last - first, snr_of(np.sqrt(left.mean_squares())), [bytes(b) for b in bodies]


def prepare(files: DataFrame, rate: int = 24000, target: float = -23.0, silence_db: float = SILENCE_DB, decoder: Decoder = decode, resampler: Resampler = resample) -> DataFrame:
    """Decode, resample, trim and level each recording: one row for the mix and, for several channels, one for each.

    Channels are trimmed and levelled together, so they stay in step.  WAV goes through block by block; a plugged-in decoder or resampler gets
    whole recordings, and whatever it raises is the error of that recording alone.
    """
    own_decoder, own_resampler = decoder is decode, resampler is resample

    def one(content: bytes) -> tuple[int, int, int, int, float, list[bytes]]:
        if own_decoder:
            source = riff.in_memory(content)
            own, channels, frames = riff.frames_of(source)
            if not frames:
                raise ValueError("no audio frames")
            blocks: Blocks = lambda: riff.blocks_of(source)
        else:
            x, own = decoder(content)
            x = x.reshape(len(x), -1)
            frames, channels = x.shape
            blocks = sliced(x)
        if own_resampler:
            blocks = resampled(blocks, channels, own, rate)
        else:
            x = np.concatenate(list(blocks()))
            blocks = sliced(np.stack([resampler(c, own, rate) for c in split_channels(x)], axis=1))
        return own, channels, frames, *levelled(blocks, channels, rate, target, silence_db)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, call, content in zip(*(batch.column(c).to_pylist() for c in ("path", "call_id", "content")), strict=True):
                name = path.rsplit("/", 1)[-1]
                try:
                    own, channels, frames, left, snr, bodies = one(content)
                except Exception as e:  # the recording fails, the others go on
                    yield _batch([(call, None, name, *[None] * 10, f"{type(e).__name__}: {e}", None)], PREPARED)
                    continue
                parts = ["full_normalized"] + [f"channel_{k}" for k in range(channels)] * (channels > 1)
                about = (name, name.rpartition(".")[2], own, channels, round(frames / own, 2), rate, 16, round(left / rate, 2), target, silence_db, round(snr, 1), None)
                for part, body in zip(parts, bodies, strict=False):
                    yield _batch([(call, part, *about, wav_head(len(body), 1, rate) + body)], PREPARED)

    return files.select("path", "call_id", "content").mapInArrow(run, PREPARED)


def recording_metadata(prepared: DataFrame) -> DataFrame:
    """One row a recording: what it was, what was made of it, and the names of its files, the mix first."""
    about = [f.split()[0] for f in PREPARED.split(", ")][2:13]
    names = F.collect_list(F.when(F.col("content").isNotNull(), F.struct((F.col("part") != "full_normalized").alias("k"), F.concat("part", F.lit(".wav")).alias("name"))))
    made = prepared.groupBy("call_id", "error", *about).agg(F.transform(F.array_sort(names), lambda x: x["name"]).alias("output_files"))
    return made.withColumn("processed_at", utc_iso())


CLIPS = "call_id string, idx int, name string, audio_issue string, n_samples bigint, sample_rate int, error string, content binary"


def clips(turns: DataFrame, audio: DataFrame, decoder: Decoder = decode) -> DataFrame:
    """Cut each turn out of its call's recording and judge it; calls without audio have no clips, and a broken recording is one row with its error.

    Turns are grouped into one row a call before they meet the recording, so a recording moves once.  Of a WAV only the turns' own stretches
    become samples; a plugged-in decoder gets whole recordings.
    """
    own_decoder = decoder is decode

    def reader_of(content: bytes) -> tuple[int, Callable[[float, float], np.ndarray]]:
        if not own_decoder:
            x, rate = decoder(content)
            return rate, lambda start, end: cut(x, rate, start, end)
        source = riff.in_memory(content)
        (kind, channels, rate, _, _, bits), begin, stop = riff.chunks(source)
        step = channels * bits // 8
        frames = (stop - begin) // step
        if not frames:
            raise ValueError("no audio frames")

        def read(start: float, end: float) -> np.ndarray:
            a, b = (max(0, min(frames, int(t * rate))) for t in (start, end))
            return riff.samples_of(source.read(begin + a * step, max(0, b - a) * step), kind, bits).reshape(-1, channels)

        return rate, read

    listed = turns.groupBy("call_id").agg(F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "start_s", "end_s", "speaker"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for call, content, parts in zip(*(batch.column(c).to_pylist() for c in ("call_id", "content", "turns")), strict=True):
                rows = []
                try:
                    rate, read = reader_of(content)
                    for t in parts:
                        y = mono(read(t["start_s"], t["end_s"]))
                        rows.append((call, t["idx"], f"turn_{t['idx'] + 1:03d}_{t['speaker']}.wav", issue(y, rate), len(y), rate, None, encode(y, rate)))
                except Exception as e:  # the recording fails, the others go on
                    rows = [(call, None, None, None, None, None, f"{type(e).__name__}: {e}", None)]
                yield _batch(rows, CLIPS)

    return listed.join(audio.select("call_id", "content"), "call_id").mapInArrow(run, CLIPS)


def clip_uris(turns: DataFrame, audio: DataFrame) -> DataFrame:
    """Each turn's own stretch of its call's recording as a data URI."""
    return clips(turns, audio).where("error IS NULL").select("call_id", "idx", data_uri(F.col("content")).alias("uri"))


def issue(samples: np.ndarray, rate: int, frame_ms: int = 30) -> str | None:
    """The first defect of a clip; see ``turnloom.functions.signal.audio_issue``."""
    from turnloom.schemas import LOW_ENERGY_DB, MAX_DECAY_DB, SPEECH_FLOOR_DB

    if not len(samples):
        return "mostly_silence"
    level = 20 * np.log10(np.sqrt(np.mean(samples.astype(np.float64) ** 2) + 1e-10) + 1e-12)
    if level < SILENCE_DB:
        return "mostly_silence"
    if level < LOW_ENERGY_DB:
        return "low_energy"
    size = max(1, rate * frame_ms // 1000)
    db = 20 * np.log10(np.sqrt(frame_levels(samples, size, size).astype(np.float64) ** 2 + 1e-12) + 1e-12)
    speech = db > SPEECH_FLOOR_DB
    n = len(db)
    if n < 10 or speech.sum() < 10:
        return "mostly_silence"
    head, tail = db[: n // 3][speech[: n // 3]], db[2 * n // 3 :][speech[2 * n // 3 :]]
    if not len(head) or not len(tail):
        return "mostly_silence"
    return "tail_decay" if head.mean() - tail.mean() > MAX_DECAY_DB else None


def audio_of_calls(calls: DataFrame, files: DataFrame, name: str = "full_normalized.wav") -> DataFrame:
    """Add ``path``: the call's whole recording, else its plain file, else null with an ``error``, so that one call's lack fails only that call."""
    marked = files.select("call_id", "path", (F.element_at(F.split("path", "/"), -1) == name).alias("_whole"))
    found = marked.groupBy("call_id").agg(F.max(F.when(F.col("_whole"), F.col("path"))).alias("_first"), F.max(F.when(~F.col("_whole"), F.col("path"))).alias("_second"))
    out = calls.join(found, "call_id", "left").withColumn("path", F.coalesce("_first", "_second")).drop("_first", "_second")
    return out.withColumn("error", F.when(F.col("path").isNull(), F.concat(F.lit("no audio for call "), F.col("call_id").cast("string"))))
