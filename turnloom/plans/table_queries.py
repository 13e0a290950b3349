"""Queries that write tables or files in the shared folder and read them again, and queries over recordings made of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom import failures
from turnloom.fixtures import Views
from turnloom.functions import text
from turnloom.operators import catalog, dataset, dialogue, review, stats, voiceprint
from turnloom.plans import pipeline, stages, tables
from turnloom.plans.queries import BLOCKS3, LOOKED_UP, MEANS, MERGED, ORACLES, SCORED, _catalog, _Reviewer, _verdict_lines, islands, query, r6, scored_answers
from turnloom.sources import documents, measures, wav, wavfiles
from turnloom.streaming import intake, turns

# ---------------------------------------------------------------- steps, their states and counts
CLEAN = "SELECT t.* FROM {turns} t LEFT JOIN (SELECT call_id, idx, strpos(upper(line), 'SENSITIVE') > 0 AS sensitive FROM {verdicts}) f ON f.call_id = t.call_id AND f.idx = t.idx WHERE NOT coalesce(f.sensitive, false)"
SAME = "speaker = lag(speaker) OVER w AND start_s - lag(end_s) OVER w <= 0.5"


def _merged_rows(source: str) -> str:
    return islands(source, SAME, "idx") + " SELECT count(*) FROM (SELECT DISTINCT call_id, island FROM i)"


def _states_sql() -> str:
    before, after = {"diarize": "SELECT count(*) FROM {turns}", "segment": _merged_rows("SELECT * FROM {turns}")}, {"scrub": f"SELECT count(*) FROM ({CLEAN})", "segment": _merged_rows(CLEAN)}
    after |= {"diarize": before["diarize"], "validate": after["scrub"]}
    before["validate"] = before["diarize"]
    told = [(1, "diarize", "kept", before), (1, "scrub", "missing", {}), (1, "validate", "stale", before), (1, "segment", "stale", before)]
    told += [(2, s, "kept", after) for s in ("diarize", "scrub", "validate", "segment")]
    told += [(3, s, "stale" if s == "segment" else "kept", after) for s in ("diarize", "scrub", "validate", "segment")]
    told += [(4, "diarize", "kept", after), (4, "scrub", "stale", after), (4, "validate", "stale", after), (4, "segment", "stale", after)]
    return " UNION ALL ".join(f"SELECT {at} AS phase, '{s}' AS step, '{state}' AS state, {'CAST((' + rows[s] + ') AS BIGINT)' if s in rows else 'CAST(NULL AS BIGINT)'} AS rows" for at, s, state, rows in told)


@query("i2_step_states", _states_sql())
def _(v: Views) -> DataFrame:
    """Steps run without scrubbing; then scrubbing is turned on, run, a setting changes, and a table loses its files' identity."""
    root = tables.new_path(v.spark, "steps")
    made = {
        "diarize": lambda t: v.turns,
        "scrub": lambda t: review.without_sensitive(t["diarize"], review.scrub_flags(_verdict_lines(v))),
        "validate": lambda t: review.timing_issues((rows := t.get("scrub", t["diarize"])).withColumn("issues", F.array().cast("array<string>")), dialogue.duration(rows)),
        "segment": lambda t: stages.segment(t["validate"]),
    }
    told, log = [], pipeline.Manifest()
    steps, gap = list(made), {"segment": {"max_gap": 0.5}}

    def tell(phase: int, settings: dict) -> None:
        rows = {s: c["rows"] for s, c in log.tallies().items()}
        told.extend((phase, s, state, rows.get(s)) for s, state, _ in pipeline.states(v.spark, root, steps, log, settings))

    pipeline.run(v.spark, root, made, [s for s in steps if s != "scrub"], log, settings=gap)
    tell(1, gap)
    pipeline.run(v.spark, root, made, steps, log, settings=gap)
    tell(2, gap)
    tell(3, {"segment": {"max_gap": 1.0}})
    v.spark.read.parquet(f"{root}/scrub").write.mode("append").parquet(f"{root}/scrub")  # somebody else writes into a table
    tell(4, gap)
    return v.spark.createDataFrame(told, "phase int, step string, state string, rows bigint")  # one row a phase and step


@query("g24_tallies", BLOCKS3 + " SELECT 'succeeded' AS status, CAST(sum((n + 3) // 4 - CASE WHEN n % 4 = 3 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM n UNION ALL SELECT 'failed', count(*) FILTER (n % 4 = 3) FROM n")
def _(v: Views) -> DataFrame:
    """What the model's answers came to, counted by the job that wrote them."""
    log, ok = pipeline.Manifest(), F.col("answer")["ok"]
    counts = {"validate": {"succeeded": F.count_if(ok), "failed": F.count_if(~ok)}}
    pipeline.run(v.spark, tables.new_path(v.spark, "answers"), {"validate": lambda t: stages.validation_answers(v.calls, v.turns, _Reviewer, ("en", "fr"), 4)}, ["validate"], log, metrics=counts)
    found = log.tallies()["validate"]
    return v.spark.createDataFrame([(s, found[s]) for s in ("succeeded", "failed")], "status string, n bigint")


GONE = "SELECT '{stage}' AS stage, count(*) AS before, count(*) FILTER ({cond}) AS gone, count(*) FILTER (NOT ({cond})) AS after, CAST(sum(t.call_id * 31 + {idx}) FILTER (NOT ({cond})) AS BIGINT) AS digest FROM {table} t LEFT JOIN {calls} c ON c.call_id = t.call_id"


def _gone_sql(stage: str, table: str, idx: str, cond: str) -> str:
    return GONE.replace("{stage}", stage).replace("{table}", table).replace("{idx}", idx).replace("{cond}", cond)


@query("i3_stored_removal", " UNION ALL ".join([_gone_sql("validate", "{calls}", "0", "false"), _gone_sql("segment", "{turns}", "t.idx", "coalesce(c.language = 'de', false)"), _gone_sql("filter", "{judged}", "t.idx", "coalesce(c.language = 'de', false)")]))
def _(v: Views) -> DataFrame:
    """Stored stage tables before and after calls were removed from one of them and from what follows it."""
    root, order = tables.new_path(v.spark, "removal"), ["validate", "segment", "filter"]
    made = {"validate": v.calls.withColumn("idx", F.lit(0)), "segment": v.turns, "filter": v.judged}
    before = {s: tables.write_bucketed(made[s], f"{root}/{s}")["rows"] for s in order}
    plan = catalog.Invalidation(v.calls.where("language = 'de'"), ["segment"], order)
    planned = {r.stage: r.gone for r in plan.remove(v.spark, root).groupBy("stage").agg(F.sum("gone").alias("gone")).collect()}  # nothing has changed yet
    untouched = {s: tables.read_bucketed(v.spark, f"{root}/{s}").count() for s in order}
    gone = plan.remove(v.spark, root, execute=True)
    if untouched != before or planned != {s: n for s, n in gone.items() if n}:
        raise AssertionError("the dry run told something else")
    parts = []
    for s in order:
        left = tables.read_bucketed(v.spark, f"{root}/{s}").agg(F.count("*").alias("after"), F.sum(F.col("call_id") * 31 + F.col("idx")).cast("bigint").alias("digest"))
        parts.append(left.select(F.lit(s).alias("stage"), F.lit(before[s]).cast("bigint").alias("before"), F.lit(gone.get(s, 0)).cast("bigint").alias("gone"), "after", "digest"))
    return failures.gathered(*parts)


# ---------------------------------------------------------------- arriving turns
@query("f2_arriving_turns", ORACLES["f2_merge_turns"])
def _(v: Views) -> DataFrame:
    """The given turns as files that arrive one after the other, each call's turns in several of them and not in order."""
    spark, root = v.spark, tables.new_path(v.spark, "arriving")
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for part in (0, 2, 1):
            v.turns.where(F.col("idx") % 3 == part).write.parquet(f"{root}/in/part={part}")
            stream = intake.new_files(spark, f"{root}/in/part=*", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in v.turns.schema))
            query_ = turns.merged_turns(stream).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/log").trigger(availableNow=True).start()
            query_.awaitTermination()
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return turns.latest(spark.read.parquet(f"{root}/out")).select("call_id", "idx", "speaker", r6("start_s"), r6("end_s"), "text", "merged_from", "turn")


@query("j2_speaker_bins", LOOKED_UP + " SELECT call_id, idx, CAST(k AS INT) AS k, word, speaker FROM r WHERE rn = 1")
def _(v: Views) -> DataFrame:
    """The lookup of j2 with each call split into bins of a minute."""
    return dialogue.speakers_at(v.words, v.timeline, bin_s=60.0).select("call_id", "idx", "k", "word", "speaker")


# ---------------------------------------------------------------- files and documents
def _sounds(v: Views) -> DataFrame:
    """Recordings of whole takes as WAV files: take_id, name, content; their samples lie on the grid of 16 bits."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids = b.column(0).to_pylist()
            made = [wav.encode(np.trunc(np.array(x) * 16384) / 32767, 8000 + i % 3 * 1000) for i, x in zip(ids, b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f"take{i}.WAV" for i in ids]), pa.array(made, pa.binary())], names=["take_id", "name", "content"])

    return v.takes.mapInArrow(run, "take_id bigint, name string, content binary")


@query("a5_header_durations", "SELECT take_id, 8000 + CAST(take_id % 3 AS INT) * 1000 AS sample_rate, CAST(1 AS INT) AS channels, count(*) AS frames, round(count(*) / CAST(8000 + take_id % 3 * 1000 AS DOUBLE), 6) AS duration FROM {takes} GROUP BY take_id HAVING 44 + 2 * count(*) > 1000")
def _(v: Views) -> DataFrame:
    """Takes written as files, and what their headers say; suffix and length are filters of the listing."""
    root = tables.new_path(v.spark, "headers")
    wavfiles.write_files(_sounds(v), root, "take_id")
    found = wavfiles.headers_under(v.spark, root, recursive=True).where("suffix = 'wav' AND length > 1000 AND ok")
    return found.select(F.regexp_extract("path", r"take(\d+)\.WAV$", 1).cast("bigint").alias("take_id"), "sample_rate", "channels", "frames", r6("duration"))


@query("b1_recording_files", "SELECT take_id, count(*) AS frames, CAST(sum(trunc(v * 16384)) AS BIGINT) AS total FROM {takes} GROUP BY take_id")
def _(v: Views) -> DataFrame:
    """Takes written as files by a job with a commit, scanned and decoded again."""
    root = tables.new_path(v.spark, "recordings")
    wavfiles.write_files(_sounds(v), root, "take_id")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sounds = [wav.decode(x)[0][:, 0].astype("float64") for x in b.column("content").to_pylist()]
            ids = [int(p.rpartition("take")[2].partition(".")[0]) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) for x in sounds], pa.int64()), pa.array([round(float((x * 32768).sum())) for x in sounds], pa.int64())], names=["take_id", "frames", "total"])

    return wav.scan(v.spark, root, recursive=True).select("path", "content").mapInArrow(run, "take_id bigint, frames bigint, total bigint")


@query("a9_quarantine", "SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS item, (conv_id * 31 + turn) % 10 <> 0 AS sound, CASE WHEN (conv_id * 31 + turn) % 10 <> 0 THEN length(text) END AS chars FROM conversations")
def _(v: Views) -> DataFrame:
    """Documents of all given texts, every tenth cut in the middle: the sound ones, and the others by file and beginning."""
    path = tables.new_path(v.spark, "documents")
    turn = F.struct(F.lit("a").alias("speaker"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), "text")
    whole = F.to_json(F.struct(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("call_id"), F.lit("made from a given text").alias("mode"), F.lit("en").alias("language"), F.lit(1).alias("num_speakers"), F.array(turn).alias("turns")))
    cut = F.when((F.col("conv_id") * 31 + F.col("turn")) % 10 == 0, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))).otherwise(whole)
    v.conversations.select(cut.alias("value")).write.text(path)
    good, bad = documents.read_documents(v.spark, path, lines=True)
    sound = good.select(F.col("call_id").alias("item"), F.lit(True).alias("sound"), F.length(F.col("turns")[0]["text"]).cast("bigint").alias("chars"))
    broken = bad.where(F.col("item").contains("/documents-")).select(F.regexp_extract("error", '"call_id":"([^"]*)"', 1).alias("item"), F.lit(False).alias("sound"), F.lit(None).cast("bigint").alias("chars"))
    return sound.unionByName(broken)


# ---------------------------------------------------------------- recordings
def _measured(v: Views, schema: str, measure) -> DataFrame:
    """A row, or rows, of numbers for each take: ``measure`` gets its samples in blocks of 1000."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        types = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
        fields = [f.split() for f in schema.split(", ")]
        for b in batches:
            rows = [(i, *row) for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for row in measure(np.array(x), lambda x: (x[at : at + 1000] for at in range(0, len(x), 1000)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types[t]) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

    return v.takes.mapInArrow(run, schema)


@query("w3_resampled", """
    WITH n AS (SELECT take_id, count(*) AS n FROM {takes} GROUP BY take_id),
    o AS (SELECT take_id, unnest(range(CAST(round_even(n * 32000.0 / 48000, 0) AS BIGINT))) AS k FROM n),
    p AS (SELECT take_id, k, k * 3 // 2 AS base, k * 1.5 AS place FROM o),
    t AS (SELECT take_id, k, base + j AS i, CAST(place AS DOUBLE) - (base + j) AS d FROM p, (SELECT unnest(range(-48, 49)) AS j) j),
    y AS (SELECT t.take_id, t.k, sum(x.v * (2.0 / 3) * CASE WHEN d = 0 THEN 1 ELSE sin(pi() * d * 2 / 3) / (pi() * d * 2 / 3) END * (0.5 + 0.5 * cos(pi() * greatest(-1.0, least(1.0, d / 49))))) AS y FROM t JOIN {takes} x ON x.take_id = t.take_id AND x.i = t.i GROUP BY ALL)
    SELECT take_id, k, round(y, 6) + 0.0 AS y FROM y""")
def _(v: Views) -> DataFrame:
    """Takes of 48 kHz at 32 kHz, through the filter bank in blocks."""

    def measure(x, blocks):
        import numpy as np

        bank = measures.Resampler(48000, 32000)
        y = np.concatenate([*(bank(part) for part in blocks(x)), bank.end()])
        return enumerate(y.tolist())

    return _measured(v, "take_id bigint, k bigint, y double", measure).select("take_id", "k", r6("y"))


SQUARES = "WITH f AS (SELECT take_id, k, avg(v * v) AS ms FROM (SELECT take_id, i, v, unnest(range(greatest(0, i // {hop} - {over}), i // {hop} + 1)) AS k FROM {takes}) WHERE i >= k * {hop} AND i < k * {hop} + {size} GROUP BY take_id, k HAVING count(*) = {size})"


def _frames_sql(size: int, hop: int) -> str:
    return SQUARES.replace("{hop}", str(hop)).replace("{over}", str(size // hop)).replace("{size}", str(size))


@query("w9_take_levels", _frames_sql(300, 128) + " SELECT take_id, CAST(k AS BIGINT) AS frame, round(20 * log10(sqrt(ms) + 1e-10), 4) AS db FROM f")
def _(v: Views) -> DataFrame:
    """Levels of overlapping frames whose length is no multiple of the hop, from sums a hop."""

    def measure(x, blocks):
        import numpy as np

        energies = measures.Energies(300, 128)
        for part in blocks(x):
            energies.add(part)
        return enumerate((20 * np.log10(np.sqrt(energies.mean_squares()) + 1e-10)).tolist())

    return _measured(v, "take_id bigint, frame bigint, db double", measure).select("take_id", "frame", F.round("db", 4).alias("db"))


@query("w4_take_bounds", _frames_sql(256, 64) + ", l AS (SELECT take_id, min(k) AS a, max(k) AS b FROM f WHERE 20 * log10(sqrt(ms) + 1e-10) > -40 GROUP BY take_id), n AS (SELECT take_id, count(*) AS n FROM {takes} GROUP BY take_id) SELECT n.take_id, coalesce(a * 64, 0) AS first, coalesce(least(n.n, b * 64 + 256), n.n) AS last FROM n LEFT JOIN l ON l.take_id = n.take_id")
def _(v: Views) -> DataFrame:
    """Where takes begin and end to be loud."""

    def measure(x, blocks):
        import numpy as np

        energies = measures.Energies(256, 64)
        for part in blocks(x):
            energies.add(part)
        return [wav.loud_bounds(np.sqrt(energies.mean_squares()), len(x), -40.0, 256, 64)]

    return _measured(v, "take_id bigint, first bigint, last bigint", measure)


def _loudness_sql(rate: int = 8000) -> str:
    """K-weighting as a recursion over samples, by the coefficients of the filters."""
    (shelf, high, _), = measures.Loudness(rate, 1).parts
    steps = []
    for f in (shelf, high):
        (a1, _), (a2, _) = (-f.step).tolist()
        steps.append((f.b0, f.feed[0] + a1 * f.b0, f.feed[1] + a2 * f.b0, a1, a2))
    (b0, b1, b2, a1, a2), (d0, d1, d2, c1, c2) = [[repr(float(x)) for x in s] for s in steps]
    one = f"({b0} * x.v + r.u1)"
    two = f"({d0} * {one} + r.w1)"
    return f"""
    WITH RECURSIVE x AS (SELECT take_id, i, v FROM {{takes}}),
    r AS (SELECT take_id, CAST(-1 AS BIGINT) AS i, 0.0::DOUBLE AS u1, 0.0::DOUBLE AS u2, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0.0::DOUBLE AS y FROM (SELECT DISTINCT take_id FROM x)
      UNION ALL SELECT r.take_id, x.i, {b1} * x.v - {a1} * {one} + r.u2, {b2} * x.v - {a2} * {one}, {d1} * {one} - {c1} * {two} + r.w2, {d2} * {one} - {c2} * {two}, {two} FROM r JOIN x ON x.take_id = r.take_id AND x.i = r.i + 1),
    f AS (SELECT take_id, k, avg(y * y) AS ms FROM (SELECT take_id, i, y, unnest(range(greatest(0, i // {rate // 10} - 4), i // {rate // 10} + 1)) AS k FROM r WHERE i >= 0) WHERE i < k * {rate // 10} + {rate * 4 // 10} GROUP BY take_id, k HAVING count(*) = {rate * 4 // 10}),
    g AS (SELECT take_id, avg(ms) AS m FROM f WHERE -0.691 + 10 * log10(ms) >= -70 GROUP BY take_id)
    SELECT f.take_id, round(-0.691 + 10 * log10(avg(ms)), 4) AS lufs FROM f JOIN g ON g.take_id = f.take_id WHERE -0.691 + 10 * log10(ms) >= greatest(-70, -0.691 + 10 * log10(m) - 10) GROUP BY f.take_id"""


@query("w5_loudness", _loudness_sql())
def _(v: Views) -> DataFrame:
    """Integrated loudness of takes, filtered block by block."""

    def measure(x, blocks):
        meter = measures.Loudness(8000, 1)
        for part in blocks(x):
            meter.add(part[:, None])
        value = meter.value()
        return [(value,)] if value > float("-inf") else []

    return _measured(v, "take_id bigint, lufs double", measure).select("take_id", F.round("lufs", 4).alias("lufs"))


# ---------------------------------------------------------------- the report with totals
@query("g15_stage_rollup", MERGED + """,
    told AS (SELECT 'diarize' AS stage, t.call_id, c.language, t.end_s - t.start_s AS seconds FROM {turns} t JOIN {calls} c ON c.call_id = t.call_id UNION ALL SELECT 'segment', m.call_id, c.language, m.end_s - m.start_s FROM m JOIN {calls} c ON c.call_id = m.call_id)
    SELECT stage, language, CAST(grouping(stage, language) AS INT) AS level, CASE WHEN grouping(stage) = 1 THEN count(DISTINCT stage || ' ' || call_id) ELSE count(DISTINCT call_id) END AS calls, CAST(count(*) AS BIGINT) AS turns, round(sum(seconds), 3) AS seconds FROM told GROUP BY ROLLUP (stage, language)""")
def _(v: Views) -> DataFrame:
    """Calls, turns and seconds of two stages with all totals."""
    told = lambda rows: rows.join(v.calls.select("call_id", "language"), "call_id").withColumn("seconds", dialogue.duration(rows))
    out = stats.stage_rollup({"diarize": told(v.turns), "segment": told(dialogue.merge_turns(v.turns))})
    return out.withColumn("seconds", F.round("seconds", 3))


# ---------------------------------------------------------------- whole stages
class _Censor:
    """A stand-in model: every fourth numbered line of a prompt is sensitive."""

    def complete(self, prompts, max_tokens):
        import re

        return ["\n".join(f"{i}. {'SENSITIVE' if int(i) % 4 == 3 else 'CLEAN'}" for i in re.findall(r"(?m)^(\d+)\. \[spk_", p)) for p in prompts]


@query("p3_scrubbed_turns", "SELECT call_id, idx, speaker FROM {turns} WHERE (idx % 20 + 1) % 4 <> 3")
def _(v: Views) -> DataFrame:
    return stages.scrub(v.turns, _Censor)[0].select("call_id", "idx", "speaker")


class _Hearer:
    """A stand-in model: what it hears is the text of the recording's bytes."""

    def transcribe(self, content, num_speakers, language):
        return bytes(content).decode()


@query("p2_multimodal_turns", SCORED.replace(" AS item,", " AS call_id,"))
def _(v: Views) -> DataFrame:
    """The back end whose model writes down who says what, chosen by its mode."""
    files = scored_answers(v).select("call_id", F.col("response").cast("binary").alias("content"))
    return stages.diarize_by_mode("llamacpp", files, _Hearer, language="en")[0].select("call_id", F.col("idx").alias("pos"), "speaker", "text")


@query("p7_labelled_turns", MEANS + " SELECT v.call_id, v.idx, v.speaker, CASE WHEN v.speaker = b.best_speaker THEN 'me' ELSE 'other' END AS speaker_label FROM {vectors} v JOIN b ON b.call_id = v.call_id")
def _(v: Views) -> DataFrame:
    """The whole stage: longest turns, mean vectors, match and labels."""
    rows = v.vectors.select("call_id", "speaker", "idx", (F.col("idx") * 7 % 11).cast("double").alias("duration"))
    print_ = voiceprint.enroll(v.vectors.where("label = 0"), "made-up", "label-0")
    return stages.label(rows, v.vectors, print_, "made-up")[0].select("call_id", "idx", "speaker", "speaker_label")


@query("p8_exported_files", "SELECT CAST(call_id AS VARCHAR) || '_turn_' || printf('%03d', idx) || '.wav' AS name, 'train' AS split, trim(text, chr(32)||chr(9)||chr(10)||chr(13)) AS text, CAST(44 + 2 * length(text) AS BIGINT) AS bytes FROM {labelled} WHERE speaker_label = 'me' AND has_audio")
def _(v: Views) -> DataFrame:
    """Clips and manifests written as files and read back; a manifest's path must be that of a file."""
    root = tables.new_path(v.spark, "export")
    rows = dataset.own_turns(v.labelled).withColumn("split", F.lit("train"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            made = [wav.encode(np.zeros(n, np.float32), 8000) for n in b.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("call_id"), b.column("idx"), pa.array(made, pa.binary())], names=["call_id", "idx", "content"])

    clips = v.labelled.select("call_id", "idx", F.length("text").alias("n")).mapInArrow(run, "call_id bigint, idx bigint, content binary")
    stages.export_files(rows, clips, root)
    listed = documents.read_manifests(v.spark, f"{root}/train.jsonl", f"{root}/val.jsonl")
    found = wav.scan(v.spark, root, recursive=True).select(F.regexp_replace("path", "^file:/+", "/").alias("audio"), F.col("length").alias("bytes"))
    placed = listed.withColumn("audio", F.regexp_replace("audio", "^file:/+", "/"))
    return placed.join(found, "audio").select(F.element_at(F.split("audio", "/"), -1).alias("name"), "split", "text", "bytes")


@query("a10_manifest_lines", "SELECT CAST(call_id AS VARCHAR) || '-' || CAST(idx AS VARCHAR) AS audio, text, round(duration, 3) AS duration, count(*) OVER () AS checked FROM {labelled} WHERE text IS NOT NULL")
def _(v: Views) -> DataFrame:
    """Manifest lines with blank ones between them, read back and counted as valid."""
    path = tables.new_path(v.spark, "lines")
    lines = v.labelled.select(F.concat_ws("-", "call_id", "idx").alias("audio"), "text", F.round("duration", 3).alias("duration"))
    lines.select(F.explode(F.array(F.to_json(F.struct("audio", "text", "duration")), F.lit(""), F.lit("  "))).alias("value")).write.text(path)
    back = documents.read_lines(v.spark, path)
    return back.withColumn("checked", F.lit(dataset.checked(back)).cast("bigint"))


@query("x13_utc_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS stamp FROM events")
def _(v: Views) -> DataFrame:
    return v.events.select("event_id", text.utc_iso(F.col("ts").cast("timestamp")).alias("stamp"))


@query("q1_catalog_tables", "SELECT 'calls' AS name, count(*) AS rows, CAST(8 AS INT) AS columns FROM {calls} UNION ALL SELECT 'turns', count(*), 7 FROM {judged} UNION ALL SELECT 'turn_issues', count(issue) + count(audio_issue), 3 FROM {judged} UNION ALL SELECT 'reject_reasons', count(*) FILTER (file_issue <> '') + count(*) FILTER (confidence < 0.6), 2 FROM {responses}")
def _(v: Views) -> DataFrame:
    """Rows of the catalog's tables and the number of columns that its printed schema gives them."""
    made, schema = _catalog(v), dict(line.rstrip(")").split("(", 1) for line in catalog.schema_text().splitlines())
    return failures.gathered(*[df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows", F.lit(len(schema[name].split(", "))).alias("columns")) for name, df in made.items()])
