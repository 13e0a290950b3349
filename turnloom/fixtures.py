"""Calls, turns, words, judgements and clips derived from the given tables, once for Spark and once for DuckDB.

The given tables hold conversations, labels, documents, events and embeddings; these views give them the shape of curated calls, so that
every query grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("conversations", "documents", "labels", "events", "embeddings")

#: views whose text both engines read alike; names in braces are tables or views
COMMON = {
    "turns": """
      SELECT conv_id AS call_id, turn AS idx, CASE WHEN (turn*turn + conv_id) % 3 = 0 THEN 'spk_1' ELSE 'spk_0' END AS speaker,
        CAST(SUM(length(text)*60 + ((conv_id*7 + turn*13) % 11)*100) OVER (PARTITION BY conv_id ORDER BY turn) - length(text)*60 AS BIGINT) / CAST(1000 AS DOUBLE) AS start_s,
        CAST(SUM(length(text)*60 + ((conv_id*7 + turn*13) % 11)*100) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) / CAST(1000 AS DOUBLE) AS end_s, text
      FROM {conversations}""",
    "calls": """
      SELECT t.call_id, max(d.lang) AS language, CAST(count(DISTINCT t.speaker) AS INT) AS num_speakers
      FROM {turns} t JOIN {documents} d ON d.doc_id = t.call_id GROUP BY t.call_id""",
    "responses": """
      SELECT c.call_id, CAST(35 + 30*l.quality + (c.call_id % 30) AS DOUBLE)/100 AS confidence,
        CASE WHEN l.quality = 0 THEN 'nonsensical_conversation' ELSE '' END AS file_issue, l.toxic
      FROM {calls} c JOIN {labels} l ON l.doc_id = c.call_id""",
    "assignments": """
      SELECT call_id, idx AS a_index, n AS pos, CASE WHEN (idx+n) % 2 = 0 THEN 'spk_0' ELSE 'spk_1' END AS speaker,
        CASE WHEN (idx + call_id) % 3 = 0 THEN concat('N', CAST(idx AS STRING)) ELSE '' END AS name
      FROM {turns} CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 AS n) k WHERE idx % 5 <> 4 AND (n = 0 OR call_id % 10 = 0)""",
    "timeline": "SELECT call_id, idx AS ord, start_s + (end_s-start_s)/20 AS start_s, end_s - (end_s-start_s)/20 AS end_s, speaker FROM {turns}",
    "verdicts": """
      SELECT call_id, idx, concat(CAST(idx % 20 + 1 AS STRING), '. ', CASE WHEN length(text) % 5 = 0 THEN 'SENSITIVE' ELSE 'CLEAN' END) AS line
      FROM {turns} WHERE idx % 7 <> 6""",
    "checkpoints": "SELECT event_id * 7 AS step, value AS loss FROM {events}",
    "judged": """
      SELECT t.call_id, t.idx, t.speaker, t.start_s, t.end_s, t.text, CASE WHEN t.idx = 0 AND r.toxic = 1 THEN 'garbled_transcript' END AS issue,
        (t.call_id + t.idx) % 13 <> 0 AS has_audio, CASE WHEN (t.call_id*3 + t.idx) % 17 = 0 THEN 'low_energy' END AS audio_issue
      FROM {turns} t LEFT JOIN {responses} r ON r.call_id = t.call_id""",
    "labelled": """
      SELECT t.call_id, t.idx, t.speaker, t.end_s - t.start_s AS duration, t.text, CASE WHEN t.speaker = 'spk_0' THEN 'me' ELSE 'other' END AS speaker_label,
        c.language, (t.call_id + t.idx) % 13 <> 0 AS has_audio
      FROM {turns} t JOIN {calls} c ON c.call_id = t.call_id""",
    "vectors": "SELECT CAST(floor(vec_id/10) AS BIGINT) AS call_id, concat('spk_', CAST(vec_id % 2 AS STRING)) AS speaker, vec_id AS idx, label, embedding FROM {embeddings}",
}

SPARK = {
    "segments": """
      SELECT call_id, idx*1000 + k AS seg, speaker, start_s + (end_s-start_s)*k/n AS start_s, start_s + (end_s-start_s)*(k+1)/n AS end_s, x AS text
      FROM (SELECT *, size(split(text, '[.]')) AS n FROM {turns}) LATERAL VIEW posexplode(split(text, '[.]')) e AS k, x""",
    "words": """
      SELECT call_id, idx, k, x AS word, start_s + (end_s-start_s)*(k + CAST(0.5 AS DOUBLE))/n AS mid_s
      FROM (SELECT *, size(split(text, ' ')) AS n FROM {turns}) LATERAL VIEW posexplode(split(text, ' ')) e AS k, x""",
}
DUCK = {
    "segments": """
      SELECT call_id, idx*1000 + k AS seg, speaker, start_s + (end_s-start_s)*k/n AS start_s, start_s + (end_s-start_s)*(k+1)/n AS end_s, x AS text
      FROM (SELECT *, len(string_split(text, '.')) AS n, generate_subscripts(string_split(text, '.'), 1) - 1 AS k, unnest(string_split(text, '.')) AS x FROM {turns})""",
    "words": """
      SELECT call_id, idx, k, x AS word, start_s + (end_s-start_s)*(k + CAST(0.5 AS DOUBLE))/n AS mid_s
      FROM (SELECT *, len(string_split(text, ' ')) AS n, generate_subscripts(string_split(text, ' '), 1) - 1 AS k, unnest(string_split(text, ' ')) AS x FROM {turns})""",
    "samples": """
      SELECT vec_id AS clip_id, i - 1 AS i, CAST(embedding[i] AS DOUBLE) * power(CAST(10 AS DOUBLE), -((vec_id % 20) + (vec_id % 7)*CAST(2 AS DOUBLE)*(i - 1)/64)/20) AS v
      FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM {embeddings})""",
    "takes": """
      SELECT clip_id // 64 AS take_id, row_number() OVER (PARTITION BY clip_id // 64 ORDER BY clip_id, i) - 1 AS i, v * CASE WHEN clip_id % 64 < 4 OR clip_id % 64 >= 59 THEN 0.001 ELSE 1.0 END AS v FROM {samples}""",
}
BOTH = {
    "items": """
      SELECT call_id, idx*100000 + k AS ord, CASE WHEN k % 9 = 8 THEN 'punctuation' ELSE 'pronunciation' END AS kind, CASE WHEN k % 9 = 8 THEN '.' ELSE word END AS content,
        CASE WHEN k % 9 <> 8 THEN CAST(idx*100000 + k AS STRING) END AS start_time, CASE WHEN k % 9 <> 8 THEN CAST(idx*100000 + k + 1 AS STRING) END AS end_time
      FROM {words}""",
    "word_labels": """
      SELECT w.call_id, w.idx*100000 + w.k AS ord, CAST(w.idx*100000 + w.k AS STRING) AS start_time, CASE WHEN (w.k + n.n) % 11 < 6 THEN 'spk_0' ELSE 'spk_1' END AS speaker, n.n AS seg
      FROM {words} w CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 AS n) n WHERE w.k % 5 <> 3 AND w.k % 9 <> 8 AND (n.n = 0 OR w.k % 7 = 0)""",
}


class Views:
    """Lazy Spark views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in self._made:
            return self._made[name]
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name == "clips":
            gain = lambda i: F.pow(F.lit(10.0), -((F.col("vec_id") % 20) + (F.col("vec_id") % 7) * 2.0 * i / 64) / 20)
            df = self.embeddings.select(F.col("vec_id").alias("clip_id"), F.transform("embedding", lambda x, i: x.cast("double") * gain(i)).alias("samples"))
        elif name == "takes":  # recordings of 64 clips one after the other, quiet at both ends
            place = F.col("clip_id") % 64
            quiet = F.when((place < 4) | (place >= 59), 0.001).otherwise(1.0)
            each = self.clips.select(F.floor(F.col("clip_id") / 64).alias("take_id"), F.struct("clip_id", F.transform("samples", lambda x: x * quiet).alias("x")).alias("part"))
            df = each.groupBy("take_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["x"])).alias("samples"))
        else:
            text = (COMMON | SPARK | BOTH)[name]
            df = self.spark.sql(text, **{n: getattr(self, n) for n in names_in(text)})
        self._made[name] = df
        return df


def names_in(text: str) -> list[str]:
    """Names in braces, each once."""
    return list(dict.fromkeys(p.split("}")[0] for p in text.split("{")[1:]))


def duck(query: str) -> str:
    """A DuckDB query with the views that it names in braces."""
    texts = {k: v.replace("AS STRING", "AS VARCHAR") for k, v in (COMMON | DUCK | BOTH).items()}
    done: dict[str, str] = {}

    def need(text: str) -> str:
        for n in names_in(text):
            if n in texts and n not in done:
                body = need(texts[n])
                done[n] = body
            text = text.replace("{" + n + "}", n)
        return text

    body = need(query).strip()
    views = ", ".join(f"{n} AS ({t})" for n, t in done.items())
    if not views:
        return body
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(head):
            return f"{head}{views}, {body[len(head):]}"
    return f"WITH {views} {body}"
