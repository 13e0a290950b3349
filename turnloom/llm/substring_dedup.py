"""Substring dedup by seed and extend over winnowed anchors.

In each run of 50 words the least 20-word hash is the anchor (winnowing with a window of 31 hashes), so equal 50-word windows have equal
anchors at equal places.  First exchange: documents are joined on anchors, and anchors of one document only are dropped.  Second exchange:
each seed is extended word by word to both sides, over exactly the 50-word windows that own it, and every such window learns the smallest
document it starts in.  Windows that repeat from a smaller document are merged into maximal spans, which are removed.

The result is exact up to collisions of 64-bit hashes.  No pairs of documents are formed: a passage of k documents costs k rows.

Defined results: a null text has no words; fewer than 50 words cannot repeat; repeats inside one document stay; rows that share a doc_id
count as one document's and are judged alike; a null doc_id counts as larger than all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import kernel
from turnloom.llm.exchange import NO_ID, QUESTIONS, Answers, Asked, Chunk, answered, ask_all, bucket_count, chunks, exchange, merged, question_rows

LENGTH = 50
ANCHOR = 20
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Return, for each run of ``width`` hashes, the least one."""
    out = grams
    have = 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def _windows(chunk: Chunk, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Return word bounds per row, window positions, each window's anchor, and each window's row."""
    words, first = kernel.word_hashes(chunk.data, chunk.offsets, lower=False)
    pos, at = kernel.windows(first, length)
    if not len(pos):
        return words, first, pos, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = winnow(kernel.gram_hashes(words, anchor), length - anchor + 1)
    return words, first, pos, least[pos], np.repeat(np.arange(len(at) - 1), np.diff(at))


def _least_and_most(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k, d = keys[order], ids[order]
    edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    if not len(k):
        return k, d, d
    return k[edge], np.minimum.reduceat(d, edge), np.maximum.reduceat(d, edge)


def dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Return doc_id, n_words, n_removed, n_spans, kept_sha256 and (with ``keep_text``) the kept words of every document."""
    table = chunks(docs, "substring-chunks", id_col, text_col)
    n = bucket_count(table)

    def ask_anchors(chunk: Chunk) -> Asked:
        *_, least, row = _windows(chunk, length, anchor)
        change = np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])]) if len(least) else np.zeros(0, bool)
        keys, low, high = _least_and_most(least[change], chunk.ids[row[change]])
        return [(0, keys, [low, high])]

    def shared(_: int, n: int, index: np.ndarray, values: list[np.ndarray]) -> tuple[list[np.ndarray], dict]:
        low, high = np.full(n, NO_ID), np.full(n, -(2**63), dtype=np.int64)
        np.minimum.at(low, index, values[0])
        np.maximum.at(high, index, values[1])
        return [low != high], {}

    def smallest(_: int, n: int, index: np.ndarray, values: list[np.ndarray]) -> tuple[list[np.ndarray], dict]:
        low = np.full(n, NO_ID)
        np.minimum.at(low, index, values[0])
        return [low], {}

    def seeded(chunk: Chunk, blobs: list) -> tuple:
        words, first, pos, least, row = _windows(chunk, length, anchor)
        keys = kernel.unique_counts(least)[0]
        alive = merged(blobs, 0, np.uint8).astype(bool)[np.searchsorted(keys, least)] if len(keys) else np.zeros(0, bool)
        pos, row = pos[alive], row[alive]
        hashes = kernel.gram_hashes(words, length)[pos] if len(pos) else np.zeros(0, np.uint64)
        return first, pos, row, hashes

    def extend(chunk: Chunk, replies: Answers) -> pa.Table:
        _, _, row, hashes = seeded(chunk, replies[0].get(0, []))
        keys, low, _ = _least_and_most(hashes, chunk.ids[row])
        return question_rows(chunk.number, [(0, keys, [low])], n)

    def cut(chunk: Chunk, replies: Answers) -> pa.Table:
        first, pos, row, hashes = seeded(chunk, replies[0].get(0, []))
        keys = kernel.unique_counts(hashes)[0]
        low = merged(replies[1].get(0, []), 0, np.int64)
        hit = low[np.searchsorted(keys, hashes)] < chunk.ids[row] if len(keys) else np.zeros(0, bool)
        step = np.zeros(first[-1] + 1, dtype=np.int64)
        np.add.at(step, pos[hit], 1)
        np.add.at(step, pos[hit] + length, -1)
        return _kept(chunk, first, np.cumsum(step[:-1]) > 0, keep_text)

    seeds = exchange(ask_all(table, n, ask_anchors), n, "substring-seeds", shared, np.int64, (np.uint8,))
    asked = answered(table, [seeds], extend, QUESTIONS)
    lowest = exchange(asked, n, "substring-windows", smallest, np.int64, (np.int64,))
    return answered(table, [seeds, lowest], cut, SCHEMA)


def _kept(chunk: Chunk, first: np.ndarray, gone: np.ndarray, keep_text: bool) -> pa.Table:
    removed, spans, shas, texts = [], [], [], []
    body = chunk.data.tobytes()
    for i in range(len(chunk.ids)):
        words = body[chunk.offsets[i] : chunk.offsets[i + 1]].split()
        out = gone[first[i] : first[i + 1]]
        k = int(out.sum())
        spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()) if k else 0)
        kept = b" ".join([words[j] for j in np.flatnonzero(~out)] if k else words)
        removed.append(k)
        shas.append(hashlib.sha256(kept).hexdigest())
        texts.append(kept.decode() if keep_text else None)
    columns = [chunk.id_column(), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())]
    return pa.Table.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove 50-word passages that start in a smaller document from every document."""
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False).drop("kept")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
m AS (SELECT h, min(doc_id) AS low FROM p GROUP BY h),
g AS (SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS j FROM (SELECT p.doc_id, p.i FROM p JOIN m USING (h) WHERE m.low < p.doc_id)),
e AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
k AS (SELECT e.doc_id, e.j, e.word, g.j IS NOT NULL AS gone, before.j IS NULL AS first FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.j = e.j LEFT JOIN g before ON before.doc_id = e.doc_id AND before.j = e.j - 1),
a AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND first) AS n_spans, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(a.n_removed, 0)::BIGINT AS n_removed, coalesce(a.n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(a.kept, '')) AS kept_sha256 FROM w LEFT JOIN a USING (doc_id)
"""
