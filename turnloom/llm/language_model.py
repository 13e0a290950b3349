"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of triples, pairs and words with a uniform share for unknown words.  The mixture weights depend
on how often the context occurs: a bucket for each power of two of the count of the two words before, or, where these never occur together,
of the one word before.  They are learned by expectation-maximisation: one part of the training documents is left out of the counts
(deleted), and the weights maximise its likelihood under the counts of the rest.  Scores then use the counts of all training documents.

Counts never come together in one place: blocks of text ask a hash-partitioned table for the counts of their n-grams
(``turnloom.llm.exchange``), so what is gathered grows with the corpus.  To the driver come four totals and, for the weights, a histogram of
held-out tokens over (context bucket, half octave of each estimate), whose size is bounded by that grid.  So the weights are those of
estimates rounded to half octaves; scores use exact ones.

Defined results: a null text is an empty text, which is its end token alone; a null doc_id counts as the text "null" for the fold and stays null; rows that
repeat are documents of their own; an empty table gives an empty result; with no training tokens every probability is that of an unknown word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import kernel
from turnloom.llm.exchange import FOLDS as CHUNK_FOLDS
from turnloom.llm.exchange import Answers, Asked, Chunk, answered, ask_all, bucket_count, chunks, exchange, merged
from turnloom.llm.storage import release

FOLDS = 7
HELD_OUT = 2
DELETED = 3
#: powers of two of a context's count
LEVELS = 40
STEP = 2
ORDER = 3
END = np.uint64(0x51ED270B9F5B3A17)
SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def folds(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """Return crc32(doc_id as text) mod 7 of each document."""
    return np.array([zlib.crc32(b"null" if no else str(i).encode()) % FOLDS for i, no in zip(ids.tolist(), nulls.tolist(), strict=True)], dtype=np.int64)


def _deal(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    return (folds(ids, nulls) == DELETED).astype(np.int64)


def _before(tokens: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Return the token ``k`` places before each one; ends stand before a text."""
    out = np.full(len(tokens), END, dtype=np.uint64)
    out[k:] = tokens[:-k]
    for i in range(k):
        at = first[:-1] + i
        at = at[at < first[1:]]
        out[at] = END
    return out


def _grams(chunk: Chunk, order: int = ORDER) -> tuple[list[np.ndarray], np.ndarray]:
    """Return the keys of the word, the pair and the triple (up to ``order`` words) that end at every token, and the first token of each row."""
    words, first = kernel.word_hashes(chunk.data, chunk.offsets, lower=True)
    tokens = np.insert(words, first[1:], END)
    first = first + np.arange(len(chunk.ids) + 1)
    keys = [tokens]
    for k in range(1, order):
        keys.append(kernel.mix(keys[-1] + kernel.mix(_before(tokens, first, k) ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0xD1342543DE82EF95 + 2 * k)))
    return keys, first


def _ask(kind: int) -> Callable[[Chunk], Asked]:
    """Ask for words, pairs or triples (kind 0 to 2), bringing the counts of a chunk's training documents."""

    def ask(chunk: Chunk) -> Asked:
        grams, first = _grams(chunk, kind + 1)
        train = np.repeat(folds(chunk.ids, chunk.nulls) != HELD_OUT, np.diff(first))
        order = np.argsort(grams[kind])
        keys = grams[kind][order]
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        count = np.add.reduceat(train[order].astype(np.uint32), edge).astype(np.uint32) if len(keys) else np.zeros(0, np.uint32)
        return [(0, keys[edge], [count, np.where(chunk.fold == 1, count, 0).astype(np.uint32)])]

    return ask


def _sum(_: int, n: int, index: np.ndarray, values: list[np.ndarray]) -> tuple[list[np.ndarray], dict]:
    whole = np.bincount(index, values[0], n)
    rest = whole - np.bincount(index, values[1], n)
    return [whole, rest], {"tokens": whole.sum(), "types": (whole > 0).sum(), "rest_tokens": rest.sum(), "rest_types": (rest > 0).sum()}


def _counts(chunk: Chunk, replies: Answers, which: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Return the counts of the word, pair and triple at every token: of all training documents (0) or without the deleted part (1)."""
    grams, first = _grams(chunk)
    out = []
    for kind, keys in enumerate(grams):
        at = np.searchsorted(kernel.unique_counts(keys)[0], keys)
        out.append(merged(replies[kind].get(0, []), which, np.uint32)[at].astype(np.float64))
    return out, first


def _context(count: np.ndarray, end: float, first: np.ndarray) -> np.ndarray:
    """Return the counts of the contexts from those of the n-grams that end one token before; a text begins after as many ends as there are texts."""
    out = np.concatenate([[end], count[:-1]]) if len(count) else count
    out[first[:-1]] = end
    return out


def _estimates(counts: list[np.ndarray], first: np.ndarray, tokens: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Return the context bucket of each token and its estimates by triple, pair and word.

    A context's count is that of its words as an n-gram; since every text ends with the end token, it is also how often the context occurs.
    """
    word, pair, triple = counts
    end = word[first[1:] - 1][0] if len(first) > 1 else 0.0
    one, two = _context(word, end, first), _context(pair, end, first)
    share = lambda n, c: np.divide(n, c, out=np.zeros_like(n), where=c > 0)
    bucket = np.where(two > 0, LEVELS + np.frexp(two)[1], np.frexp(one)[1])
    return bucket, [share(triple, two), share(pair, one), word / max(tokens, 1.0)]


def _octave(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(-np.log2(np.maximum(p, 1e-300)) * STEP), -1).astype(np.int64)


def learn(histogram: list[tuple], types: float, rounds: int = 100) -> np.ndarray:
    """Return the weights (bucket x triple, pair, word, uniform) by expectation-maximisation on held-out counts.

    histogram: (bucket, octave of each of the three estimates, -1 for none, tokens).  A bucket without held-out tokens takes the pooled
    weights.  Where a context never occurs, its estimate is zero and so is its weight.
    """
    rows = np.array(histogram, dtype=np.float64).reshape(-1, ORDER + 2)
    bucket = rows[:, 0].astype(np.int64)
    level = [np.where(rows[:, k] >= 0, 2.0 ** (-rows[:, k] / STEP), 0.0) for k in range(1, ORDER + 1)]
    p = np.stack([*level, np.full(len(rows), 1.0 / (types + 1.0))], axis=1)

    def run(b: np.ndarray, n: int) -> np.ndarray:
        w = np.full((n, ORDER + 1), 1 / (ORDER + 1))
        for _ in range(rounds):
            share = w[b] * p
            share *= (rows[:, -1] / share.sum(axis=1))[:, None]
            sums = np.stack([np.bincount(b, share[:, k], n) for k in range(ORDER + 1)], axis=1) + 1e-3
            w = sums / sums.sum(axis=1, keepdims=True)
        return w

    pooled = run(np.zeros(len(rows), np.int64), 1)[0]
    weights = run(bucket, 2 * LEVELS)
    weights[np.bincount(bucket, rows[:, -1], 2 * LEVELS) == 0] = pooled
    weights[:LEVELS, 0] = 0.0  # the two words before never occur together
    weights[0, 1] = 0.0  # nor does the word before
    return weights / weights.sum(axis=1, keepdims=True)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    table = chunks(docs, "lm-chunks", id_col, text_col, _deal)
    names = ("tokens", "types", "rest_tokens", "rest_types")
    n_buckets = bucket_count(table)
    replies = []
    for kind in range(ORDER):  # one after the other, so that only one kind's questions lie on disk
        # only chunks of the deleted part need the counts without it
        replies.append(exchange(ask_all(table, n_buckets, _ask(kind)), n_buckets, "lm-counts", _sum, np.uint32, (np.uint32, np.uint32), names, lambda chunk: 1 + chunk % CHUNK_FOLDS))
        release(docs.sparkSession)
    tokens, types, rest_tokens, rest_types = (float(x or 0) for x in replies[0].where("chunk < 0").agg(*[F.sum(n) for n in names]).first())

    def deleted(chunk: Chunk, answers: Answers) -> pa.Table:
        counts, first = _counts(chunk, answers, 1)
        bucket, estimates = _estimates(counts, first, rest_tokens)
        cell = bucket
        for p in estimates:
            cell = cell * 1024 + _octave(p) + 1
        keys, n = kernel.unique_counts(cell.astype(np.uint64))
        return pa.table({"cell": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    # a chunk's fold is in its number, so that the answers of the other chunks stay where they are
    own = [r.where(F.pmod("chunk", F.lit(CHUNK_FOLDS)) == 1) for r in replies]
    cells = answered(table.where("fold = 1"), own, deleted, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    release(docs.sparkSession)
    weights = learn([(c >> 30, *((c >> 10 * k & 1023) - 1 for k in (2, 1, 0)), n) for c, n in cells], rest_types)

    def judge(chunk: Chunk, answers: Answers) -> pa.Table:
        counts, first = _counts(chunk, answers, 0)
        bucket, estimates = _estimates(counts, first, tokens)
        w = weights[bucket]
        logs = np.log10(sum(w[:, k] * p for k, p in enumerate(estimates)) + w[:, -1] / (types + 1.0))
        base = np.log10((counts[0] + 1.0) / (tokens + types + 1.0))
        n = len(chunk.ids)

        def per_row(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, first[:-1]) if n else np.zeros(0)

        columns = [
            chunk.id_column(),
            pa.array(folds(chunk.ids, chunk.nulls) == HELD_OUT, pa.bool_()),
            pa.array(np.diff(first), pa.int64()),
            pa.array(per_row((counts[0] > 0).astype(np.int64)), pa.int64()),
            pa.array(np.full(n, int(tokens)), pa.int64()),
            pa.array(per_row(base)),
            pa.array(per_row(logs)),
        ]
        return pa.Table.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])

    return answered(table, replies, judge, SCHEMA)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by deleted interpolation, learning from all folds but one."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
