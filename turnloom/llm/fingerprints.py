"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Each distinct five-word shingle is hashed once; its top bits name a bin and the least value of each bin is kept.  An empty bin copies the
first non-empty bin of its own fixed random order, so each copies a uniformly chosen one.  Only ``BITS`` low bits of each bin are stored,
and likeness corrects for the ``2**-BITS`` of bins that agree by chance.

Defined results: a null text is an empty text; a text without words has the fingerprint ``""``, like only another such text; fewer than
five words count as one shingle; rows that repeat a doc_id follow each other in order of a hash of their texts; rows without doc_id come after
all others, in the same order; the only document of a table is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import kernel
from turnloom.llm.layout import range_buckets
from turnloom.llm.storage import partitions

BINS = 512
BITS = 4
WORDS = 5
_EMPTY = np.uint64(2**64 - 1)
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_LEFT = np.uint64(BINS.bit_length() - 1)
_ORDER = np.random.Generator(np.random.PCG64(7)).random((BINS, BINS)).argsort(axis=1).astype(np.int32)
_RANK = _ORDER.argsort(axis=1).astype(np.int32)


def densify(table: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row that has a non-empty one."""
    out, full = table.copy(), table != _EMPTY
    count = full.sum(axis=1)
    for r in np.flatnonzero((count > 0) & (count <= 48)):
        have = np.flatnonzero(full[r])
        lack = np.flatnonzero(~full[r])
        out[r, lack] = table[r, have[_RANK[lack][:, have].argmin(axis=1)]]
    r, b = np.nonzero(~full & (count > 48)[:, None])
    for k in range(BINS):
        if not len(r):
            break
        j = _ORDER[b, k]
        hit = full[r, j]
        out[r[hit], b[hit]] = table[r[hit], j[hit]]
        r, b = r[~hit], b[~hit]
    return out


def fingerprint(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Return the low bits (rows x BINS, uint8) of each text's bins, and whether it has any word."""
    data, offsets = kernel.text_buffers(column)
    words, first = kernel.word_hashes(data, offsets, lower=True)
    grams, at = kernel.shingles(words, first, WORDS)
    n = len(offsets) - 1
    table = np.full(n * BINS, _EMPTY, dtype=np.uint64)
    row = np.repeat(np.arange(n), np.diff(at))
    np.minimum.at(table, row * BINS + (grams >> _SHIFT).astype(np.int64), grams << _LEFT)
    dense = densify(table.reshape(n, BINS))
    return ((dense >> _LEFT) & np.uint64(2**BITS - 1)).astype(np.uint8), np.diff(at) > 0


def packed(low: np.ndarray, some: np.ndarray) -> list[str]:
    """Return fingerprints as hex strings, two bins a byte."""
    body = (low[:, ::2] << BITS) | low[:, 1::2]
    return [x.tobytes().hex() if s else "" for x, s in zip(body, some, strict=True)]


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Return the bias-corrected similarity of fingerprints, row by row."""
    chance = 2.0**-BITS
    raw = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_some & b_some, raw, (a_some == b_some).astype(float))


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """rows: (doc_id, text, bucket, late) in order; each row that is not late is compared with the one behind it."""
    texts = [r[1] for r in rows]
    own = [i for i in range(len(rows) - 1) if not rows[i][3]]
    edited = []
    for i in own:
        cut = len(texts[i]) // 3
        edited.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
    low, some = fingerprint(pa.array(texts, pa.large_string()))
    e_low, e_some = fingerprint(pa.array(edited, pa.large_string()))
    at = np.array(own, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][0] for i in own], pa.int64()),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
            pa.array(packed(low[at], some[at]), pa.string()),
            pa.array(packed(e_low, e_some), pa.string()),
            pa.array(likeness(low[at], some[at], e_low, e_some)),
            pa.array(likeness(low[at], some[at], low[at + 1], some[at + 1])),
        ],
        names=[x.split()[0] for x in SCHEMA.split(", ")],
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text", "bucket", "late")), strict=True):
            held.append(row)
            size += len(row[1])
            if len(held) >= 1500 or size >= 4_000_000:
                yield _compare(held)
                held, size = held[-1:], len(held[-1][1])
    if len(held) > 1:
        yield _compare(held)


def next_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, text, bucket and late, laid out so that within a partition each document stands before its next one.

    Ids are cut into ranges by quantiles; each range is a bucket that lies in one partition, sorted by descending id.  The top document of
    a bucket is also the next one of the lowest document above, so it is sent there as well, marked late: one extra text a bucket.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows without doc_id lie below all ids, spread by their texts; if there are none, ranges are cut without a look at the texts
    ids_only = keyed.where("doc_id IS NULL").isEmpty()
    keyed = keyed.withColumn("tie", F.lit(0).cast("bigint") if ids_only else F.xxhash64("text"))
    binned = range_buckets(keyed.withColumn("key", F.coalesce(F.col("doc_id").cast("double"), F.col("tie").cast("double") - 2e19)))
    tops = sorted((r.bucket, tuple(r.top)) for r in binned.groupBy("bucket").agg(F.max(F.struct("key", "doc_id", "tie")).alias("top")).collect())  # one row a bucket
    above = [(*top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    extra = F.broadcast(spark.createDataFrame(above, "top_key double, top_id bigint, top_tie bigint, above int"))  # as many rows as buckets
    own = F.struct("bucket", F.lit(0).alias("late"))
    both = F.array(own, F.struct(F.col("above").alias("bucket"), F.lit(1).alias("late")))
    sent = binned.join(extra, (F.col("key") == F.col("top_key")) & (F.col("tie") == F.col("top_tie")) & F.col("doc_id").eqNullSafe(F.col("top_id")), "left")
    laid = sent.select("doc_id", "key", "tie", "text", F.explode(F.when(F.col("above").isNull(), F.array(own)).otherwise(both)).alias("to")).select("doc_id", "key", "tie", "text", "to.bucket", "to.late")
    order = ["bucket", "late", F.col("key").desc(), F.col("doc_id").desc(), F.xxhash64("text").desc(), F.col("text").desc()]
    return laid.repartition(partitions(spark), "bucket").sortWithinPartitions(*order).drop("key", "tie")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text, and compare them and the next document."""
    return next_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).mapInArrow(_neighbours, SCHEMA)


def l2_edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of every document and its edited text: length and hash."""
    return op2_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n, length(text) // 3 AS cut, coalesce(lead(text) OVER (ORDER BY doc_id DESC), (SELECT arg_max(text, doc_id) FROM t)) AS after FROM t)
SELECT doc_id, n::BIGINT AS n_chars, sha256(substr(text, 1, n - cut) || substr(after, 1, cut)) AS edited_sha256 FROM n
"""
