"""Questions and answers between blocks of text and a table of hashed keys that is spread over the cluster.

A *chunk* is a block of whole documents, compressed.  Each chunk asks about the distinct keys (n-grams, windows) that it holds; questions
go to buckets by key, a bucket merges the values of all chunks key by key, and each chunk gets its answers in the order of its sorted keys.
A key occurs at most once a chunk, so frequent keys do not pile up, and a bucket holds a bounded number of keys: there is one bucket for
each ``BUCKET_BYTES`` of text, and at least one for each of the session's shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm import kernel
from turnloom.llm.storage import materialize, partitions

NO_ID = np.int64(2**63 - 1)
CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 32 << 20
FOLDS = 16
_Z = zstandard.ZstdCompressor(level=1)
_Z3 = zstandard.ZstdCompressor(level=3)


def squeeze(x: np.ndarray) -> bytes:
    """Compress an array of whole numbers, byte plane by byte plane."""
    return _Z.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())


def unsqueeze(blob: bytes, dtype: type) -> np.ndarray:
    """Undo ``squeeze``."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Compress sorted 64-bit keys by their differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(blob: bytes) -> np.ndarray:
    """Undo ``squeeze_sorted``."""
    return np.cumsum(unsqueeze(blob, np.uint64), dtype=np.uint64)


class Chunk:
    """Documents of one block: ids (NO_ID where ``nulls``), UTF-8 bytes and n+1 offsets."""

    def __init__(self, payload: bytes, number: int, fold: int):
        self.number, self.fold = number, fold
        raw = zstandard.ZstdDecompressor().decompress(payload)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        self.ids = np.frombuffer(raw, np.int64, n, 8)
        self.offsets = np.frombuffer(raw, np.int64, n + 1, 8 + 8 * n)
        self.nulls = np.frombuffer(raw, np.bool_, n, 16 + 16 * n)
        self.data = np.frombuffer(raw, np.uint8, -1, 16 + 17 * n)

    def id_column(self) -> pa.Array:
        """The ids with their nulls."""
        return pa.array(self.ids, pa.int64(), mask=self.nulls)

    @staticmethod
    def pack(ids: np.ndarray, nulls: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> bytes:
        """Return the payload of a block."""
        return _Z3.compress(b"".join((np.int64(len(ids)).tobytes(), ids.tobytes(), offsets.astype(np.int64).tobytes(), nulls.tobytes(), data.tobytes())))


def chunks(docs: DataFrame, name: str, id_col: str, text_col: str, fold: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Write and return the table of chunks (chunk, fold, size, payload).

    ``fold(ids, nulls)`` deals documents into separate chunks; the fold is also the chunk's number modulo FOLDS.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
            folds = np.zeros(len(ids), np.int64) if fold is None else fold(ids, nulls)
            for f in np.unique(folds):
                rows = np.flatnonzero(folds == f)
                column = batch.column(1) if len(rows) == len(ids) else batch.column(1).take(pa.array(rows))
                data, offsets = kernel.text_buffers(column)
                for i, j in kernel.blocks(offsets, CHUNK_BYTES):
                    a, b = offsets[i], offsets[j]
                    payload = Chunk.pack(ids[rows[i:j]], nulls[rows[i:j]], data[a:b], offsets[i : j + 1] - a)
                    values = [pa.array([number + int(f)], pa.int64()), pa.array([int(f)], pa.int32()), pa.array([int(b - a)], pa.int64()), pa.array([payload], pa.binary())]
                    yield pa.RecordBatch.from_arrays(values, names=["chunk", "fold", "size", "payload"])
                    number += FOLDS

    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return materialize(slim.mapInArrow(pack, "chunk bigint, fold int, size bigint, payload binary"), name)


def bucket_count(table: DataFrame) -> int:
    """Return the number of buckets for the questions of a table of chunks."""
    return max(partitions(table.sparkSession), -(-(table.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES))


def buckets_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Return the n+1 borders of the buckets in sorted keys; a bucket is a range of keys."""
    borders = np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


QUESTIONS = "bucket int, chunk bigint, keys binary, vals array<binary>"
#: (kind of key, sorted distinct keys, one value array each)
Asked = list[tuple[int, np.ndarray, list[np.ndarray]]]


def question_rows(number: int, asked: Asked, n: int) -> pa.Table:
    """Return the questions of one chunk, a row for each kind of key and bucket."""
    rows = []
    for kind, keys, values in asked:
        at = buckets_of(keys, n)
        for b in np.flatnonzero(at[:-1] < at[1:]).tolist():
            i, j = at[b], at[b + 1]
            rows.append((kind * n + b, number, squeeze_sorted(keys[i:j]), [squeeze(v[i:j]) for v in values]))
    types = _arrow_schema(QUESTIONS)
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], t.type) for k, t in enumerate(types)], schema=types)


def ask_all(table: DataFrame, n: int, ask: Callable[[Chunk], Asked]) -> DataFrame:
    """Return the questions of all chunks to ``n`` buckets."""

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, fold, payload in zip(*(batch.column(c).to_pylist() for c in ("chunk", "fold", "payload")), strict=True):
                yield from question_rows(number, ask(Chunk(payload, number, fold)), n).to_batches()

    return table.mapInArrow(questions, QUESTIONS)


Merge = Callable[[int, int, np.ndarray, list[np.ndarray]], tuple[list[np.ndarray], dict[str, float]]]


def exchange(asked: DataFrame, n: int, name: str, merge: Merge, dtype: type, answers: tuple[type, ...], totals: tuple[str, ...] = (), told: Callable[[int], int] | None = None) -> DataFrame:
    """Return the answers as a written table (chunk, kind, bucket, answer, and a double for each of ``totals``).

    ``merge(kind, n, index, values)`` sees all questions to one bucket: the number of its distinct keys, each question's key as an index
    into them, and the value arrays.  It returns the answer arrays by distinct key and the bucket's totals, which the rows with chunk -1
    carry.  A chunk gets the first ``told(chunk)`` answers, all by default.
    """
    names = ["chunk", "kind", "bucket", "answer", *totals]

    def answer(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        kind = bucket // n
        numbers = group.column("chunk").to_pylist()
        keys = [unsqueeze_sorted(x) for x in group.column("keys").to_pylist()]
        vals = [[unsqueeze(v, dtype) for v in x] for x in group.column("vals").to_pylist()]
        distinct = kernel.unique_counts(np.concatenate(keys))[0]
        index = np.concatenate([np.searchsorted(distinct, k) for k in keys])
        replies, sums = merge(kind, len(distinct), index, [np.concatenate([v[i] for v in vals]) for i in range(len(vals[0]))])
        at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        m = len(numbers)
        many = [len(answers) if told is None else told(x) for x in numbers]
        rows = [[squeeze(r[index[i:j]].astype(t)) for r, t in zip(replies[:k], answers[:k], strict=True)] for i, j, k in zip(at[:-1], at[1:], many, strict=True)]
        body = [pa.array([*numbers, -1], pa.int64()), pa.array([kind] * (m + 1), pa.int32()), pa.array([bucket] * (m + 1), pa.int32()), pa.array([*rows, None], pa.list_(pa.binary()))]
        return pa.Table.from_arrays([*body, *[pa.array([0.0] * m + [float(sums.get(t, 0))], pa.float64()) for t in totals]], names=names)

    schema = "chunk bigint, kind int, bucket int, answer array<binary>" + "".join(f", {t} double" for t in totals)
    return materialize(asked.groupBy("bucket").applyInArrow(answer, schema), name)


#: answers[i][kind]: what reply table i has for a chunk, in order of keys
Answers = list[dict[int, list[list[bytes]]]]


def answered(table: DataFrame, replies: list[DataFrame], work: Callable[[Chunk, Answers], pa.Table], schema: str) -> DataFrame:
    """Run ``work(chunk, answers)`` on each chunk with what it was answered."""
    spread = None
    for i, r in enumerate(replies):
        part = r.where("chunk >= 0").select("chunk", F.lit(i).alias("reply"), "kind", "bucket", "answer")
        spread = part if spread is None else spread.unionByName(part)
    n = len(replies)

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        got: Answers = [{} for _ in range(n)]
        for reply, kind, _, answer in sorted(zip(*(right.column(c).to_pylist() for c in ("reply", "kind", "bucket", "answer")), strict=True), key=lambda x: x[:3]):
            got[reply].setdefault(kind, []).append(answer)
        made = [work(Chunk(*x), got) for x in zip(*(left.column(c).to_pylist() for c in ("payload", "chunk", "fold")), strict=True)]
        return pa.concat_tables(made) if made else _arrow_schema(schema).empty_table()

    return table.groupBy("chunk").cogroup(spread.groupBy("chunk")).applyInArrow(joined, schema)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}


def _arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in schema.split(", ")])


def merged(blobs: list[list[bytes]], i: int, dtype: type) -> np.ndarray:
    """Return answer ``i`` for all keys of a chunk, from its blobs in order of buckets."""
    return np.concatenate([unsqueeze(b[i], dtype) for b in blobs]) if blobs else np.zeros(0, dtype)
