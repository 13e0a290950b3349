"""Vectorised word and shingle hashing over Arrow text columns.

Every function works on whole batches with numpy; there is no Python loop over words.  Words are maximal runs of bytes outside
0x20 and 0x09-0x0D, which in UTF-8 is the same as the pattern ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**64 - 1, 256, dtype=U64)
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_WORD_BASE = U64(0xD1342543DE82EF95)
_INVERSE = U64(pow(int(_BASE), -1, 2**64))
_WORD_INVERSE = U64(pow(int(_WORD_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give_back(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, with its freed memory given back at the end of a task; workers live on, and what each kept would add up from stage to stage."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


def powers(base: np.uint64, n: int) -> np.ndarray:
    """Return base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 21:
            _POWERS[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values with a bijection, in place where possible."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Return the bytes of a string column and the n+1 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def blocks(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Yield row ranges that hold about ``size`` bytes each; a longer row is a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return the start and end byte of each word and, for each row, the index of its first word (n+1 values)."""
    starts, ends = [], []
    for i, j in blocks(offsets):
        a, b = offsets[i], offsets[j]
        s, e = _spans(data[a:b], offsets[i : j + 1] - a)
        starts.append(s + a)
        ends.append(e + a)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return s, e, np.searchsorted(s, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Return a 64-bit hash of each word, and for each row the index of its first word (n+1 values)."""
    hashes, counts = [], [np.zeros(1, np.int64)]
    for i, j in blocks(offsets):
        a, b = offsets[i], offsets[j]
        part, at = data[a:b], offsets[i : j + 1] - a
        start, end = _spans(part, at)
        if lower:
            part = _LOWER[part]
        acc = np.empty(len(part) + 1, dtype=U64)
        acc[0] = 0
        p = powers(_BASE, len(part) + 1)
        np.multiply(_BYTE[part], p[: len(part)], out=acc[1:])
        np.cumsum(acc, out=acc)
        h = acc[end] - acc[start]
        h *= powers(_INVERSE, len(part) + 1)[start]
        h ^= (end - start).astype(U64) << U64(48)
        hashes.append(mix(h))
        counts.append(np.searchsorted(start, at[1:]) + sum(len(x) for x in hashes[:-1]))
    return (np.concatenate(hashes) if hashes else np.zeros(0, U64)), np.concatenate(counts)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Return the hash of words[i:i+n] for each i with a whole window, row boundaries not regarded."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = np.empty(len(words) - n + 1, dtype=U64)
    step = 1 << 19
    for a in range(0, len(out), step):
        b = min(len(out), a + step)
        seg = words[a : b + n - 1]
        acc = np.empty(len(seg) + 1, dtype=U64)
        acc[0] = 0
        np.multiply(seg, powers(_WORD_BASE, len(seg)), out=acc[1:])
        np.cumsum(acc, out=acc)
        h = acc[n:] - acc[:-n]
        h *= powers(_WORD_INVERSE, len(h))
        out[a:b] = mix(h + U64(n))
    return out


def windows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Return the positions of all n-word windows that lie in one row, and for each row the index of its first one (n+1 values)."""
    size = np.diff(first)
    count = np.maximum(size - n + 1, 0)
    at = np.concatenate([[0], np.cumsum(count)])
    pos = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], count)
    return pos, at


def shingles(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Return the n-word shingle hashes of each row and the index of each row's first one.

    A row with fewer than n words, but at least one, has its whole sequence as one shingle; a row without words has none.
    """
    pos, at = windows(first, n)
    grams = gram_hashes(words, n)
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size < n))
    if not len(short):
        return grams[pos], at
    count = np.diff(at)
    count[short] = 1
    to = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(to[-1], dtype=U64)
    whole = np.ones(len(out), dtype=bool)
    whole[to[short]] = False
    out[whole] = grams[pos]
    for k in range(1, n):
        rows = short[size[short] == k]
        if len(rows):
            h = np.full(len(rows), k, dtype=U64)
            for i in range(k):
                h = h * _WORD_BASE + words[first[rows] + i]
            out[to[rows]] = mix(h)
    return out, to


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return each row's sorted distinct values and the index of each row's first one."""
    out = values.copy()
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        out[i:j].sort()
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = out[1:] != out[:-1]
    keep[at[:-1][at[:-1] < len(out)]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def unique_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the sorted distinct values and how often each occurs."""
    v = np.sort(values)
    edge = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
    return v[edge], np.diff(np.append(edge, len(v)))
