"""Benchmark decontamination by latent semantic retrieval.

Passages are runs of 24 words (case and ASCII punctuation folded), a new one every 12 words, each a TF-IDF vector over hashed words.
Document frequencies count all passages of the corpus.  A randomised SVD gives the latent space: each task multiplies its passages with
the random test matrix and back, and the small products are summed in two levels; after one power iteration a Rayleigh-Ritz step yields the
basis, scaled to unit variance.  The basis is an index and is fitted on a documented sample: every document whose hash falls under
``fit_passages / passages`` (all of them in small corpora), together with about ``BLOCK_ITEMS`` items chosen by hash from the whole
benchmark (all of them in small ones).  Every passage of every document is then
projected and compared, in blocks, with all passages of the benchmark; those with a cosine of ``cosine`` or more are candidates.

An exact join of words follows, since the latent space loses part of the passages, more of them the larger the benchmark is.  An item of
n words of which t must be there shares at least k of its n - t + k rarest words with the words around a leak; all places with that many
are judged too.  So whatever the judge accepts at the start of any passage is found, verbatim, short or paraphrased.

A candidate is a leak if the longest common subsequence of the item and the words around the candidate covers ``common`` of the item,
and ``answer`` of the item's answer (its last third, or the answer column) is found there in order.  So paraphrases with changed words, cut
or added phrases are found; items with fewer than ``short`` words must be there completely.

The benchmark is read in blocks of ``BLOCK_ITEMS`` items.  ``BLOCKS`` of them at most are sent to the tasks at once, for one pass over all
texts, which never move; a larger benchmark takes several passes, with a written table between them.

Defined results: null and empty texts and items leak nothing; rows that repeat are judged alike; a null doc_id is kept as it is; an empty
corpus or benchmark gives no leaks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm import kernel
from turnloom.llm.storage import discard, ease, materialize, release

WIDTH, STRIDE, ITEM_STRIDE = 24, 12, 12
FEATURES = 1 << 13
RANK, OVERSAMPLE = 192, 16
SLICES = 8
#: passages of the bounded sample that one fitting task takes; each task sends one product of features x dimensions
FIT_PASSAGES = 50_000
BLOCK_ITEMS = 2000
BLOCKS = 4
#: words and items of the exact join that are held at once
HITS = 1 << 18
#: words whose rows of a product are held at once, and passages that are compared at once
ROWS_HELD, COMPARED = 1 << 14, 1024
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Return the word hashes of texts without case and ASCII punctuation, and the first word of each row."""
    data, offsets = kernel.text_buffers(column)
    return kernel.word_hashes(_PLAIN[data], offsets, lower=True)


def feature(words: np.ndarray) -> np.ndarray:
    """Return the hashed feature of each word."""
    return (words >> np.uint64(64 - 13)).astype(np.int64)


def steps(first: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut each row into steps of ``stride`` words; return their first words and, for each row, the index of its first step."""
    n = -(-np.diff(first) // stride)
    at = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(first[:-1], n) + (np.arange(at[-1]) - np.repeat(at[:-1], n)) * stride, at


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        _, offsets = kernel.text_buffers(texts)
        for i, j in kernel.blocks(offsets, 1 << 20):
            yield batch.slice(i, j - i), *words_of(texts.slice(i, j - i))


def _tree_sum(parts: DataFrame, dtype: str) -> np.ndarray:
    """Sum arrays of tasks, given as rows (part, slice, body), slice by slice in two levels; what is returned has a fixed size."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, dtype) for b in group.column("body").to_pylist())
        return pa.table({"part": pa.array([0], pa.int32()), "slice": group.column("slice").slice(0, 1), "body": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, slice int, body binary"
    level = max(1, int(parts.rdd.getNumPartitions() ** 0.5))
    first = parts.groupBy("slice", F.pmod("part", F.lit(level))).applyInArrow(add, schema)
    last = first.groupBy("slice").applyInArrow(add, schema)
    return np.concatenate([np.frombuffer(r.body, dtype) for r in sorted(last.collect(), key=lambda r: r.slice)] or [np.zeros(0, dtype)])


def _emit(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for k, body in enumerate(np.array_split(total.reshape(-1), SLICES)):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([body.tobytes()], pa.binary())], names=["part", "slice", "body"])


def frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Return in how many passages (without overlap) of all documents each feature occurs, and the number of passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, dtype=np.int64)
        for _, words, first in _parts(batches, "text"):
            start, _ = steps(first, WIDTH)
            passage = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(words))))
            once, _ = kernel.unique_counts((passage * FEATURES + feature(words)).astype(np.uint64))
            total[:-1] += np.bincount((once % np.uint64(FEATURES)).astype(np.int64), minlength=FEATURES)
            total[-1] += len(start)
        if total[-1]:
            yield from _emit(total)

    sums = _tree_sum(docs.select(F.col(text_col).alias("text")).mapInArrow(kernel.tidy(count), "part int, slice int, body binary"), "int64")
    return (sums[:-1], int(sums[-1])) if len(sums) else (np.zeros(FEATURES, np.int64), 0)


def _rows(words: np.ndarray, start: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the feature and the weight of each word; the weights of a passage have unit length."""
    f = feature(words)
    w = idf[f]
    size = np.diff(np.append(start, len(words)))
    norm = np.sqrt(np.maximum(np.add.reduceat(w * w, start), 1e-12)) if len(start) else np.zeros(0)
    return f, (w / np.repeat(norm, size)).astype(np.float32)


def _sums(f: np.ndarray, start: np.ndarray, matrix: np.ndarray, w: np.ndarray | None = None, rows: int = 512) -> np.ndarray:
    """Return, for each run of words that begins at ``start``, the (weighted) sum of its words' rows of ``matrix``.

    Word k of many runs is added at a time, so sums stay in the processor's cache.
    """
    out = np.zeros((len(start), matrix.shape[1]), dtype=np.float32)
    size = np.diff(np.append(start, len(f)))
    for i in range(0, len(start), rows):
        own, at, acc = size[i : i + rows], start[i : i + rows], out[i : i + rows]
        for k in range(int(own.max(initial=0))):
            some = slice(None) if own.min() > k else np.flatnonzero(own > k)
            word = at[some] + k
            acc[some] += matrix[f[word]] if w is None else matrix[f[word]] * w[word, None]
    return out


def _times(f: np.ndarray, w: np.ndarray, start: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Return passages x matrix."""
    return _sums(f, start, matrix, w)


def _back(f: np.ndarray, w: np.ndarray, start: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the features that occur and, for each, its row of passages' transpose x product."""
    passage = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(f))))
    order = np.argsort(f, kind="stable")
    sorted_f = f[order]
    edge = np.flatnonzero(np.concatenate([[True], sorted_f[1:] != sorted_f[:-1]]))
    return sorted_f[edge], np.add.reduceat(product[passage[order]] * w[order, None], edge, axis=0)


def _gram(parts: Iterator[tuple], idf: np.ndarray, matrix: np.ndarray, weight: float = 1.0) -> np.ndarray:
    total = np.zeros(matrix.shape, dtype=np.float64)
    for words, first in parts:
        start, _ = steps(first, WIDTH)
        if len(start):
            f, w = _rows(words, start, idf)
            step = max(1, ROWS_HELD // WIDTH)
            for i in range(0, len(start), step):  # a row for each word, so not for all words at once
                own = start[i : i + step]
                some = slice(own[0], start[i + step] if i + step < len(start) else len(f))
                at, rows = _back(f[some], w[some], own - own[0], _times(f[some], w[some], own - own[0], matrix))
                total[at] += rows * weight
    return total


class Index:
    """The latent space: inverse document frequencies and the scaled basis (features x rank)."""

    def __init__(self, idf: np.ndarray, basis: np.ndarray):
        self.idf, self.basis = idf, basis

    def project(self, words: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Return the sum of basis rows of each run of words that begins at ``start``."""
        return _sums(feature(words), start, self.basis)


def fit(docs: DataFrame, items: list[str], id_col: str, text_col: str, fit_passages: int = 200_000, seed: int = 5) -> Index:
    """Fit the latent space by a distributed randomised SVD with one power iteration."""
    df, passages = frequencies(docs, text_col)
    idf = np.log((1.0 + passages) / (1.0 + df)).astype(np.float32)
    share = min(1.0, fit_passages / max(passages, 1))
    chosen = materialize(docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select(F.col(text_col).alias("text")), "latent-sample")
    tasks = max(1, min(passages, fit_passages) // FIT_PASSAGES)
    bench = words_of(pa.array(items, pa.string()))
    many = max(1, len(steps(bench[1], WIDTH)[0]))
    weight = 0.5 * min(passages, fit_passages) / many

    def times_gram(matrix: np.ndarray) -> np.ndarray:
        m = matrix.astype(np.float32, copy=False)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _gram(((w, f) for _, w, f in _parts(batches, "text")), idf, m)
            if total.any():
                yield from _emit(total.astype(np.float32))

        sums = _tree_sum(chosen.coalesce(tasks).mapInArrow(kernel.tidy(run), "part int, slice int, body binary"), "float32")
        ease(docs.sparkSession)
        own = _gram(iter([bench]), idf, m, weight)
        if len(sums):
            own += sums.reshape(m.shape)
        return own

    q = np.random.Generator(np.random.PCG64(seed)).standard_normal((FEATURES, RANK + OVERSAMPLE)).astype(np.float32)
    for _ in range(2):
        q = times_gram(q)  # no name is left for what was multiplied
        q = np.linalg.qr(q)[0]
    small = q.T @ times_gram(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-values)[:RANK]
    sigma = np.sqrt(np.maximum(values[top], values[top[0]] * 1e-9 + 1e-12))
    basis = (q @ vectors[:, top]) / sigma
    return Index(idf, (basis * idf[:, None]).astype(np.float32))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Return the length of the longest common subsequence, by a whole number that has a bit for each word of ``a``.

    A bit is 0 where a row of the table of lengths steps up; a word of ``b`` moves every step to its first place in ``a`` since the step before.
    """
    masks: dict = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for x in b.tolist():
        if x in masks:
            up = row & masks[x]
            row = (row + up | row - up) & full
    return len(a) - row.bit_count()


def _distinct(row: np.ndarray, item: np.ndarray, word: np.ndarray, items: int, words: int) -> np.ndarray:
    """Return the distinct rows (row, item, word) in order."""
    key = np.sort((row * items + item) * words + word)  # rows x words are below 2**42: a block has 1 MB of text, or one row
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    rest, word = np.divmod(key, words)
    return np.stack([*np.divmod(rest, items), word], axis=1)


class Items:
    """Benchmark items of one block, ready to compare."""

    def __init__(self, ids: list[int], texts: list[str], answers: list[str | None], index: Index, common: float, short: int):
        words, first = words_of(pa.array(texts, pa.string()))
        given, at = words_of(pa.array(answers, pa.string()))
        self.index, self.ids = index, []
        self.words, self.answers, starts, owner = [], [], [], []
        for k in range(len(ids)):
            w = words[first[k] : first[k + 1]]
            if len(w):
                own = given[at[k] : at[k + 1]]
                n = len(self.ids)
                last = max(len(w) - WIDTH, 0)
                for s in sorted({*range(0, last + 1, ITEM_STRIDE), last}):
                    starts.append((n, s))
                    owner.append(n)
                self.ids.append(ids[k])
                self.words.append(w)
                self.answers.append(own if len(own) else w[-max(1, len(w) // 3) :])
        self.owner = np.array(owner, dtype=np.int64)
        self._rarest(common, short)
        self._members()
        if starts:
            pieces = [self.words[n][s : s + WIDTH] for n, s in starts]
            begin = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
            self.vectors = np.ascontiguousarray(_unit(index.project(np.concatenate(pieces), begin)).T)

    def _rarest(self, common: float, short: int) -> None:
        """Index, by word, the items that have it among their rarest, and how many of these each item must share with a leak."""
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.shared = np.ones(len(self.words), dtype=np.int64)
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for n, w in enumerate(self.words):
            least = len(w) if len(w) < short else max(1, int(np.ceil(common * len(w) - 1e-6)))
            self.shared[n] = min(least, 2) if len(w) < short else -(-least // 3)
            rare = np.argsort(-self.index.idf[feature(w)], kind="stable")[: len(w) - least + self.shared[n]]
            keys.append(w[rare])
            owners.append(np.full(len(rare), n))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.rare, begin = np.unique(keys[order], return_index=True)
        self.rare_at, self.rare_items = np.append(begin, len(keys)), owners[order]
        self.may = np.zeros(1 << 20, dtype=bool)
        self.may[(self.rare >> np.uint64(44)).astype(np.int64)] = True

    def _members(self) -> None:
        """Index which words each item has, and how often: sorted keys (item, word), told apart by a table of bits first."""
        self.all_words = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        owner = np.repeat(np.arange(len(self.words)), self.sizes)
        word = np.searchsorted(self.all_words, np.concatenate([np.zeros(0, np.uint64), *self.words]))
        self.member, self.times = np.unique(owner * max(len(self.all_words), 1) + word, return_counts=True)
        self.may_be = np.zeros(1 << 20, dtype=bool)
        self.may_be[(self.all_words >> np.uint64(44)).astype(np.int64)] = True

    def _covered(self, own: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Return how many words of each item occur in words low .. high, where ``own`` has the item words of the text (-1: none)."""
        size = high - low
        cand = np.repeat(np.arange(len(item)), size)
        word = own[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
        some = np.flatnonzero(word >= 0)
        key = item[cand[some]] * len(self.all_words) + word[some]
        at = np.minimum(np.searchsorted(self.member, key), len(self.member) - 1)
        hit = self.member[at] == key
        once = np.unique(cand[some[hit]] * len(self.member) + at[hit])
        return np.bincount(once // len(self.member), self.times[once % len(self.member)], len(item))

    def _places(self, words: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        """Yield rows (row, item, first word of a passage) wherever the words around the passage share enough of the item's rarest words."""
        x = np.flatnonzero(self.may[(words >> np.uint64(44)).astype(np.int64)])
        key = np.searchsorted(self.rare, words[x])
        same = self.rare[np.minimum(key, len(self.rare) - 1)] == words[x]
        x, key = x[same], key[same]
        row = np.searchsorted(first, x, side="right") - 1
        many = np.diff(self.rare_at)[key]
        load = np.concatenate([[0], np.cumsum(many)])
        ends = np.searchsorted(row, np.arange(len(first) - 1), side="right")  # the words of rows up to each one
        i = 0
        while i < len(x):  # whole rows, of about HITS words and items at a time
            j = int(np.searchsorted(load, load[i] + HITS, side="right")) - 1
            j = int(ends[row[i]]) if j <= ends[row[i]] else int(ends[row[min(j, len(x) - 1)] - 1]) if j < len(x) else len(x)
            n_hits = many[i:j]
            word = np.repeat(x[i:j], n_hits)
            item = self.rare_items[np.repeat(self.rare_at[key[i:j]], n_hits) + np.arange(len(word)) - np.repeat(load[i:j] - load[i], n_hits)]
            order = np.argsort(item, kind="stable")
            word, item = word[order], item[order]
            last = np.arange(len(item)) + self.shared[item] - 1
            have = np.flatnonzero(last < len(item))
            have = have[item[last[have]] == item[have]]
            a, b, n = word[have], word[last[have]], item[have]
            own = np.searchsorted(first, a, side="right") - 1
            low = np.maximum(b - WIDTH - self.sizes[n] + 1, first[own])
            low = first[own] - (first[own] - low) // STRIDE * STRIDE  # the next start of a passage
            high = np.minimum(a + self.sizes[n], first[own + 1] - 1)
            ok = (b < first[own + 1]) & (low <= high)
            low, n, own, count = low[ok], n[ok], own[ok], (high[ok] - low[ok]) // STRIDE + 1
            at = np.repeat(low, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
            yield _distinct(np.repeat(own, count), np.repeat(n, count), at, len(self.ids), len(words))
            i = j

    def leaks(self, words: np.ndarray, first: np.ndarray, cosine: float, common: float, answer: float, short: int) -> dict[int, list[tuple]]:
        """Return, by row, its leaks (item_id, cosine, share of the item, share of the answer, first word, last word)."""
        start, at = steps(first, STRIDE)
        if not len(start) or not len(self.owner):
            return {}
        half = self.index.project(words, start)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        whole = half.copy()
        joins = np.flatnonzero(row[1:] == row[:-1])
        whole[joins] += half[joins + 1]
        whole = _unit(whole)
        own = np.full(len(words), -1, dtype=np.int64)
        x = np.flatnonzero(self.may_be[(words >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.all_words, words[x]), len(self.all_words) - 1)
        own[x] = np.where(self.all_words[k] == words[x], k, -1)
        found: dict[tuple[int, int], tuple] = {}

        def latent() -> Iterator[np.ndarray]:
            for i in range(0, len(start), COMPARED):
                near = whole[i : i + COMPARED] @ self.vectors
                high = np.flatnonzero(near.max(axis=1) >= cosine)
                p, v = np.nonzero(near[high] >= cosine)
                yield _distinct(row[i + high[p]], self.owner[v], start[i + high[p]], len(self.ids), len(words))

        for places in (*latent(), *self._places(words, first)):
            for i in range(0, len(places), 1 << 14):
                r, n, begin = places[i : i + (1 << 14)].T
                low, high = np.maximum(first[r], begin - self.sizes[n]), np.minimum(first[r + 1], begin + WIDTH + self.sizes[n])
                need = np.where(self.sizes[n] < short, 1.0, common) * self.sizes[n]
                for c in np.flatnonzero(self._covered(own, n, low, high) >= need - 1e-9).tolist():
                    got = self._judge(int(n[c]), words, int(low[c]), int(high[c]), common, answer, short)
                    have = found.get((int(r[c]), int(n[c])))
                    if got and (have is None or got[:2] > have[1:3]):
                        p = int(at[r[c]]) + int(begin[c] - first[r[c]]) // STRIDE
                        found[int(r[c]), int(n[c])] = (float((whole[p] @ self.vectors[:, self.owner == n[c]]).max()), *got, int(low[c] - first[r[c]]), int(high[c] - first[r[c]]))
        out: dict[int, list[tuple]] = {}
        for r, n in sorted(found):
            out.setdefault(r, []).append((self.ids[n], *found[r, n]))
        return out

    def _judge(self, n: int, words: np.ndarray, low: int, high: int, common: float, answer: float, short: int) -> tuple | None:
        """Return the shares of item and answer that the words low .. high hold in order, if they make a leak."""
        item, part = self.words[n], words[low:high]
        share = lcs(item, part) / len(item)
        if share < (1.0 if len(item) < short else common):
            return None
        kept = lcs(self.answers[n], part) / len(self.answers[n])
        return (share, kept) if kept >= answer else None


LEAK = "item_id bigint, cosine double, item_share double, answer_share double, first_word bigint, last_word bigint"


def with_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.55, common: float = 0.6, answer: float = 0.5, short: int = 8, fit_passages: int = 200_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", answer_col: str | None = None, name: str = "_leaks") -> DataFrame:
    """Return ``docs`` with the array column ``name``: the benchmark items that each document holds."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer")).where("text IS NOT NULL")
    total = items.count()
    blocks = max(1, -(-total // BLOCK_ITEMS))
    share = min(1.0, BLOCK_ITEMS / max(total, 1))
    sample = items.where(F.pmod(F.xxhash64(F.lit("fit"), F.col("id"), F.col("text")), F.lit(1 << 20)) < int(share * (1 << 20)))  # about BLOCK_ITEMS rows of all blocks
    index = fit(docs, [r.text for r in sample.collect()], id_col, text_col, fit_passages)
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != name], T.StructField(name, T.ArrayType(T._parse_datatype_string(LEAK)))])
    out = docs.drop(name).withColumn(name, F.array().cast(schema[name].dataType))
    written = None
    for k in range(0, blocks, BLOCKS):
        ready = []
        for b in range(k, min(k + BLOCKS, blocks)):
            block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_ITEMS rows
            ready.append(Items([r.id for r in block], [r.text for r in block], [r.answer for r in block], index, common, short))
        out = out.mapInArrow(kernel.tidy(_finder(ready, text_col, (cosine, common, answer, short))), schema)
        if k + BLOCKS < blocks:
            before, written = written, materialize(out, "leaks")
            out = written
            if before is not None:
                discard(before)
    release(docs.sparkSession)
    return out


def _finder(blocks: list[Items], text_col: str, limits: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [x.split()[0] for x in LEAK.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, first in _parts(batches, text_col):
            leaks: dict[int, list[tuple]] = {}
            for items in blocks:
                for r, found in items.leaks(words, first, *limits).items():
                    leaks.setdefault(r, []).extend(found)
            if leaks:
                last = part.num_columns - 1
                before = part.column(last).to_pylist()
                both = [[*old, *[dict(zip(names, x, strict=True)) for x in leaks.get(r, ())]] for r, old in enumerate(before)]
                part = part.set_column(last, part.schema.field(last), pa.array(both, part.schema.field(last).type))
            yield part

    return find


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Return one row for each document and the benchmark item that it holds."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, **options).where(F.size("_leaks") > 0)
    return found.select("doc_id", F.explode("_leaks").alias("leak")).select("doc_id", "leak.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find benchmark items in all documents."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
