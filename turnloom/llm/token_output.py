"""Token-ID output: documents as token ids in compressed segments, and a reader for them.

Documents are laid out by ascending doc_id (a null doc_id last, ties by a hash of the text) in range partitions, whose numbers follow the
ids; each partition ("bucket") is written as segments of whole documents, coded by ``turnloom.llm.token_codec``.  A segment row is
self-contained: its documents, their lengths, the number of ids before it in its range, and the coded ids.  The table is written by Spark,
so a lost task is simply written again.

If a vocabulary's definition says that it removes white space and never looks across it (``splits_at_spaces``), the tokenizer sees each distinct
word of a block of texts once, since the ids of a text are then those of its words in order; a bounded cache keeps words that repeat.  If it also says how words become pieces
(``splits_into_pieces``), words of Latin letters and ASCII signs are cut here, all of a block at once, and each distinct piece goes to the library's
model once, since its normalisers and patterns take most of its time; a bounded cache keeps pieces.  Other words, and other vocabularies, get the
whole tokenizer.

Defined results: a null or empty text is the end id alone; rows that repeat are written as often as they occur; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import kernel
from turnloom.llm.storage import materialize, partitions
from turnloom.llm.token_codec import decode_segment, encode_segment

END_ID = 2
#: ids of a segment at least, and so what a coder holds (about 40 bytes an id)
SEGMENT_IDS = 1 << 21
CACHE_WORDS = 100_000
CACHE_PIECES = 200_000
#: bytes of texts whose distinct words are looked up together, and words that go to the model together
BLOCK_BYTES, STEP_WORDS = 4 << 20, 20_000
SEGMENTS = "bucket int, seq int, before bigint, n_ids bigint, doc_ids binary, no_ids binary, lengths binary, payload binary"
_TOKENIZERS: dict[str, tuple] = {}
_CACHE: dict[str, _Words] = {}
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: kinds of bytes: white space, letter, digit, other sign; and what stands in words that get the whole tokenizer
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KINDS = np.full(256, _ODD, dtype=np.uint8)
_KINDS[0x21:0x7F] = _SIGN
_KINDS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KINDS[0x30:0x3A] = _DIGIT
_KINDS[0x27] = _ODD  # contractions are for the tokenizer
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def default_tokenizer() -> str:
    """Return the place of the installed 49k-word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def definition_of(made: object) -> dict:
    """What a tokenizer's definition says about the text around its model, without its vocabulary, which is large."""
    part = lambda x: None if x is None else json.loads(x.__getstate__())
    added = [{"content": t.content, "lstrip": t.lstrip, "rstrip": t.rstrip} for t in made.get_added_tokens_decoder().values()]
    return {"normalizer": part(made.normalizer), "pre_tokenizer": part(made.pre_tokenizer), "post_processor": part(made.post_processor), "added_tokens": added}


def splits_at_spaces(definition: dict) -> bool:
    """Whether the ids of a text are those of its words between ASCII white space, as a tokenizer's definition states it.

    That holds if no normaliser moves anything across white space, if the first pre-tokenizer keeps only pieces without white space (it splits
    at it, or removes all that its pattern does not match and the pattern cannot match white space), if nothing is added around a text, and if
    no added token has white space in it or takes any along.
    """
    parts = lambda x, name: [] if x is None else [y for p in x[name] for y in parts(p, name)] if x["type"] == "Sequence" else [x]
    for step in parts(definition["normalizer"], "normalizers"):
        spaces = step["type"] == "Replace" and step["pattern"] in ({"Regex": "\\s+"}, {"Regex": "\\s"}) and step["content"] == " "
        if step["type"] not in ("NFC", "NFD", "NFKD", "NFKC", "Lowercase", "StripAccents", "BertNormalizer") and not spaces:
            return False
    first = (parts(definition["pre_tokenizer"], "pretokenizers") or [{"type": ""}])[0]
    # alternatives that hold no white space: letters, digits and marks of contractions, or classes that shut it out
    solid = re.compile(r"'\w+|\[?\\p\{[LN]\}\]?\+?|\[\^\\s[^\]]*\]\+?")
    removes = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and "Regex" in first["pattern"] and all(solid.fullmatch(x) for x in first["pattern"]["Regex"].split("|"))
    if not removes and first["type"] not in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return False
    plain = all(not (t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"])) for t in definition["added_tokens"])
    return plain and definition["post_processor"] is None


def splits_into_pieces(definition: dict) -> bool:
    """Whether words are lower-cased, cut by ``_PIECES`` and mapped byte by byte, and nothing else is done before the model."""
    normal = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    split = {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True}
    mapped = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    same = definition["normalizer"] == {"type": "Sequence", "normalizers": normal} and definition["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [split, mapped]}
    return same and splits_at_spaces(definition)


def _byte_map() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(shown))}


class _Words:
    """The ids of words and pieces; of two generations of at most half of CACHE_WORDS or CACHE_PIECES, the older is dropped when the younger is full."""

    def __init__(self, tokenizer: object, definition: dict):
        self.tokenizer, self.model = tokenizer, None
        # words with a character of an added token may hold that token
        self.marked = {c for t in definition["added_tokens"] for c in t["content"][:1]}
        if splits_into_pieces(definition) and tokenizer.model.end_of_word_suffix == "</w>" and not any(c.isalnum() for c in self.marked):
            from tokenizers import Tokenizer, pre_tokenizers

            # the same model without the steps before it
            self.model = Tokenizer(tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            vocabulary = tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
            self.kinds = _KINDS.copy()
            self.kinds[[ord(c) for c in self.marked if c.isascii()]] = _ODD
        self.young, self.old, self.pieces, self.older, self.bytes = {}, {}, {}, {}, _byte_map()

    def cut(self, missing: list[str]) -> list[bytes]:
        """Return the ids of pieces by the model; the last id of a piece, and no other, ends in the suffix."""
        mapped = [x if x.isascii() else x.encode().decode("latin-1").translate(self.bytes) for x in missing]
        ids = np.array(self.model.encode_batch_fast([" ".join(mapped)], add_special_tokens=False)[0].ids, dtype="<u4")
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(missing) or last[-1] != len(ids):
            raise ValueError("the vocabulary's pieces cannot be told apart")
        raw, at = ids.tobytes(), (4 * last).tolist()
        return [raw[i:j] for i, j in zip([0, *at[:-1]], at, strict=True)]

    def ids_of_pieces(self, names: list[str], odd: np.ndarray, often: np.ndarray) -> list[bytes]:
        """Return the ids of distinct pieces, and of the words among them that are ``odd``; those that occur ``often`` come into the cache."""
        got = list(map(self.pieces.get, names))
        for i in np.flatnonzero(odd).tolist():
            got[i] = b""
        missing = [i for i, ids in enumerate(got) if ids is None]
        if older := self.older:
            for i in missing:
                if (ids := older.get(names[i])) is not None:
                    got[i] = ids
                    self._keep_piece(names[i], ids)
            missing = [i for i in missing if got[i] is None]
        for a in range(0, len(missing), STEP_WORDS):
            some = missing[a : a + STEP_WORDS]
            for i, ids, keep in zip(some, self.cut([names[i] for i in some]), often[some].tolist(), strict=True):
                got[i] = ids
                if keep:
                    self._keep_piece(names[i], ids)
        whole = np.flatnonzero(odd).tolist()
        for i, ids in zip(whole, self.ids_of([names[i] for i in whole], often[whole].tolist()), strict=True):
            got[i] = ids
        return got

    def _keep_piece(self, piece: str, ids: bytes) -> None:
        if len(self.pieces) >= CACHE_PIECES // 2:
            self.pieces, self.older = {}, self.pieces
        self.pieces[piece] = ids

    def made(self, new: list[str]) -> list[bytes]:
        """Return the ids of words that are not in the cache, by the whole tokenizer."""
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]

    def ids_of(self, words: list[str], often: list[bool]) -> list[bytes]:
        """Return the ids of distinct words; those that occur ``often`` come into the cache."""
        young, old = self.young, self.old
        got = list(map(young.get, words))
        missing = []
        for i, ids in enumerate(got):
            if ids is None:
                if (ids := old.get(words[i])) is None:
                    missing.append(i)
                else:
                    got[i] = ids
                    self._keep(words[i], ids)
        for a in range(0, len(missing), STEP_WORDS):
            some = missing[a : a + STEP_WORDS]
            for i, ids in zip(some, self.made([words[i] for i in some]), strict=True):
                got[i] = ids
                if often[i]:
                    self._keep(words[i], ids)
        return got

    def _keep(self, word: str, ids: bytes) -> None:
        if len(self.young) >= CACHE_WORDS // 2:
            self.young, self.old = {}, self.young
        self.young[word] = ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Return the ids of all texts, one after the other, and the first one of each text (n+1 values); a word or piece is looked up once."""
        if self.model is not None:
            coded, odd, first = self._pieces(*kernel.text_buffers(texts))
        else:
            split = pc.ascii_split_whitespace(texts)
            coded, odd = split.flatten().dictionary_encode(), None
            first = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
        index, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        del coded
        often = np.bincount(index, minlength=len(names)) > 1
        own = self.ids_of(names, often.tolist()) if odd is None else self.ids_of_pieces(names, odd, often)
        del names
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        flat, begin, ends = np.frombuffer(b"".join(own), "<u4"), np.cumsum(sizes) - sizes, np.concatenate([[0], np.cumsum(sizes[index])])
        ids = np.empty(ends[-1], dtype="<u4")
        for i in range(0, len(index), 1 << 18):  # a place for each id, so not for all at once
            some = index[i : i + (1 << 18)]
            low, n = ends[i], sizes[some]
            place = np.repeat(begin[some] - (ends[i : i + len(some)] - low), n)
            place += np.arange(len(place))
            flat.take(place, out=ids[low : low + len(place)])
        return ids, ends[first]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
        """Cut texts into pieces by ``_PIECES``; return them, which distinct ones are words for the whole tokenizer, and the first of each text."""
        begin, end, first = kernel.word_spans(data, offsets)
        kind, low = self.kinds[data], _LOWER[data]
        lead = np.flatnonzero(data == 0xC3)  # letters from U+00C0 to U+00FF
        after = data[lead + 1]
        letter = (after != 0x97) & (after != 0xB7)
        kind[lead[letter]] = kind[lead[letter] + 1] = _LETTER
        low[lead[letter & (after < 0x9F)] + 1] += 0x20
        word_at = np.zeros(len(data), dtype=bool)
        word_at[begin] = True
        odd = np.unique(np.searchsorted(begin, np.flatnonzero(kind == _ODD), side="right") - 1)
        if len(odd):  # whole words as they are
            inside = np.zeros(len(data) + 1, dtype=np.int8)
            inside[begin[odd]] += 1
            inside[end[odd]] -= 1
            inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
            kind[inside] = _ODD
            np.copyto(low, data, where=inside)
        starts = kind == _DIGIT
        starts[1:] |= kind[1:] != kind[:-1]
        starts |= word_at
        starts &= kind != _SPACE
        unit = np.flatnonzero(starts)
        word = np.append(np.flatnonzero(word_at[unit]), len(unit))
        ends = np.append(unit[1:], len(data))[: len(unit)]
        ends[word[1:] - 1] = end
        at = np.zeros(len(unit) + 1, dtype=np.int32)
        np.cumsum(ends - unit, out=at[1:])
        coded = pa.StringArray.from_buffers(len(unit), pa.py_buffer(at), pa.py_buffer(low[kind != _SPACE])).dictionary_encode()
        whole = np.zeros(len(coded.dictionary), dtype=bool)
        whole[coded.indices.to_numpy()[kind[unit] == _ODD]] = True
        return coded, whole, word[first]


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Return the ids of whole texts, one after the other, without special tokens, and the first one of each text (n+1 values)."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        definition = definition_of(made)
        _TOKENIZERS[path], _CACHE[path] = (made, splits_at_spaces(definition)), _Words(made, definition)
    tokenizer, by_word = _TOKENIZERS[path]
    if by_word:
        return _CACHE[path].encode(texts)
    own = [np.array(tokenizer.encode_batch_fast([x], add_special_tokens=False)[0].ids, dtype="<u4") for x in texts.to_pylist()]
    return np.concatenate([np.zeros(0, "<u4"), *own]), np.concatenate([[0], np.cumsum([len(x) for x in own], dtype=np.int64)])


def encode_text(text: bytes, path: str) -> bytes:
    """Return the ids of a whole text as little-endian unsigned 32-bit integers, without special tokens."""
    return encode_texts(pa.array([text.decode()], pa.string()), path)[0].tobytes()


def _segments(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seq, before, keys, bodies, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(b) // 4 for b in bodies], dtype=np.int64)
            ids = np.frombuffer(b"".join(bodies), dtype="<u4")
            bodies.clear()
            nulls = np.array([k is None for k in keys])
            values = [bucket, seq, before, len(ids), np.array([k or 0 for k in keys], dtype=np.int64).tobytes(), nulls.tobytes(), lengths.tobytes(), encode_segment(ids)]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

        for batch in batches:
            texts = batch.column("text")
            for i, j in kernel.blocks(kernel.text_buffers(texts)[1], BLOCK_BYTES):
                ids, at = encode_texts(texts.slice(i, j - i), path)
                for key, a, z in zip(batch.column("key").slice(i, j - i).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    if size >= SEGMENT_IDS:
                        yield flush()
                        before, seq, keys, size = before + size, seq + 1, [], 0
                    keys.append(key)
                    bodies.append(ids[a:z].tobytes() + end)
                    size += len(bodies[-1]) // 4
        if keys:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents and write their segments to ``path`` (default: the shared folder); return a reader of the written table."""
    keyed = docs.select(F.col(id_col).cast("bigint").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows of one id, or without one, are told apart by their texts, and equal rows by their place, so none of them gather in one range
    order = [F.col("key").asc_nulls_last(), F.xxhash64("text"), F.col("place")]
    laid = keyed.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).drop("place")
    coded = laid.mapInArrow(kernel.tidy(_segments(tokenizer or default_tokenizer(), end_id)), SEGMENTS)
    if path is None:
        return materialize(coded, "token-segments")
    coded.write.parquet(path)
    return docs.sparkSession.read.schema(coded.schema).parquet(path)


def read_tokens(segments: DataFrame, digest: bool = False) -> DataFrame:
    """Return doc_id, start, n_tokens and the ids (or, with ``digest``, their CRC-32) of every written document."""
    spark = segments.sparkSession
    sums = sorted((r[0], r[1]) for r in segments.groupBy("bucket").agg(F.sum("n_ids")).collect())  # one row a bucket
    starts, at = [], 0
    for bucket, n in sums:
        starts.append((bucket, at))
        at += n
    begin = F.broadcast(spark.createDataFrame(starts, "bucket int, begin bigint"))  # as many rows as buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, keys, nulls, lengths, payload in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "no_ids", "lengths", "payload")), strict=True):
                ids, n = decode_segment(payload), np.frombuffer(lengths, np.int64)
                ends = np.cumsum(n)
                key = pa.array(np.frombuffer(keys, np.int64), pa.int64(), mask=np.frombuffer(nulls, np.bool_))
                parts = [ids[e - k : e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                last = pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()) if digest else pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([key, pa.array(start + ends - n, pa.int64()), pa.array(n, pa.int64()), last], names=["doc_id", "start", "n_tokens", name])

    name = "ids_crc32" if digest else "ids"
    located = segments.join(begin, "bucket").select((F.col("begin") + F.col("before")).alias("start"), "doc_ids", "no_ids", "lengths", "payload")
    return located.mapInArrow(kernel.tidy(run), f"doc_id bigint, start bigint, n_tokens bigint, {name} {'bigint' if digest else 'array<bigint>'}")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document as token ids and read the files back."""
    return read_tokens(write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet")), digest=True)
