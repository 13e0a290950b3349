"""Context-mixing coder for token ids.

A segment codes many blocks at once, one numpy lane a block; blocks share only the segment's header (the ids that occur and the model) and are
checksummed one by one, so a damaged block costs no other.  The ``ALPHABET`` most frequent ids of a segment are symbols; any other id, of 32
bits, is the escape symbol and stands plainly behind its block's words.  So what a coder holds is bounded by ``LANES`` times ``BLOCK`` and by
``ALPHABET``, whatever the vocabulary.

Three predictions are mixed for every id: order 2, the id that most often follows the last two (by their hash); order 1, the one that most
often follows the last one where order 2 is wrong; and order 0, the distribution of the ids that neither tells.  The first two have a weight
for each context: how often in the segment its prediction is right.  All of them are learned from the whole segment before it is coded and
stand in its header, so blocks start with a full model and coding is a few array operations a step, in whole numbers.  Symbols are coded by
asymmetric numeral systems (rANS) with 64 bits of state and 32-bit words, from the last to the first, and decoded forwards.

Segment: magic, sizes, CRC-32 of what follows up to the bodies; compressed header; for each block its number of ids, the CRC-32 of its ids and
the sizes of its words and of its escaped ids; then the blocks' bodies.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import zstandard

BLOCK = 2048
#: blocks that are coded side by side; a larger segment is worked through in groups
LANES = 2048
#: symbols of a segment, the escape among them
ALPHABET = 1 << 14
MAGIC = b"TLS4"
_HEAD = struct.Struct("<4sIIIIIII")  # magic, ids, block, blocks, bytes of the header, symbols, whether the last one escapes, CRC-32
_SYMBOL = 14
#: bits of the hash of two symbols, of the weights, of the order-0 shares, and of both of these
_HASH, _WBITS, _SBITS = 18, 12, 16
_BITS = _WBITS + _SBITS
_ONE = 1 << _WBITS
#: the most that a prediction can weigh, and how often it must be right to stand in the header
_MOST, _LEAST = _ONE - 128, (4, 6)
#: a state is at least this; a word is 32 bits
_LOW = 1 << 31
#: ids below this are counted in an array
_DENSE = 1 << 22
#: steps whose intervals are worked out together
_STRIDE = 64


def _hash(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    return (p2 * 40503 + p1 * 30011 ^ p2 >> 5) & ((1 << _HASH) - 1)


def _best(context: np.ndarray, symbols: np.ndarray, size: int, least: int) -> np.ndarray:
    """Return for each context ``symbol << 12 | weight`` of its most frequent symbol; the weight is 0 where that is rare."""
    keys = np.sort((context.astype(np.uint32) << np.uint32(_SYMBOL)) | symbols.astype(np.uint32))
    out = np.zeros(size, dtype=np.int32)
    if not len(keys):
        return out
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    runs, own = np.diff(np.append(edge, len(keys))), keys[edge]
    of = (own >> np.uint32(_SYMBOL)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    total = np.add.reduceat(runs, first)
    top = np.maximum.reduceat(runs << _SYMBOL | (own & np.uint32((1 << _SYMBOL) - 1)).astype(np.int64), first)
    right, symbol = top >> _SYMBOL, top & ((1 << _SYMBOL) - 1)
    weight = np.minimum((right << _WBITS) // (total + 1), _MOST)
    fine = (right >= least) & (right * 16 >= total)
    out[of[first][fine]] = symbol[fine] << _WBITS | weight[fine]
    return out


class _Model:
    """The predictions of a segment: what follows one and two symbols, and the shares of the symbols that neither tells."""

    def __init__(self, one: np.ndarray, two: np.ndarray, share: np.ndarray):
        self.one, self.two, self.share = one, two, share
        self.below = np.cumsum(share, dtype=np.int32) - share
        self.symbol_at = np.repeat(np.arange(len(share), dtype=np.int32), share)

    @classmethod
    def learn(cls, symbols: np.ndarray, k: int) -> _Model:
        """``symbols`` in blocks of BLOCK; before a block stand two symbols 0."""
        p1, p2 = np.zeros_like(symbols), np.zeros_like(symbols)
        p1[1:], p2[2:] = symbols[:-1], symbols[:-2]
        p1[::BLOCK] = p2[::BLOCK] = p2[1::BLOCK] = 0
        context = _hash(p1, p2)
        two = _best(context, symbols, 1 << _HASH, _LEAST[1])
        got = two[context]
        rest = (got >> _WBITS != symbols) | (got & (_ONE - 1) == 0)
        symbols, p1 = symbols[rest], p1[rest]
        one = _best(p1, symbols, k, _LEAST[0])
        got = one[p1]
        count = np.bincount(symbols, minlength=k)
        # a symbol that order 1 tells may still need its share, where order 2 tells the same and so hides it
        known = np.bincount(symbols[(got >> _WBITS == symbols) & (got & (_ONE - 1) > 0)], minlength=k)
        left = np.where(count > 0, np.maximum(count - known, 1), 0)
        share = np.where(left > 0, 1 + left * ((1 << _SBITS) - (left > 0).sum()) // max(left.sum(), 1), 0)
        share[np.argmax(share)] += (1 << _SBITS) - share.sum()
        return cls(one, two, share.astype(np.int32))

    def pack(self) -> bytes:
        at = np.flatnonzero(self.two)
        parts = [self.share.astype("<i4"), self.one.astype("<i4"), np.diff(at, prepend=0).astype("<i4"), self.two[at].astype("<i4")]
        return b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in parts)

    @classmethod
    def unpack(cls, raw: bytes, k: int) -> _Model:
        n = len(raw) // 8 - k
        parts, at = [], 0
        for size in (k, k, n, n):
            parts.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size).T).reshape(-1).view("<i4"))
            at += 4 * size
        two = np.zeros(1 << _HASH, dtype=np.int32)
        two[np.cumsum(parts[2])] = parts[3]
        return cls(parts[1], two, parts[0])

    def predict(self, p1: np.ndarray, p2: np.ndarray) -> tuple[np.ndarray, ...]:
        """Return the symbols that orders 2 and 1 predict, where their parts end (order 2 first), and the weight of order 0."""
        e2, e1 = self.two.take(_hash(p1, p2)), self.one.take(p1)
        c2, c1, w2, w1 = e2 >> _WBITS, e1 >> _WBITS, e2 & (_ONE - 1), e1 & (_ONE - 1)
        w1 = (w1 * (_ONE - w2) >> _WBITS) * ((c1 != c2) | (w2 == 0))
        both = w2 + w1
        return c2, c1, w2 << _SBITS, both << _SBITS, _ONE - both

    def intervals(self, s: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Return start and size of the part of 2**28 that codes each symbol."""
        c2, c1, end2, end1, w0 = self.predict(p1, p2)
        right2, right1 = (s == c2) & (end2 > 0), (s == c1) & (end1 > end2)
        start = np.where(right2, 0, np.where(right1, end2, end1 + w0 * self.below.take(s)))
        return start, np.where(right2, end2, np.where(right1, end1 - end2, w0 * self.share.take(s)))


def _active(lengths: np.ndarray, longest: int) -> list[int]:
    return np.searchsorted(-lengths, -np.arange(longest), side="left").tolist()


def _encode_lanes(symbols: np.ndarray, lengths: np.ndarray, model: _Model) -> list[bytes]:
    """Code each row of ``symbols``; rows are in order of falling lengths."""
    lanes, longest = symbols.shape
    columns = np.zeros((longest + 2, lanes), dtype=np.int32)
    columns[2:] = symbols.T
    state, out, pos = np.full(lanes, _LOW, dtype=np.uint64), np.zeros((lanes, longest + 1), dtype=np.uint32), np.zeros(lanes, dtype=np.int64)
    active = _active(lengths, longest)
    room, word, bits = np.uint64(63 - _BITS), np.uint64(32), np.uint64(_BITS)
    for a in range((longest - 1) // _STRIDE * _STRIDE, -1, -_STRIDE):
        z = min(a + _STRIDE, longest)
        starts, sizes = (x.astype(np.uint64) for x in model.intervals(columns[a + 2 : z + 2], columns[a + 1 : z + 1], columns[a:z]))
        limits = sizes << room
        for t in range(z - 1, a - 1, -1):
            m = active[t]
            x, size = state[:m], sizes[t - a, :m]
            full = np.flatnonzero(x >= limits[t - a, :m])
            if len(full):
                own = x[full]
                out[full, pos[full]] = own.astype(np.uint32)
                pos[full] += 1
                x[full] = own >> word
            q = x // size
            x += starts[t - a, :m] - q * size
            x += q << bits
    return [state[i : i + 1].astype("<u8").tobytes() + out[i, : pos[i]][::-1].astype("<u4").tobytes() for i in range(lanes)]


def _decode_lanes(words: list[bytes], lengths: np.ndarray, model: _Model) -> np.ndarray:
    lanes, longest = len(words), int(lengths[0]) if len(lengths) else 0
    body = np.zeros((lanes, max(map(len, words), default=0) // 4 + 3), dtype=np.uint64)
    for i, w in enumerate(words):
        body[i, : len(w) // 4] = np.frombuffer(w, dtype="<u4")
    state = (body[:, 0] | body[:, 1] << np.uint64(32)).view(np.int64)
    flat, width = body.reshape(-1).view(np.int64), body.shape[1]
    pos, last = np.arange(lanes) * width + 2, np.arange(lanes) * width + width - 1
    out = np.zeros((longest + 2, lanes), dtype=np.int32)
    mask, top = (1 << _BITS) - 1, (1 << _SBITS) - 1
    for t, m in enumerate(_active(lengths, longest)):
        c2, c1, end2, end1, w0 = model.predict(out[t + 1, :m], out[t, :m])
        x = state[:m]
        slot = (x & mask).astype(np.int32)
        past = slot - end1
        # below 2**28, a quotient in double precision is never rounded up to a whole number
        s = model.symbol_at.take(np.minimum(np.maximum((past / w0).astype(np.int32), 0), top))
        low, size = past - w0 * model.below.take(s), w0 * model.share.take(s)
        told = np.flatnonzero(past < 0)
        if len(told):
            e2, here = end2[told], slot[told]
            by2 = here < e2
            s[told] = np.where(by2, c2[told], c1[told])
            low[told] = np.where(by2, here, here - e2)
            size[told] = np.where(by2, e2, end1[told] - e2)
        out[t + 2, :m] = s
        x >>= _BITS
        x *= size
        x += low
        short = np.flatnonzero(x < _LOW)
        if len(short):
            at = pos[short]
            x[short] = x[short] << 32 | flat.take(np.minimum(at, last[short]))
            pos[short] = at + 1
    return np.ascontiguousarray(out[2:].T)


def encode_segment(ids: np.ndarray) -> bytes:
    """Code an array of ids (unsigned 32-bit)."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    n = len(ids)
    if n and ids.max() < _DENSE:
        every = np.bincount(ids)
        known = np.flatnonzero(every).astype("<u4")
        count, place = every[known], np.zeros(len(every), dtype=np.int32)
        place[known] = np.arange(len(known), dtype=np.int32)
        symbols = place[ids]
    else:
        known, symbols, count = np.unique(ids, return_inverse=True, return_counts=True)
    escapes = len(known) > ALPHABET
    if escapes:
        best = np.sort(np.argsort(-count, kind="stable")[: ALPHABET - 1])
        place = np.full(len(known), ALPHABET - 1, dtype=np.int32)
        place[best] = np.arange(ALPHABET - 1)
        symbols, known = place[symbols], known[best]
    symbols, k = symbols.astype(np.int32), max(len(known) + escapes, 1)
    model = _Model.learn(symbols, k)
    table = zstandard.ZstdCompressor(level=3).compress(np.diff(known, prepend=np.uint32(0)).astype("<u4").tobytes() + model.pack())
    heads, bodies = [], []
    for a in range(0, n, LANES * BLOCK):
        own = symbols[a : a + LANES * BLOCK]
        blocks = -(-len(own) // BLOCK)
        grid = np.zeros(blocks * BLOCK, dtype=np.int32)
        grid[: len(own)] = own
        lengths = np.full(blocks, BLOCK, dtype=np.int64)
        lengths[-1] = len(own) - (blocks - 1) * BLOCK
        for i, w in enumerate(_encode_lanes(grid.reshape(blocks, BLOCK)[:, : lengths[0]], lengths, model)):
            at = a + i * BLOCK
            part = ids[at : at + lengths[i]]
            plain = part[symbols[at : at + lengths[i]] == ALPHABET - 1].tobytes() if escapes else b""
            heads.append(struct.pack("<IIII", lengths[i], zlib.crc32(part.tobytes()), len(w), len(plain)))
            bodies += [w, plain]
    middle = table + b"".join(heads)
    return _HEAD.pack(MAGIC, n, BLOCK, len(heads), len(table), k, escapes, zlib.crc32(middle)) + middle + b"".join(bodies)


def decode_blocks(blob: bytes) -> list[np.ndarray | None]:
    """Return the ids of each block of a segment, or None for blocks that are damaged or missing; ValueError if the header is damaged."""
    if len(blob) < _HEAD.size or blob[:4] != MAGIC:
        raise ValueError("not a token segment")
    _, n, block, many, size, k, escapes, crc = _HEAD.unpack_from(blob)
    at = _HEAD.size + size + 16 * many
    if zlib.crc32(blob[_HEAD.size : at]) != crc or block != BLOCK or -(-n // block) != many:
        raise ValueError("the segment's header is damaged")
    table = zstandard.ZstdDecompressor().decompress(blob[_HEAD.size : _HEAD.size + size])
    if not n:
        return []
    known = np.append(np.cumsum(np.frombuffer(table, "<u4", k - escapes), dtype=np.uint32), np.zeros(escapes, np.uint32))
    model = _Model.unpack(table[4 * (k - escapes) :], k)
    heads = np.frombuffer(blob, "<u4", 4 * many, _HEAD.size + size).reshape(many, 4).astype(np.int64)
    ends = at + np.cumsum(heads[:, 2] + heads[:, 3])
    out: list[np.ndarray | None] = []
    for a in range(0, many, LANES):
        own = heads[a : a + LANES]
        starts = ends[a : a + LANES] - own[:, 2] - own[:, 3]
        grid = _decode_lanes([blob[i : i + j] if i + j <= len(blob) and not j % 4 else b"" for i, j in zip(starts.tolist(), own[:, 2].tolist(), strict=True)], own[:, 0], model)
        for i, (length, crc, words, plain) in enumerate(own.tolist()):
            row = grid[i, :length]
            part = known[row].astype("<u4")
            if plain:
                raw, place = blob[starts[i] + words : starts[i] + words + plain], np.flatnonzero(row == k - 1)
                if len(raw) == 4 * len(place):
                    part[place] = np.frombuffer(raw, "<u4")
            out.append(part if zlib.crc32(part.tobytes()) == crc else None)
    return out


def decode_segment(blob: bytes) -> np.ndarray:
    """Return the ids of a segment; ValueError with the numbers of the damaged blocks, whose neighbours ``decode_blocks`` still gives."""
    parts = decode_blocks(blob)
    if bad := [i for i, part in enumerate(parts) if part is None]:
        raise ValueError(f"damaged blocks: {', '.join(map(str, bad[:20]))}")
    return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")
