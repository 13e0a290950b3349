"""The structure of WAV files, read by ranges: whoever can give some bytes at a place can be asked, be it a file or bytes in memory."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Reader:
    """Bytes at a place, and how many there are."""

    read: Callable[[int, int], bytes]
    length: int


def in_memory(content: bytes) -> Reader:
    """A reader of bytes."""
    view = memoryview(content)
    return Reader(lambda at, n: bytes(view[at : at + n]), len(content))


def chunks(source: Reader) -> tuple[tuple, int, int]:
    """The format fields of a WAV, and where its samples begin and end; the heads of chunks and the format are all that is read."""
    head = source.read(0, 12)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form, body = 12, None, None
    while at + 8 <= source.length and (form is None or body is None):
        head = source.read(at, 8)
        name, size = head[:4], struct.unpack_from("<I", head, 4)[0]
        if name == b"fmt ":
            if size < 16 or at + 24 > source.length:
                raise ValueError("a WAV file with a broken header")
            form = struct.unpack("<HHIIHH", source.read(at + 8, 16))
        elif name == b"data":
            body = (at + 8, min(at + 8 + size, source.length))
        at += 8 + size + size % 2
    if form is None or body is None:
        raise ValueError("a WAV file without format or data")
    if not form[1] or not form[2] or form[1] * form[5] < 8:
        raise ValueError("a WAV file without channels, rate or sample size")
    return form, *body


def frames_of(source: Reader) -> tuple[int, int, int]:
    """Rate, channels and whole frames."""
    (_, channels, rate, _, _, bits), start, end = chunks(source)
    return rate, channels, max(0, end - start) // (channels * bits // 8)


def samples_of(body: bytes, kind: int, bits: int) -> np.ndarray:
    """Samples as float32 within -1 and 1; ValueError for sizes that are not known."""
    if kind == 3 and bits in (32, 64):
        return np.frombuffer(body, f"<f{bits // 8}").astype(np.float32)
    if bits == 8:
        return (np.frombuffer(body, np.uint8).astype(np.float32) - 128) / 128
    if bits == 16:
        return np.frombuffer(body, "<i2").astype(np.float32) / 32768
    if bits == 24:
        raw = np.frombuffer(body, np.uint8).reshape(-1, 3).astype(np.int32)
        return ((raw[:, 0] << 8 | raw[:, 1] << 16 | raw[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    if bits == 32:
        return (np.frombuffer(body, "<i4") / 2147483648.0).astype(np.float32)
    raise ValueError(f"{bits} bits a sample are not supported")


def blocks_of(source: Reader, frames: int = 1 << 15) -> Iterator[np.ndarray]:
    """Samples (frames x channels) block by block."""
    (kind, channels, _, _, _, bits), start, end = chunks(source)
    step = channels * bits // 8
    for at in range(start, start + (end - start) // step * step, frames * step):
        yield samples_of(source.read(at, min(frames * step, (end - at) // step * step)), kind, bits).reshape(-1, channels)
