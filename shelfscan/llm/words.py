"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of bytes other than the six white-space characters of
ASCII, which is the same as a run of characters. Words and runs of words are
known by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a block of its own.
BLOCK = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_RUN = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers, one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=_U))
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(n, _U(base))
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=_U))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class Words(NamedTuple):
    """Words of a block of texts: byte places, text number and hash; and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, offsets) of texts; nulls are empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def places_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text, first) of the words, as in :class:`Words`."""
    n = len(offsets) - 1
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, text, np.searchsorted(text, np.arange(n + 1))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    starts, ends, text, first = places_of(data, offsets)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((_LOWER if lower else _BYTES)[data] * up[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    return Words(data, starts, ends, text, hashes, first)


def runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, whole): of the run of ``length`` words from each word; whole where it ends in the same text."""
    n = len(words.hashes)
    out, whole = np.zeros(n, _U), np.zeros(n, bool)
    if n >= length:
        m = n - length + 1
        whole[:m] = words.text[:m] == words.text[length - 1 :]
        for k in range(length):
            out[:m] = out[:m] * _RUN + words.hashes[k : k + m]
    return mix(out + _U(length)), whole
