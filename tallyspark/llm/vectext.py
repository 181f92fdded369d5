"""Vectorised text primitives on Arrow string buffers (numpy inside Spark tasks).

An Arrow column of texts is one byte buffer with offsets. Word bounds, hashes of any span and
per-document sums come from a few passes over that buffer, with no Python loop over words.
Buffers are handled in blocks of whole documents of about ``BLOCK`` bytes, so a task's memory
does not follow the batch size; a longer document makes a block of its own, which ``parts`` can cut.

Span hashes: H[i] is the prefix sum of T[byte] * P**i modulo 2**64, T being a fixed random
table; (H[e] - H[s]) * P**-s depends on the bytes of [s, e) alone. ``mix`` spreads the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so each has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class _Powers:
    """P**i and P**-i for i < n, made once per worker; grown for longer blocks."""

    def __init__(self) -> None:
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def get(self, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if which not in self.kept or len(self.kept[which][0]) < n:
            size = max(BLOCK + 1, n)
            self.kept[which] = (_powers(_BASE[which], size), _powers(pow(_BASE[which], -1, 2**64), size))
        return self.kept[which]


_POWERS = _Powers()


class Spans:
    """Hashes of spans of one byte block."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        power, self.inverse = _POWERS.get(which, len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[which][data] * power[: len(data)], out=self.prefix[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) ^ (np.asarray(end - start).astype(np.uint64) << np.uint64(40)))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), off


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of blocks of whole documents."""
    data, off = buffer(texts)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def parts(data: np.ndarray, size: int = BLOCK) -> Iterator[np.ndarray]:
    """One long text in parts of about ``size`` bytes that end behind white space, so no word is cut (a
    longer word stays whole)."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data):
            found = np.flatnonzero(_SPACE[data[end : end + size]])
            if len(found):
                end += int(found[0]) + 1
                break
            end += size
        yield data[at : min(end, len(data))]
        at = min(end, len(data))
    if at < len(data):
        yield data[at:]


def bounds(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a document's border."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = off[:-1] < off[1:]
    at, end = off[:-1][filled], off[1:][filled] - 1
    first[at] = inside[at]
    last[end] = inside[end]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each document's words begin among them."""
    start, end = bounds(~_SPACE[data], off)
    return start, end, np.searchsorted(start, off)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of values[at[i]:at[i + 1]] for each i; 0 for an empty range."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def owners(at: np.ndarray) -> np.ndarray:
    """The index of the range that each item belongs to."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key, whether it occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out
