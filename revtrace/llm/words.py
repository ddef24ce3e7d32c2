"""Words and their hashes, straight from Arrow's UTF-8 buffers.

A word is a maximal run of bytes other than the six ASCII white-space bytes.
Hashes are 64-bit: a sum of random byte values times powers of an odd base,
modulo 2**64, mixed at the end. Everything is vectorised over the documents of
a batch; memory is a few arrays of the size of a piece of about ``PIECE`` bytes
(or of one document, if that is longer).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalising steps of splitmix64, on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table(seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


BYTES = _table(1)
#: The same with A-Z read as a-z.
FOLDED = BYTES.copy()
FOLDED[0x41:0x5B] = BYTES[0x61:0x7B]


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def cached_powers(base: np.uint64, n: int) -> np.ndarray:
    """powers(base, n), kept for the next call.

    Functions shipped by value bring new module globals with every task, so what
    is worth keeping is kept once per worker process, under a name of its own.
    """
    store = sys.modules.setdefault("_revtrace_powers", ModuleType("_revtrace_powers")).__dict__
    got = store.get(hex(base))
    if got is None or len(got) < n:
        got = powers(base, max(n, 1 << 16))
        if n <= 4 * PIECE:
            store[hex(base)] = got
    return got[:n]


@dataclass
class Piece:
    """Documents ``first`` up to ``last`` of a batch; all positions count from the piece's start."""

    first: int
    last: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # document -> byte, one more than documents


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a column of strings without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return offsets, data


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """Runs of documents of at most ``limit`` bytes, or one longer document."""
    offsets, data = buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield Piece(i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def spans(piece: Piece, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts, ends (byte positions) of all words, and for each document its first word (one more than documents).

    ``space`` tells which bytes part words.
    """
    data, offsets = piece.data, piece.offsets
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    solid = ~space[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(solid[1:], solid[:-1], out=edge[1:-1])
    edge[offsets] = True  # a word never crosses documents
    at = np.flatnonzero(edge)
    first = at[:-1]
    keep = solid[first]
    starts, ends = first[keep], at[1:][keep]
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``fold`` reads A-Z as a-z."""
    out = np.empty(len(starts), np.uint64)
    table = FOLDED if fold else BYTES
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        inv = cached_powers(inverse(_BASE), high - low)
        total = np.empty(high - low + 1, np.uint64)
        total[0] = 0
        np.cumsum(table[data[low:high]] * cached_powers(_BASE, high - low), out=total[1:])
        s = starts[i:j] - low
        out[i:j] = (total[ends[i:j] - low] - total[s]) * inv[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


_SHINGLE = np.uint64(0xD1342543DE82EF95)


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` values; empty if there are fewer."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = values[:n].copy()
    for k in range(1, width):
        out *= _SHINGLE
        out += values[k : k + n]
    return mix(out ^ np.uint64(width))


def shingle_sets(piece: Piece, width: int, fold: bool = True) -> Iterator[np.ndarray]:
    """Per document the sorted distinct hashes of its ``width``-word shingles.

    With fewer words the whole sequence counts as one shingle; without words the set is empty.
    """
    starts, ends, first = spans(piece)
    h = hashes(piece.data, starts, ends, fold)
    s = windows(h, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(s[a : b - width + 1])
        else:
            yield windows(h[a:b], b - a) if b > a else np.empty(0, np.uint64)
