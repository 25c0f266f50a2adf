"""Words of Arrow string columns as numpy arrays: positions and 64-bit hashes, without a Python object per word.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. White space is ASCII, so UTF-8 bytes can be scanned as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = U64(0xD1342543DE82EF95)
#: Bytes of text handled at once; arrays of 8 bytes per byte of text stay in cache.
CHUNK = 1 << 20
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=U64))
        if size > 8 * CHUNK:  # a giant text must not leave its tables behind
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


@dataclass
class Words:
    """Words of some texts in a row: text d has words offsets[d] to offsets[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def hashes(self) -> np.ndarray:
        up, down = _power(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * up[: len(self.data)], out=sums[1:])
        return mix64((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(U64) * _STEP)

    def text_of(self) -> np.ndarray:
        """Of each word, the index of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """offsets: where each text starts in data, and where the last one ends."""
    if not len(data):
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    solid = np.ones(len(data) + 2, bool)
    np.logical_not(SPACE[data], out=solid[1:-1])
    solid[0] = solid[-1] = False
    inside = solid[1:-1]
    first, last = inside & ~solid[:-2], inside & ~solid[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of rows with about limit bytes together; a longer text comes alone."""
    data, offsets = buffers(column)
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each run of size words; a text with fewer words, but any, has all of them as its only run."""
    h, n = words.hashes(), np.diff(words.offsets)
    owner = words.text_of()
    if len(h) >= size:
        run = h[: len(h) - size + 1].copy()
        for k in range(1, size):
            run = run * _STEP + h[k : len(h) - size + 1 + k]
        whole = words.offsets[1:][owner[: len(run)]] - np.arange(len(run)) >= size
        run, of = mix64(run[whole]), owner[: len(whole)][whole]
    else:
        run, of = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        extra = np.array([_fold(h[words.offsets[d] : words.offsets[d + 1]]) for d in short], U64)
        run, of = np.concatenate([run, extra]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        run, of = run[order], of[order]
    return run, of


def _fold(h: np.ndarray) -> int:
    out = len(h)
    for x in h.tolist():
        out = (out * int(_STEP) + x) & 0xFFFFFFFFFFFFFFFF
    return out
