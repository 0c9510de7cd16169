"""Texts of an Arrow batch as byte arrays: words, spans and their hashes without a loop per word.

Hashes are polynomials modulo 2**64 over a random table of bytes, so the hash of any span comes
from two prefix sums. They depend on fixed seeds only and agree in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All ASCII but letters and digits.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def power_table(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Hashes of byte spans of ``data``; equal spans have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray, seed: int):
        table = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed * 0x1000 + 1))
        n = len(data)
        terms = table[data] * power_table(_FACTOR, n)[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = power_table(_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * back[starts]
                   + (ends - starts).astype(np.uint64))


def slices(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` text bytes; a longer text is a range of its own."""
    _, offsets = utf8(column)
    row, n = 0, len(column)
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, stop
        row = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts end to end, and where each begins and ends; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n, at = len(column), column.offset
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[at: at + n + 1]
    return (np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0])


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside``; no run crosses from text to text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[first] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text that each byte position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without the bytes ``gaps``) and the row of each."""
    starts, ends = edges(~gaps[data], offsets)
    return starts, ends, rows_of(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int, seed: int = 0):
    """Row and hash of every run of ``width`` lower-cased words, rows in order.

    A text with fewer words gives its whole sequence as one shingle; one without words none.
    """
    starts, ends, rows = words(data, offsets)
    n = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = SpanHash(LOWER[data], seed).of(starts, ends)
    per_row = np.bincount(rows, minlength=n)
    first = np.cumsum(per_row) - per_row
    # Words beyond the end of a row count as nothing, which only a short row's shingle reaches.
    hashes = np.zeros(len(word), np.uint64)
    place = np.arange(len(word)) - first[rows]
    for k in range(width):
        there = place + k < per_row[rows]
        step = np.zeros(len(word), np.uint64)
        step[: len(word) - k] = word[k:]
        hashes = mix(hashes * np.uint64(_FACTOR) + np.where(there, step, 0) + np.uint64(k + 1))
    keep = (place + width <= per_row[rows]) | ((place == 0) & (per_row[rows] < width))
    return rows[keep], hashes[keep]


def distinct_sorted(rows: np.ndarray, hashes: np.ndarray, n: int):
    """Per row its distinct hashes in rising order, as one array with row offsets."""
    hashes = hashes.copy()
    bounds = np.searchsorted(rows, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[fresh], np.concatenate([[0], np.cumsum(np.bincount(rows[fresh], minlength=n))])
