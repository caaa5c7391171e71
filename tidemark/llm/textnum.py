"""Texts as numpy arrays: word boundaries, 64-bit word hashes and shingle hashes for whole Arrow batches.

A word is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D``; A-Z is lower-cased.  A word's
hash is a polynomial in random 64-bit byte codes, mixed with its length, so equal words have equal
hashes on every executor and two of n different words collide with probability about n*n/2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_CODES = np.random.default_rng(0x7469646D).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODES[65:91] = _CODES[97:123]  # A-Z hash as a-z
_CODES[[0x20, *range(0x09, 0x0E)]] = 0  # white space adds nothing to the word before it
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20
#: A slice of rows has at most 2**ROW_BITS of them.
ROW_BITS = 15


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    grow = lambda x: np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64)), dtype=np.uint64)
    return grow(np.uint64(_BASE)), grow(np.uint64(pow(_BASE, -1, 1 << 64)))


_powers = _powers_to(1 << 12)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some consecutive rows: ``hashes[bounds[r]:bounds[r+1]]`` belong to row r."""

    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if array.null_count:
        array = array.fill_null("")
    if array.type != pa.large_string():
        array = array.cast(pa.large_string())
    _, off, data = array.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=len(array) + 1, offset=array.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hash_block(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word start offsets) of one block; ``cuts``: row starts inside the block."""
    global _powers
    n = len(data)
    solid = (data != 0x20) & ((data - np.uint8(9)) > 4)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[cuts] = solid[cuts]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), starts
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = cuts[cuts > 0] - 1
    last[inner] = solid[inner]
    length = np.flatnonzero(last) - starts + 1
    if n > len(_powers[0]):
        _powers = _powers_to(max(n, _BLOCK))
    total = np.add.reduceat(_CODES[data] * _powers[0][:n], starts) * _powers[1][starts]
    return mix64(total ^ (length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), starts


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Hash every word of rows given as one byte buffer with row offsets.

    Long buffers go block by block, each cut at white space, so memory does not follow the text.
    """
    n = len(data)
    hashes, starts, done = [], [], 0
    while done < n:
        stop = n
        if n - done > _BLOCK:
            reach = _BLOCK
            while done + reach < n:
                tail = data[done : done + reach]
                gaps = np.flatnonzero((tail == 0x20) | ((tail - np.uint8(9)) <= 4))
                if len(gaps):
                    reach = int(gaps[-1]) + 1
                    break
                reach *= 2
            stop = min(n, done + reach)
        lo, hi = np.searchsorted(offsets, [done, stop])
        h, at = _hash_block(data[done:stop], offsets[lo:hi] - done)
        hashes.append(h)
        starts.append(at + done)
        done = stop
    if not hashes:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    return Words(np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets).astype(np.int64))


def word_chunks(array: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[slice, Words]]:
    """Words of an Arrow string array in row slices of about ``limit`` bytes (one row at least)."""
    data, offsets = text_buffer(array)
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows, start + (1 << ROW_BITS))
        part = offsets[start : stop + 1]
        yield slice(start, stop), words_of(data[part[0] : part[-1]], part - part[0])
        start = stop


_SHIFT = np.random.default_rng(0x73686E67).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles_of(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the ``width``-word shingles of each row, repeats included.

    A row with words but fewer than ``width`` has one shingle made of all its words; a row
    without words has none.
    """
    counts = words.counts
    per_row = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int64)
    h = words.hashes
    total = int(bounds[-1])
    if total == 0:
        return np.zeros(0, np.uint64), bounds
    row = np.repeat(np.arange(len(counts)), per_row)
    at = np.arange(total, dtype=np.int64) - np.repeat(bounds[:-1], per_row) + words.bounds[:-1][row]
    size = np.minimum(counts[row], width)
    acc = size.astype(np.uint64)
    last = len(h) - 1
    short = bool((size < width).any())
    for k in range(width):
        part = mix64(h[np.minimum(at + k, last)] + _SHIFT[k])
        acc = acc * _SHIFT[15] + (np.where(size > k, part, np.uint64(0)) if short else part)
    return mix64(acc), bounds
