"""Whole-column text work on Arrow buffers: words, shingles and hashes without a Python loop over words.

A text column is seen as one byte array and the offsets of its rows. Nulls count as empty texts. Words are
runs of bytes other than the six ASCII blanks, the same words that ``[^\\x20\\x09-\\x0D]+`` finds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_MULTIPLIER = np.uint64(6364136223846793005)


def column_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, budget: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``budget`` bytes each; a longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + budget, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _places(n: int) -> np.ndarray:
    """Odd multipliers for the places of a word, extended on demand."""
    global _PLACE
    if n > len(_PLACE):
        grown = np.empty(max(n, 2 * len(_PLACE)), np.uint64)
        grown[:64] = _PLACE[:64]
        with np.errstate(over="ignore"):
            grown[64:] = np.multiply.accumulate(np.full(len(grown) - 64, _MULTIPLIER, np.uint64)) | np.uint64(1)
        _PLACE = grown
    return _PLACE


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the index of its first word (with one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~BLANK[data]
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(solid[:-1], out=first[1:])
    inner = offsets[1:-1]
    first[inner[inner < len(data)]] = True
    starts = np.flatnonzero(first & solid)
    stop = np.empty(len(data), bool)
    stop[-1] = True
    np.logical_not(solid[1:], out=stop[:-1])
    edge = inner[inner > 0] - 1
    stop[edge] = True
    ends = np.flatnonzero(stop & solid) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
    letters = data[place + np.repeat(starts, lengths)]
    with np.errstate(over="ignore"):
        value = _BYTE_VALUE[letters] * _places(int(lengths.max()))[place]
        return mix(np.add.reduceat(value, heads) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words inside each row, and each row's first shingle (one more at the end).

    A row with fewer words, but at least one, has one shingle made of all its words.
    """
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(n)])
    total = int(at[-1])
    start = np.arange(total, dtype=np.int64) - np.repeat(at[:-1], n) + np.repeat(first[:-1], n)
    last = np.repeat(first[1:], n)
    out = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            index = start + k
            there = index < last
            value = words[np.where(there, index, 0)] if len(words) else np.zeros(total, np.uint64)
            out += np.where(there, value, np.uint64(0)) * _PLACE[k]
        return mix(out), at


def text_shingles(column: pa.Array, width: int = 5, budget: int = 1 << 20
                  ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Shingle hashes by slices of the rows: first row, row after the last, hashes, row offsets."""
    data, offsets = column_buffer(column)
    for a, b in slices(offsets, budget):
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        starts, ends, first = word_bounds(part, at)
        hashes, rows = shingle_hashes(word_hashes(part, starts, ends), first, width)
        yield a, b, hashes, rows
