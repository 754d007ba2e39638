"""Word shingles of many texts at once, as 64-bit hashes, with numpy over the text bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time (a longer text is handled alone).
SLICE = 600_000

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows with about most bytes of text; null counts as empty."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word in order, A-Z as a-z."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gap = _SEPARATOR[data]
    begins = np.empty(len(data), bool)
    begins[0] = True
    begins[1:] = gap[:-1]
    inner = offsets[1:-1]
    begins[inner[inner < len(data)]] = True
    begins &= ~gap
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(len(data)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    place[gap | (place < 0)] = 0
    value = _LOWER[data]
    value[gap] = 0
    longest = int(place.max()) + 1
    found = np.zeros(len(starts), np.uint64)
    for base in _BASES:
        powers = np.cumprod(np.full(longest, base, np.uint64))
        found = mix(found + np.add.reduceat(value * powers[place], starts))
    return found, np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of row i, sorted, are hashes[bounds[i]:bounds[i + 1]].

    A row with fewer words than width has its whole sequence as one shingle; one without words has none.
    """
    rows = len(offsets) - 1
    words, row = word_hashes(data, offsets)
    n = np.bincount(row, minlength=rows)
    ends = np.cumsum(n)
    size = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    of = np.repeat(np.arange(rows), size)
    place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(ends - n, size)
    left = np.repeat(ends, size) - place
    out = np.zeros(len(of), np.uint64)
    for k in range(width):
        there = left > k
        out[there] = mix(out[there] * np.uint64(0x9E3779B97F4A7C15) + words[place[there] + k] + np.uint64(k + 1))
    order = np.lexsort((out, of))
    out, of = out[order], of[order]
    if len(out):
        fresh = np.empty(len(out), bool)
        fresh[0] = True
        fresh[1:] = (out[1:] != out[:-1]) | (of[1:] != of[:-1])
        out, of = out[fresh], of[fresh]
    return out, np.concatenate(([0], np.cumsum(np.bincount(of, minlength=rows))))
