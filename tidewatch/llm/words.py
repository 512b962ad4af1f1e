"""Words of Arrow text columns as arrays of 64-bit hashes.

Works on the bytes of whole batches with numpy, so that the cost is some
nanoseconds a byte. Used inside tasks, on a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Text bytes handled at once; one text over this is handled alone, whole.
SLICE_BYTES = 1 << 21


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64."""
    out = np.ones(size, U64)
    done = 1
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * U64(pow(base, done, 1 << 64))
        done += more
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    content = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    if column.null_count:  # a null may still span bytes
        lengths = np.diff(bounds) * np.asarray(column.is_valid())
        if lengths.sum() != len(content):
            return text_bytes(column.fill_null(""))
    return content, bounds


def slices(bounds: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, or of one row."""
    start, rows = 0, len(bounds) - 1
    while start < rows:
        end = int(np.searchsorted(bounds, bounds[start] + most, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def word_hashes(content: np.ndarray, bounds: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and where each row's words start (rows + 1 values).

    ``lower`` folds A-Z. Equal words have equal hashes everywhere; others agree
    with probability 2**-64.
    """
    rows = len(bounds) - 1
    size = len(content)
    if not size:
        return np.zeros(0, U64), np.zeros(rows + 1, np.int64)
    word = ~_SEPARATOR[content]
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    heads = bounds[:-1][filled]
    starts[heads] = word[heads]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    tails = bounds[1:][filled] - 1
    ends[tails] = word[tails]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    room = 1 << max(16, (size - 1).bit_length())
    codes = _BYTE_CODES[_LOWER] if lower else _BYTE_CODES
    sums = np.zeros(size + 1, U64)
    np.cumsum(codes[content] * _powers(_BASE, room)[:size], out=sums[1:])
    hashes = splitmix((sums[last] - sums[first]) * _powers(_INVERSE, room)[first])
    return hashes, np.searchsorted(first, bounds)


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row; a shorter row with words is one run."""
    counts = np.diff(starts)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(runs)])
    if not len(words):
        return np.zeros(0, U64), begin
    at = np.repeat(starts[:-1], runs) + np.arange(begin[-1]) - np.repeat(begin[:-1], runs)
    short = np.repeat(np.minimum(counts, size), runs)
    out = np.zeros(len(at), U64)
    for k in range(size):
        here = words[np.minimum(at + k, len(words) - 1)]
        out = np.where(k < short, splitmix(out * U64(_BASE) + here + U64(k + 1)), out)
    return out, begin


class HashIndex:
    """Finds the place of 64-bit keys in an array; open addressing at half load or less.

    The keys are hashes already, so their low bits are the address.
    """

    def __init__(self, keys: np.ndarray):
        self.keys = keys if len(keys) else np.zeros(1, U64)
        size = 1 << max(4, (2 * len(keys)).bit_length())
        self.mask = U64(size - 1)
        self.slots = np.full(size, -1, np.int32)
        waiting = np.arange(len(keys), dtype=np.int32)
        at = (keys & self.mask).astype(np.int64)
        while len(waiting):
            free = self.slots[at] < 0
            self.slots[at[free]] = waiting[free]
            placed = self.slots[at] == waiting
            waiting, at = waiting[~placed], (at[~placed] + 1) & (size - 1)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted key, or -1."""
        at = (wanted & self.mask).astype(np.int64)
        found = self.slots[at]
        other = np.flatnonzero((found >= 0) & (self.keys[found] != wanted))
        while len(other):
            at[other] = (at[other] + 1) & int(self.mask)
            found[other] = self.slots[at[other]]
            other = other[(found[other] >= 0) & (self.keys[found[other]] != wanted[other])]
        return found
