"""Wu-Manber search for many word windows in the words of Arrow text columns.

Used inside tasks, on a few megabytes at a time. Symbols are words: every word
of the windows has a number, any other word of a text is ``NONE``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewatch.llm.words import U64, splitmix

NONE = -1
#: Positions searched by one cursor; long texts are shared among cursors.
LANE = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True  # every byte of a character beyond ASCII


def split_words(content: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.

    Returns them one after the other as byte strings, and where those of each
    row start (rows + 1 values).
    """
    word = _WORD[content]
    fresh = word.copy()
    fresh[1:] &= ~word[:-1]
    heads = bounds[:-1][bounds[1:] > bounds[:-1]]
    fresh[heads] = word[heads]
    first = np.flatnonzero(fresh)
    before = np.concatenate([[0], np.cumsum(word)])
    offsets = np.append(before[first], before[-1]).astype(np.int64)
    letters = _LOWER[content[word]]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    )
    return words, np.searchsorted(first, bounds)


def _hash(symbols: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of symbols."""
    out = np.zeros(len(symbols), U64)
    for column in symbols.T:
        out = splitmix(out * U64(0x9E3779B97F4A7C15) + column.astype(np.int64).view(U64) + U64(1))
    return out


class _Tables:
    """Shift table, suffix buckets and windows of one length.

    A cursor stands on the last word of a possible occurrence. The block of the
    last ``block`` words there tells how far the nearest place is at which some
    window may end; 0 means here. Blocks share the cells of the table by hash, a
    cell holds the smallest shift of its blocks.
    """

    def __init__(self, windows: np.ndarray, owners: np.ndarray):
        self.length = windows.shape[1]
        self.block = min(2, self.length)
        self.farthest = self.length - self.block + 1
        size = 1 << max(8, (4 * windows.size - 1).bit_length())
        self.mask = U64(size - 1)
        self.shift = np.full(size, self.farthest, np.int32)
        for end in range(self.block, self.length + 1):
            cells = self._cells(windows[:, end - self.block : end])
            np.minimum.at(self.shift, cells, self.length - end)
        suffix = self._cells(windows[:, self.length - self.block :])
        whole = _hash(windows)
        order = np.lexsort((whole, suffix))
        self.windows, self.owners, self.whole = windows[order], owners[order], whole[order]
        self.bucket = np.searchsorted(suffix[order], np.arange(size + 1))

    def _cells(self, symbols: np.ndarray) -> np.ndarray:
        return (_hash(symbols) & self.mask).astype(np.int64)

    def find(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, window) of every occurrence in the rows that begin at ``starts``."""
        first, last = starts[:-1] + self.length - 1, starts[1:]
        lanes = np.maximum(0, -(-(last - first) // LANE))
        begin = np.concatenate([[0], np.cumsum(lanes)])
        place = np.arange(begin[-1]) - np.repeat(begin[:-1], lanes)
        at = np.repeat(first, lanes) + place * LANE
        end = np.minimum(at + LANE, np.repeat(last, lanes))
        back = np.arange(self.block) - self.block + 1
        ends, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(at):
            blocks = symbols[at[:, None] + back]
            cells = self._cells(blocks)
            step = np.where((blocks == NONE).any(axis=1), self._after_unknown(blocks), self.shift[cells])
            here = np.flatnonzero(step == 0)
            if len(here):
                e, w = self._confirm(symbols, at[here], cells[here])
                ends.append(e)
                found.append(w)
            at = at + np.maximum(step, 1)
            going = at < end
            at, end = at[going], end[going]
        return np.concatenate(ends), np.concatenate(found)

    def _after_unknown(self, blocks: np.ndarray) -> np.ndarray:
        """No occurrence holds an unknown word: the next can begin just behind the last of them."""
        behind = np.argmax(blocks[:, ::-1] == NONE, axis=1)
        return self.length - behind

    def _confirm(self, symbols: np.ndarray, at: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compare the words before ``at`` with the windows of the suffix bucket, word by word."""
        text = symbols[at[:, None] + (np.arange(self.length) - self.length + 1)]
        key = _hash(text)
        low, high = self.bucket[cells], self.bucket[cells + 1]
        top = high
        while (low < high).any():  # the bucket is in order of the whole window's hash
            middle = (low + high) // 2
            less = (low < high) & (self.whole[np.minimum(middle, len(self.whole) - 1)] < key)
            low, high = np.where(less, middle + 1, low), np.where(less | (low >= high), high, middle)
        ends, found = [], []
        near = np.flatnonzero(low < top)
        while len(near):
            near = near[self.whole[low[near]] == key[near]]
            same = near[(self.windows[low[near]] == text[near]).all(axis=1)]
            ends.append(at[same])
            found.append(low[same])
            low = low + 1
            near = near[low[near] < top[near]]
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *ends]), np.concatenate([empty, *found])


class Searcher:
    """Finds windows of words; each window belongs to one owner (an index)."""

    def __init__(self, windows: Sequence[str], owners: Sequence[int]):
        """``windows`` are words joined by single spaces, in UTF-8 text."""
        split = [w.split(" ") for w in windows]
        lengths = np.array([len(w) for w in split], np.int64)
        words = pa.array([x.encode() for w in split for x in w], pa.large_binary())
        self.vocabulary = words.unique()
        symbols = pc.index_in(words, value_set=self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int32)
        begin = np.concatenate([[0], np.cumsum(lengths)])
        owners = np.asarray(owners, np.int64)
        self.owners = int(owners.max(initial=0)) + 1
        self.tables = []
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            grid = symbols[begin[:-1][rows][:, None] + np.arange(length)]
            self.tables.append(_Tables(grid, owners[rows]))

    def search(self, content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Search rows of text bytes.

        Returns where each row's words start (rows + 1 values), for each word
        whether an occurrence covers it, and the distinct (row, owner) pairs as two
        columns in order.
        """
        words, starts = split_words(content, bounds)
        symbols = pc.fill_null(pc.index_in(words, value_set=self.vocabulary), NONE).to_numpy(zero_copy_only=False)
        steps = np.zeros(len(symbols) + 1, np.int64)
        pairs = [np.zeros(0, np.int64)]
        for table in self.tables:
            ends, found = table.find(symbols, starts)
            np.add.at(steps, ends - table.length + 1, 1)
            np.add.at(steps, ends + 1, -1)
            rows = np.searchsorted(starts, ends, "right") - 1
            pairs.append(np.unique(rows * self.owners + table.owners[found]))
        rows, owners = np.divmod(np.unique(np.concatenate(pairs)), self.owners)
        return starts, np.cumsum(steps)[:-1] > 0, rows, owners
