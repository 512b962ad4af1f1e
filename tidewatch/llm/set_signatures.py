"""Signatures of sets for the Jaccard join: universe partition with one-deletion neighbourhoods.

Two sets that link differ in at most H elements, H from their sizes. Elements
are hashed into m segments; by the pigeonhole principle, if every segment i is
given v(i) in {-1, 0, 1} (skipped, equal, at most one element apart) with the
sum of v(i) + 1 over H, then two sets that link agree to within v(i) in some
segment i that is not skipped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tidewatch.llm.words import U64, splitmix

#: Cells of the sketch of element frequencies, by which segments are allocated.
SKETCH = 1 << 20
#: What a signature row may be met by: EXACT rows meet all but each other's
#: deletions; only rows with PROBE start a pair.
EXACT, DELETED, PROBE = 0, 1, 2


@dataclass(frozen=True)
class Threshold:
    """Links: ``of`` * intersection >= ``percent`` * union."""

    percent: int = 85
    of: int = 100

    def largest(self, size: int) -> int:
        return size * self.of // self.percent

    def apart(self, total: int) -> int:
        """Most elements in the symmetric difference of linked sets with ``total`` elements in all."""
        return (self.of - self.percent) * total // (self.of + self.percent)

    def links(self, common: np.ndarray, total: np.ndarray) -> np.ndarray:
        return self.of * common >= self.percent * (total - common)


@lru_cache(maxsize=4)
def bands(threshold: Threshold, most: int) -> np.ndarray:
    """First size of each band; a set links only within its band and the next ones beside it."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(threshold.largest(starts[-1]) + 1)
    return np.array(starts)


@dataclass(frozen=True)
class Scheme:
    """The partition for the pairs within a band and from it to the next."""

    segments: int
    deletions: int  # the first so many segments have one-deletion neighbourhoods
    skips: int  # units of v(i) that the largest sets may take away; smaller ones may take away more


@lru_cache(maxsize=100_000)
def scheme(threshold: Threshold, largest_in_band: int) -> Scheme:
    """Skips are paid for by one segment in 16 above need and two more, as few sets have more empty ones than that."""
    need = threshold.apart(largest_in_band + threshold.largest(largest_in_band)) + 1
    deletions = min(1 + need // 32, need - 1)
    segments = need - deletions + need // 16 + (2 if need > 3 else 0)
    return Scheme(segments, deletions, min(segments + deletions - need, segments - deletions))


#: Frequencies above this one cost alike; what meets empty segments, which any set may have, costs more.
_DEAR = 1 << 40
_EMPTY = _DEAR + (1 << 20) + 1


def allocated(
    begin: np.ndarray, deletions: np.ndarray, spare: np.ndarray, rarest: np.ndarray, second: np.ndarray, filled: np.ndarray
) -> np.ndarray:
    """v(i) of each segment: 1 (with a neighbourhood) or 0, less the dearest units of its set.

    Set k has segments begin[k] .. begin[k + 1] - 1, the first deletions[k] of them with neighbourhoods, and
    may take away spare[k] units. The first unit of a neighbourhood costs ``second``, the
    frequency of the second rarest element, which is what meets a segment without its rarest; the last unit
    of a segment costs ``rarest``. What meets empty segments costs most, and most of all where one unit
    spares it.
    """
    holder = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    number = np.arange(len(holder)) - begin[holder]
    loose = number < deletions[holder]
    wide = np.flatnonzero(loose)
    twice = _EMPTY - 1 - np.minimum(number, 1 << 20)  # both units of an empty neighbourhood side by side
    outer = np.where(filled[wide] > 1, np.minimum(second[wide], _DEAR), np.where(filled[wide] == 1, _EMPTY, twice[wide]))
    inner = np.where(filled > 0, np.minimum(rarest, _DEAR), np.where(loose, twice, _EMPTY))
    unit = np.concatenate([wide, np.arange(len(holder))])
    dear = 2 * (_EMPTY - np.concatenate([outer, inner])) + (np.arange(len(unit)) >= len(wide))
    units = np.diff(begin) + deletions
    before = np.cumsum(units) - units
    v = loose.astype(np.int8)
    for few in range(0, len(units), 1 << 20):  # a key has 20 bits for the set
        own = slice(None) if len(units) <= 1 << 20 else np.flatnonzero(holder[unit] >> 20 == few >> 20)
        mine = unit[own]
        order = np.argsort(((holder[mine] - few) << 42) + dear[own])
        owner = np.repeat(np.arange(few, min(few + (1 << 20), len(units))), units[few : few + (1 << 20)])
        place = before[few] + np.arange(len(order)) - before[owner]
        taken = mine[order[place < spare[owner]]]
        v -= np.bincount(taken, minlength=len(v)).astype(np.int8)
    return v


def signatures(
    shingles: np.ndarray, starts: np.ndarray, sketch: np.ndarray, threshold: Threshold
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, kind) of all sets; row k has distinct shingles[starts[k]:starts[k + 1]].

    A set of band b takes part in the schemes of band b (with its own and the
    next band) and b - 1. Every set v(i) is allocated by cost, which is the least frequency of
    a segment's elements by the sketch, as a set meets the others that hold all of them; what meets
    empty segments is spared first. The sum that v must reach follows from the set's own size.
    """
    sizes = np.diff(starts)
    if not len(shingles):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int8)
    first = bands(threshold, int(sizes.max()))
    band = np.searchsorted(first, sizes, "right") - 1
    rows, found, kinds = [], [], []
    filled = np.flatnonzero(sizes > 0)
    for back in (0, 1):
        level = band[filled] - back
        mine = filled[level >= 0]
        level = level[level >= 0]
        if not len(mine):
            continue
        plans = {b: scheme(threshold, int(first[b + 1] - 1)) for b in np.unique(level)}
        segments = np.array([plans[b].segments for b in level])
        deletions = np.array([plans[b].deletions for b in level])
        counts = sizes[mine]
        # the largest sets met: of the lower band, or as large as may link
        partner = first[level + 1] - 1 if back else threshold.largest(counts)
        spare = segments + deletions - (threshold.apart(counts + partner) + 1)
        base = np.concatenate([[0], np.cumsum(segments)])
        owner = np.repeat(np.arange(len(mine)), counts)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        element = shingles[starts[mine][owner] + at]
        salt = splitmix(level.astype(np.uint64) + U64(1))[owner]
        mixed = splitmix(element ^ salt)
        segment = ((mixed >> U64(32)) * segments[owner].astype(np.uint64) >> U64(32)).astype(np.int64)
        place = base[owner] + segment
        total = int(base[-1])
        content = np.zeros(total, U64)
        np.add.at(content, place, splitmix(mixed))
        holder = np.repeat(np.arange(len(mine)), segments)
        number = np.arange(total) - base[holder]
        loose = number[place] < deletions[owner]
        often = sketch[(element & U64(SKETCH - 1)).astype(np.int64)]
        rarest = np.full(total, np.iinfo(np.int64).max)
        np.minimum.at(rarest, place, often)
        # the second rarest element of each segment with a neighbourhood
        second = np.zeros(total, np.int64)
        near, times = place[loose], often[loose]
        order = np.lexsort((times, near))
        near, times = near[order], times[order]
        after = np.flatnonzero(np.concatenate([[False], near[1:] == near[:-1]]))
        after = after[np.concatenate([[True], near[after[1:]] != near[after[:-1]]])] if len(after) else after
        second[near[after]] = times[after]
        v = allocated(base, deletions, spare, rarest, second, np.bincount(place, minlength=total))
        tag = splitmix((level.astype(np.uint64)[holder] << U64(32)) + number.astype(np.uint64))
        rows.append(mine[holder])
        found.append(splitmix(content ^ tag))
        kinds.append(np.where(v >= 0, EXACT | PROBE, EXACT).astype(np.int8))
        # the neighbourhoods: the segment without each of its elements in turn
        without = content[place[loose]] - splitmix(mixed[loose])
        rows.append(mine[owner[loose]])
        found.append(splitmix(without ^ tag[place[loose]]))
        kinds.append(np.where(v[place[loose]] > 0, DELETED | PROBE, DELETED).astype(np.int8))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(kinds)


def parity(shingles: np.ndarray, starts: np.ndarray, bits: int = 1024) -> np.ndarray:
    """For each set, which of ``bits`` classes hold an odd number of its elements.

    Two sets differ in at least as many elements as their parities differ in bits.
    """
    rows = len(starts) - 1
    owner = np.repeat(np.arange(rows), np.diff(starts))
    cells = owner * bits + (splitmix(shingles) & U64(bits - 1)).astype(np.int64)
    odd = np.bincount(cells, minlength=rows * bits).reshape(rows, bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)
