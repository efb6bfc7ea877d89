"""Suffix sorting by hash comparisons: prefix polynomial hashes, common extensions, merge sort."""

from __future__ import annotations

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def _power(count: int, inverse: bool) -> np.ndarray:
    """The first powers of the factor, or of its inverse, modulo 2**64."""
    if len(_powers[inverse]) < count:
        steps = np.full(1 << count.bit_length(), _INVERSE if inverse else _FACTOR)
        steps[0] = 1
        _powers[inverse] = np.multiply.accumulate(steps)
    return _powers[inverse][:count]


class PrefixHashes:
    """Hash of any substring of a byte string from its prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power(len(data), False), out=self.sums[1:])
        self.back = _power(len(data) + 1, True)

    def every(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        return (self.sums[length:] - self.sums[: len(self.sums) - length]) * self.back[: len(self.sums) - length]

    def at(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hashes of the substrings of these starts and lengths."""
        return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at ``x`` and ``y``, ``most`` at most; binary search."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.at(x, middle) == self.at(y, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _before(text: PrefixHashes, ends: np.ndarray, start: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether suffix ``x`` comes before ``y``: at the first difference, a shorter one first, then by number."""
    most = np.minimum(ends[x] - start[x], ends[y] - start[y])
    shared = text.common(start[x], start[y], most)
    last = len(text.data) - 1
    a = np.where(shared < ends[x] - start[x], text.data[np.minimum(start[x] + shared, last)].astype(np.int16), -1)
    b = np.where(shared < ends[y] - start[y], text.data[np.minimum(start[y] + shared, last)].astype(np.int16), -1)
    return np.where(a == b, x < y, a < b)


def merge_sort(text: PrefixHashes, start: np.ndarray, ends: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes ``start`` up to ``ends`` within each ``group``; groups stay in order.

    Runs double in length. In a merge each suffix finds its place in the other run by binary
    search, and a comparison takes a logarithmic number of hashes; all merges of a
    level are done at once.
    """
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    first = np.searchsorted(sorted_group, sorted_group, "left")
    size = np.searchsorted(sorted_group, sorted_group, "right") - first
    place = np.arange(len(order)) - first
    run, largest = 1, int(size.max(initial=0))
    while run < largest:
        active = np.flatnonzero(size > run)
        here, base = place[active], first[active]
        in_left = (here // run) % 2 == 0
        pair = here // (2 * run) * (2 * run)
        other = np.where(in_left, pair + run, pair)
        low = np.minimum(other, size[active])
        high = np.minimum(other + run, size[active])
        other_start = low.copy()
        mine = order[active]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            theirs = order[base[open_] + middle]
            smaller = _before(text, ends, start, theirs, mine[open_])
            low[open_] = np.where(smaller, middle + 1, low[open_])
            high[open_] = np.where(smaller, high[open_], middle)
        own_start = np.where(in_left, pair, pair + run)
        target = base + pair + (here - own_start) + (low - other_start)
        moved = order.copy()
        moved[target] = mine
        order = moved
        run *= 2
    return order
