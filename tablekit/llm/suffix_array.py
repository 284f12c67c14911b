"""Suffix arrays in numpy, and the windows that repeat among some byte strings."""

from __future__ import annotations

import numpy as np

_PACKED = 7  # symbols of 0..256 in one uint64
_LANE = 32


def packed_symbols(symbols: np.ndarray) -> np.ndarray:
    """For each place the next seven symbols as one number; 0 beyond the end."""
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(_PACKED, np.uint64)])
    out = np.zeros(len(symbols), np.uint64)
    for i in range(_PACKED):
        out = out * np.uint64(257) + padded[i : i + len(symbols)]
    return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in sorted order, by Larsson and Sadakane's refinement.

    Suffixes are first sorted by seven symbols. Then, with the sorted length doubling
    each time, only those in groups that are still equal are sorted again, by the group
    of the suffix that starts where the compared part ends.
    """
    n = len(symbols)
    key = packed_symbols(symbols)
    order = np.argsort(key)
    group = np.empty(n + 1, np.int64)
    group[n] = -1
    where, length, tied = np.arange(n), _PACKED, key[order]
    while True:
        last = np.append(tied[1:] != tied[:-1], True)  # of its group
        ends = np.flatnonzero(last)
        group[order[where]] = np.repeat(where[ends], np.diff(np.append(-1, ends)))
        first = np.append(True, last[:-1])
        where = where[~(first & last)]
        if not len(where):
            return order
        suffixes = order[where]
        tied = group[suffixes] * (n + 1) + group[np.minimum(suffixes + length, n)] + 1
        again = np.argsort(tied)
        order[where], tied = suffixes[again], tied[again]
        length *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in ``order`` the length, up to ``most``, of what its suffix and the
    one before it have in common, by Kasai's rule that the next start loses one at most.
    Stretches of 32 starts run side by side."""
    n = len(symbols)
    # beyond the end no two places are alike, so no comparison runs on
    beyond = np.arange(2 * _PACKED + 2)
    key = np.concatenate([packed_symbols(symbols), np.uint64(2**64 - 1) - beyond.astype(np.uint64)])
    padded = np.concatenate([symbols.astype(np.int32), -1 - beyond.astype(np.int32)])
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    begins = np.arange(0, n, _LANE)
    length = np.zeros(len(begins), np.int64)
    for step in range(_LANE):
        i = begins + step
        lanes = np.flatnonzero(i < n)
        i, begins, length = i[lanes], begins[lanes], length[lanes]
        j = before[i]
        length = np.where(j < 0, 0, np.maximum(length - 1, 0))
        for words, stride in ((key, _PACKED), (padded, 1)):
            live = np.flatnonzero((j >= 0) & (length < most))
            a, b = i[live] + length[live], j[live] + length[live]
            while len(live):
                same = words[a] == words[b]
                live, a, b = live[same], a[same] + stride, b[same] + stride
                length[live] += stride
                more = length[live] < most
                live, a, b = live[more], a[more], b[more]
        out[i] = np.minimum(length, most)
    return out[order]


def later_windows(regions: np.ndarray, sizes: np.ndarray, document: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """(region, first, last) for each run of places in a region at which a string of
    ``width`` bytes starts that also starts earlier, by (document, place), in another
    region or in the same. ``regions`` has their bytes end to end; ``document`` and
    ``start`` say where a region comes from."""
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = np.zeros(int((sizes + 1).sum()), np.uint16)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(symbols)) - begins[owner]
    inside = place < sizes[owner]
    symbols[inside] = regions.astype(np.uint16) + 1
    if not len(symbols):
        return np.empty((0, 3), np.int64)
    order = suffix_array(symbols)
    shared = common_prefixes(symbols, order, width)
    run = np.cumsum(shared < width)  # places in the same run start with the same bytes
    whole = sizes[owner] - place >= width
    run, order = run[whole[order]], order[whole[order]]
    if not len(order):
        return np.empty((0, 3), np.int64)
    at = document[owner[order]] * (1 << 40) + start[owner[order]] + place[order]
    heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    least = np.repeat(np.minimum.reduceat(at, heads), np.diff(np.append(heads, len(run))))
    later = np.zeros(len(symbols) + 1, bool)
    later[order[at > least]] = True
    edges = np.flatnonzero(later[1:] != later[:-1]) + 1
    edges = np.concatenate([[0], edges]) if later[0] else edges
    first, last = edges[0::2], edges[1::2] - 1
    return np.stack([owner[first], place[first], place[last]], axis=1)
