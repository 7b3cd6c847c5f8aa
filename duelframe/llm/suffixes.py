"""Suffix arrays of many short texts at once, by prefix doubling on arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_ranks(symbols: np.ndarray, bounds: np.ndarray, limit: int | None = None) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols; suffixes never reach beyond their own text.

    A rank is the number of suffixes before the first of its class, so classes only ever split and each round sorts
    just those that still hold several suffixes. Stops when all ranks differ or ``limit`` symbols are compared.
    """
    n = len(symbols)
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(bounds[1:], counts) - np.arange(n)
    _, dense = np.unique(symbols, return_inverse=True)
    key = doc * np.int64(n + 1) + dense
    order = np.argsort(key, kind="stable")
    levels = [_class_starts(key[order], order, n)]
    for rank in refine(levels[0], left, 1, limit):
        levels.append(rank)
    return levels


def refine(rank: np.ndarray, left: np.ndarray, step: int, limit: int | None = None) -> Iterator[np.ndarray]:
    """Ranks by 2 * step, 4 * step, ... symbols from those by ``step``; left has the symbols up to the end of the text."""
    n = len(rank)
    active = _shared(rank, np.arange(n))
    while len(active) and (limit is None or step < limit):
        after = np.zeros(len(active), np.int64)
        inside = left[active] > step
        after[inside] = rank[active[inside] + step] + 1
        key = rank[active] * np.int64(n + 1) + after
        order = np.argsort(key)
        key, old = key[order], rank[active][order]
        place = np.arange(len(key))
        first_old = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], place, 0))
        first_new = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], place, 0))
        rank = rank.copy()
        rank[active[order]] = old + first_new - first_old
        yield rank
        step *= 2
        active = _shared(rank, active)


def _class_starts(sorted_key: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    rank = np.empty(n, np.int64)
    if n:
        rank[order] = np.maximum.accumulate(np.where(np.r_[True, sorted_key[1:] != sorted_key[:-1]], np.arange(n), 0))
    return rank


def _shared(rank: np.ndarray, positions: np.ndarray) -> np.ndarray:
    sizes = np.bincount(rank[positions], minlength=len(rank) + 1)
    return positions[sizes[rank[positions]] > 1]


def neighbour_lcp(levels: list[np.ndarray], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the common prefix length of each suffix with the one before it (0 across texts)."""
    n = len(levels[0])
    sa = np.empty(n, np.int64)
    sa[levels[-1]] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return sa, lcp
    end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    x, y = sa[at - 1], sa[at]
    length = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = x + length, y + length
        inside = np.flatnonzero((a < end[x]) & (b < end[y]))
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        length[same] += 1 << k
    lcp[at] = length
    return sa, lcp


def maximal_repeats(sa: np.ndarray, lcp: np.ndarray, symbols: np.ndarray, bounds: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first row, last row, length) of every LCP interval of at least ``least`` symbols that cannot be extended to the left.

    Such an interval holds all occurrences of one maximal repeated substring.
    """
    starts_text = np.zeros(len(symbols) + 1, bool)
    starts_text[bounds[:-1]] = True
    before = np.where(starts_text[sa], -1 - sa, symbols[np.maximum(sa - 1, 0)])
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    found = []
    high = np.flatnonzero(lcp >= least)
    stack: list[tuple[int, int]] = []

    def close(row: int, floor: int) -> int:
        first = row
        while stack and stack[-1][1] > floor:
            first, length = stack.pop()
            if changes[row - 1] > changes[first]:
                found.append((first, row - 1, length))
        return first

    last = -2
    for row, length in zip(high.tolist(), lcp[high].tolist()):
        if row != last + 1:
            close(last + 1, 0)
            first = row - 1
        else:
            first = min(close(row, length), row - 1)
        if not stack or stack[-1][1] < length:
            stack.append((first, length))
        last = row
    close(last + 1, 0)
    return found
