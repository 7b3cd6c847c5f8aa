"""A run-compressed Burrows-Wheeler index over many short byte strings, with samples at the ends of its runs.

Queries are streamed from right to left; the index follows the last-to-first mapping as long as the next byte agrees and
otherwise jumps to the nearer end of a run of that byte, whose sample tells a place of the text (its match with the query
is the longer one). So every query position gets an occurrence of its longest match.
"""

from __future__ import annotations

import numpy as np

from . import textops as t
from .suffixes import _class_starts, refine


class RunIndex:
    """Index over strings buf[bounds[i]:bounds[i + 1]]; strings are to be sorted by owner, the smallest first.

    ``size`` is the length of the matches asked for: the rows of one class share their first ``size`` bytes, and
    ``owner_of_class`` is the smallest owner among them.
    """

    def __init__(self, buf: np.ndarray, bounds: np.ndarray, owners: np.ndarray, size: int):
        counts = np.diff(bounds)
        n_texts = len(counts)
        # Each string gets a terminator 0 that sorts below all bytes (which move up by one).
        self.bounds = bounds + np.arange(n_texts + 1)
        n = int(self.bounds[-1])
        symbols = np.zeros(n, np.int16)
        place = np.arange(len(buf)) + np.repeat(np.arange(n_texts), counts)
        symbols[place] = buf.astype(np.int16) + 1
        self.symbols, self.size = symbols, size
        text = np.repeat(np.arange(n_texts), counts + 1)
        left = self.bounds[1:][text] - np.arange(n)
        self.hash = t.RangeHash((symbols & 255).astype(np.uint8))
        sa = self._suffix_order(symbols, left)
        before = np.where(sa == self.bounds[text[sa]], 0, symbols[np.maximum(sa - 1, 0)])
        first = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.run_start, self.run_char = first, before[first].astype(np.int64)
        length = np.diff(np.r_[first, n])
        self.first_sample, self.last_sample = sa[first], sa[first + length - 1]
        self.run_last = first + length - 1
        # Rows before the first of each symbol, and occurrences of a run's symbol before the run.
        self.low = np.searchsorted(symbols[sa], np.arange(258))
        by = np.argsort(self.run_char, kind="stable")
        before_run = np.cumsum(length[by]) - length[by]
        heads = np.searchsorted(self.run_char[by], np.arange(258))
        base = np.append(before_run, 0)[np.minimum(heads, len(before_run) - 1)]
        self.occurrences = np.empty(len(first), np.int64)
        self.occurrences[by] = before_run - base[self.run_char[by]]
        self.by_char = by
        self.char_keys = self.run_char[by] * np.int64(len(first) + 1) + by
        same = np.zeros(n, bool)
        full = left > size
        both = np.flatnonzero(full[sa[1:]] & full[sa[:-1]])
        a, b = sa[both], sa[both + 1]
        same[both + 1] = self.hash(a, a + size) == self.hash(b, b + size)
        self.class_start = np.flatnonzero(~same)
        self.owner_of_class = np.minimum.reduceat(owners[text[sa]], self.class_start) if n else owners[:0]
        self.left = left

    @staticmethod
    def _suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
        n = len(symbols)
        key = np.zeros(n, np.uint64)
        for k in range(7):  # seven symbols of nine bits
            part = np.zeros(n, np.uint64)
            live = np.flatnonzero(left > k)
            part[live] = symbols[live + k].astype(np.uint64)
            key = (key << np.uint64(9)) | part
        order = np.argsort(key)
        rank = _class_starts(key[order], order, n)
        for rank in refine(rank, left, 7, int(left.max(initial=0))):
            pass
        return np.argsort(rank, kind="stable")  # equal suffixes follow the order of their strings

    def _common(self, places: np.ndarray, sums: t.RangeHash, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the common prefix of text[places:] and query[at:], up to limit, by bisection over fingerprints."""
        low, high = np.zeros(len(places), np.int64), np.minimum(limit, self.left[places] - 1)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            ok = self.hash(places[open_], places[open_] + mid) == sums(at[open_], at[open_] + mid)
            low[open_[ok]] = mid[ok]
            high[open_[~ok]] = mid[~ok] - 1

    def owners(self, buf: np.ndarray, bounds: np.ndarray, missing: int) -> np.ndarray:
        """For each position of the queries: the smallest owner of a string that holds the next ``size`` bytes, else missing."""
        out = np.full(len(buf), missing, np.int64)
        if not len(self.run_start) or not len(buf):
            return out
        symbols = buf.astype(np.int64) + 1
        sums = t.RangeHash((symbols & 255).astype(np.uint8))
        counts = np.diff(bounds)
        order = np.argsort(-counts, kind="stable")
        ends, counts = bounds[1:][order], counts[order]
        running = np.searchsorted(-counts, -np.arange(int(counts[0])), side="left")
        row = np.zeros(len(counts), np.int64)
        place = np.full(len(counts), self.first_sample[0])
        width = np.int64(len(self.run_start) + 1)
        for step, live in enumerate(running.tolist()):
            at = ends[:live] - 1 - step
            want = symbols[at]
            run = np.searchsorted(self.run_start, row[:live], side="right") - 1
            off = np.flatnonzero(self.run_char[run] != want)
            if len(off):
                keys = want[off] * width + run[off]
                slot = np.searchsorted(self.char_keys, keys)
                down = np.minimum(slot, len(self.char_keys) - 1)
                up = np.maximum(slot - 1, 0)
                down_run, up_run = self.by_char[down], self.by_char[up]
                has_down = self.run_char[down_run] == want[off]
                has_up = self.run_char[up_run] == want[off]
                limit = np.full(len(off), step, np.int64)
                down_len = np.where(has_down, self._common(self.first_sample[down_run], sums, at[off] + 1, limit), -1)
                up_len = np.where(has_up, self._common(self.last_sample[up_run], sums, at[off] + 1, limit), -1)
                use_up = up_len > down_len
                run[off] = np.where(use_up, up_run, down_run)
                row[off] = np.where(use_up, self.run_last[up_run], self.run_start[down_run])
                place[off] = np.where(use_up, self.last_sample[up_run], self.first_sample[down_run])
                lost = off[~(has_down | has_up)]  # a byte that the index does not hold: start anew to its left
            else:
                lost = off
            row[:live] = self.low[want] + self.occurrences[run] + row[:live] - self.run_start[run]
            place[:live] -= 1
            row[lost], place[lost] = 0, self.first_sample[0]
            if step + 1 >= self.size:
                fits = np.flatnonzero(self.left[place[:live]] > self.size)
                p, q = place[fits], at[fits]
                hit = fits[self.hash(p, p + self.size) == sums(q, q + self.size)]
                out[at[hit]] = self.owner_of_class[np.searchsorted(self.class_start, row[hit], side="right") - 1]
        return out
