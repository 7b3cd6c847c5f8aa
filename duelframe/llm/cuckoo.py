"""A cuckoo filter as NumPy arrays; it runs inside Spark tasks."""

from __future__ import annotations

import io

import numpy as np

from .textops import U64, mix

SLOTS = 4
#: Share of slots that may be taken; above it the table doubles.
LOAD = 0.85
ROUNDS = 500


class Cuckoo:
    """A set of distinct 64-bit hashes, kept as 32-bit fingerprints, that never forgets one and takes deletions.

    A fingerprint lies in one of two buckets of SLOTS, both told by the fingerprint alone, so a full table doubles without
    the hashes. Equal fingerprints are kept once for each hash; what finds no place after ROUNDS moves is kept in a list.
    Only hashes that are in the set may be deleted.
    """

    def __init__(self, expected: int = 0):
        buckets = 16
        while buckets * SLOTS * LOAD < expected:
            buckets *= 2
        self.table, self.stash, self.size = np.zeros((buckets, SLOTS), np.uint32), np.zeros(0, np.uint32), 0

    @property
    def nbytes(self) -> int:
        return self.table.nbytes + self.stash.nbytes

    @staticmethod
    def _prints(keys: np.ndarray) -> np.ndarray:
        return np.maximum((keys >> U64(32)).astype(np.uint32), np.uint32(1))

    def _buckets(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, mask = mix(prints.astype(U64)), U64(len(self.table) - 1)
        first = h & mask
        return first.astype(np.int64), (first ^ (h >> U64(32) & mask | U64(1))).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        first, second = self._buckets(prints)
        return first ^ second ^ at

    def insert(self, keys: np.ndarray) -> None:
        """Add hashes that are not in the set."""
        prints = self._prints(keys)
        self.size += len(prints)
        if self.size > self.table.size * LOAD:
            prints = np.concatenate([self.table[self.table > 0], self.stash, prints])
            self.table, self.stash = Cuckoo(self.size).table, self.stash[:0]
        at = self._buckets(prints)[0]
        for turn in range(ROUNDS):
            prints, at = self._settle(prints, at)
            prints, at = self._settle(prints, self._other(prints, at))
            if not len(prints):
                return
            # Both buckets are full: in each bucket one of those that wait takes the place of another.
            spot, one = np.unique(at, return_index=True)
            slot = np.random.default_rng(turn).integers(0, SLOTS, len(spot))
            out = self.table[spot, slot]
            self.table[spot, slot] = prints[one]
            prints, at = np.concatenate([out, np.delete(prints, one)]), np.concatenate([spot, np.delete(at, one)])
            at = self._other(prints, at)
        self.stash = np.concatenate([self.stash, prints])

    def _settle(self, prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put fingerprints into free slots of their buckets; those without one come back."""
        order = np.argsort(at, kind="stable")
        prints, at = prints[order], at[order]
        heads = np.flatnonzero(np.diff(at, prepend=-1))
        rank = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
        free = self.table[at] == 0
        fits = rank < free.sum(1)
        slots = np.argsort(~free, axis=1, kind="stable")[np.arange(len(at)), np.minimum(rank, SLOTS - 1)]
        self.table[at[fits], slots[fits]] = prints[fits]
        return prints[~fits], at[~fits]

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """False only for hashes that are not in the set."""
        prints = self._prints(keys)
        first, second = self._buckets(prints)
        found = (self.table[first] == prints[:, None]).any(1) | (self.table[second] == prints[:, None]).any(1)
        return found | np.isin(prints, self.stash) if len(self.stash) else found

    def delete(self, keys: np.ndarray) -> None:
        """Take hashes out that are in the set."""
        prints = self._prints(keys)
        for mark, *buckets in zip(prints, *self._buckets(prints)):
            for bucket in buckets:
                slot = np.flatnonzero(self.table[bucket] == mark)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break
            else:
                place = np.flatnonzero(self.stash == mark)
                if not len(place):
                    raise ValueError("a deleted hash was not in the filter")
                self.stash = np.delete(self.stash, place[0])
        self.size -= len(prints)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, table=self.table, stash=self.stash)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Cuckoo":
        out, arrays = cls(), np.load(io.BytesIO(data))
        out.table, out.stash = arrays["table"], arrays["stash"]
        out.size = int((out.table > 0).sum()) + len(out.stash)
        return out
