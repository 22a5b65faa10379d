"""Cuckoo filter over 64-bit hashes with bulk insert, probe and delete."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 200
_MIX = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """Multiset of 16-bit fingerprints in buckets of four slots.

    Each hash has two buckets, the second found from the first and the fingerprint alone, so that an entry
    can be moved and removed without its hash. Hashes that find no slot after KICKS moves go to an exact
    stash: inserts never fail and probes never miss.
    """

    def __init__(self, capacity: int = 16, slots: np.ndarray | None = None, stash: np.ndarray | None = None):
        buckets = 1 << max(2, int(np.ceil(np.log2(max(capacity, 1) / SLOTS / 0.8 + 1))))
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots
        self.stash = [] if stash is None else [int(x) for x in stash]
        self.mask = np.uint64(len(self.slots) - 1)

    def _places(self, hashes: np.ndarray):
        h = np.asarray(hashes).astype(np.uint64)
        prints = ((h >> np.uint64(48)) & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = h & self.mask
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        return (bucket ^ ((prints.astype(np.uint64) * _MIX) >> np.uint64(20))) & self.mask

    def insert(self, hashes: np.ndarray) -> None:
        prints, first, second = self._places(hashes)
        left = np.arange(len(prints))
        for bucket in (first, second):
            for slot in range(SLOTS):
                if not len(left):
                    return
                at = bucket[left].astype(np.int64)
                chosen, where = np.unique(at, return_index=True)
                free = self.slots[chosen, slot] == 0
                self.slots[chosen[free], slot] = prints[left[where[free]]]
                left = np.delete(left, where[free])
        rng = np.random.default_rng(7)
        for i in left:
            self._kick(int(hashes[i]), prints[i : i + 1], second[i : i + 1], rng)

    def _kick(self, whole: int, held: np.ndarray, bucket: np.ndarray, rng) -> None:
        trail = []
        for _ in range(KICKS):
            row = self.slots[int(bucket[0])]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = held[0]
                return
            slot = int(rng.integers(SLOTS))
            trail.append((int(bucket[0]), slot, row[slot]))
            out = row[slot : slot + 1].copy()
            row[slot] = held[0]
            held, bucket = out, self._other(bucket, out)
        for at, slot, value in reversed(trail):
            self.slots[at, slot] = value
        self.stash.append(whole)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        found = np.zeros(len(prints), bool)
        for bucket in (first, second):
            found |= (self.slots[bucket.astype(np.int64)] == prints[:, None]).any(axis=1)
        if self.stash:
            found |= np.isin(np.asarray(hashes).astype(np.uint64), np.array(self.stash, np.uint64))
        return found

    def delete(self, hashes: np.ndarray) -> None:
        """Remove hashes that were inserted; each call removes one copy."""
        prints, first, second = self._places(hashes)
        for whole, mark, *buckets in zip(np.asarray(hashes).astype(np.uint64), prints, first, second, strict=True):
            if int(whole) in self.stash:
                self.stash.remove(int(whole))
                continue
            for bucket in buckets:
                row = self.slots[int(bucket)]
                if len(at := np.flatnonzero(row == mark)):
                    row[at[0]] = 0
                    break

    def state(self) -> tuple[bytes, bytes]:
        return self.slots.tobytes(), np.array(self.stash, np.uint64).tobytes()

    @classmethod
    def of(cls, slots: bytes, stash: bytes) -> CuckooFilter:
        return cls(slots=np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy(), stash=np.frombuffer(stash, np.uint64))
