"""A cuckoo filter in one numpy array: insert, delete, and look up many keys at once."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500
# Share of slots that may be taken before a filter is made twice as large.
LOAD = 0.8


class Full(Exception):
    """No place was found for a fingerprint."""


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a key is two 64-bit halves of its digest.

    No key that was inserted is missed. One in about 8,000 others is taken for known.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray) -> CuckooFilter:
        """A filter that holds the given keys, made larger until all find a place."""
        room = len(first)
        while True:
            made = cls.sized(room)
            try:
                made.insert(first, second)
                return made
            except Full:
                room = 2 * max(room, 8)

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def other(self, bucket, mark):
        """The second bucket of a fingerprint, and from there the first again."""
        spread = np.asarray(mark, np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return (np.asarray(bucket, np.uint64) ^ spread) & np.uint64(self.mask)

    def places(self, first: np.ndarray, second: np.ndarray):
        marks = second.astype(np.uint64) & np.uint64(0xFFFF)
        marks = np.where(marks == 0, np.uint64(1), marks).astype(np.uint16)
        # The low bits of the first half choose the shard, so that others choose the bucket.
        here = first.astype(np.uint64) >> np.uint64(24) & np.uint64(self.mask)
        return marks, here.astype(np.int64), self.other(here, marks).astype(np.int64)

    def insert(self, first: np.ndarray, second: np.ndarray) -> None:
        for mark, here, there in zip(*(part.tolist() for part in self.places(first, second))):
            self.insert_one(mark, here, there)

    def insert_one(self, mark: int, here: int, there: int) -> None:
        table = self.table
        for bucket in (here, there):
            for slot in range(SLOTS):
                if not table[bucket, slot]:
                    table[bucket, slot] = mark
                    return
        bucket = there
        for kick in range(KICKS):
            slot = (mark + kick) % SLOTS
            mark, table[bucket, slot] = int(table[bucket, slot]), mark
            bucket = int(self.other(bucket, mark))
            for slot in range(SLOTS):
                if not table[bucket, slot]:
                    table[bucket, slot] = mark
                    return
        raise Full

    def delete(self, first: np.ndarray, second: np.ndarray) -> None:
        """Take out keys that were inserted before."""
        for mark, here, there in zip(*(part.tolist() for part in self.places(first, second))):
            for bucket in (here, there):
                found = np.flatnonzero(self.table[bucket] == mark)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break
            else:
                raise KeyError("a key to delete was never inserted")

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        marks, here, there = self.places(first, second)
        marks = marks[:, None]
        return (self.table[here] == marks).any(1) | (self.table[there] == marks).any(1)
