"""Cuckoo filter of one shard: a numpy table of buckets with four 16-bit entries.

An entry is a 15-bit fingerprint (never 0) and one bit, ``shared``, that says
the key occurs in more than one document.  The table is a multiset of
entries, so taking one entry out and putting another in keeps it exact for
every other key, also where two keys have equal fingerprints.  It never says
"absent" of a key that is in it; it may say "present" of one that is not.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
LOAD = 0.8
KICKS = 500
ABSENT, SINGLE, SHARED = 0, 1, 2


class Full(Exception):
    """No place found for an entry; the table must be built anew, larger."""


def size_for(keys: int) -> int:
    """Buckets, a power of two, for so many keys."""
    need = max(1, int(keys / (SLOTS * LOAD)) + 1)
    return 1 << (need - 1).bit_length()


def empty(keys: int) -> np.ndarray:
    return np.zeros((size_for(keys), SLOTS), dtype=np.uint16)


def _places(table: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, first bucket, second bucket) of keys given as two 64-bit hashes."""
    mask = np.int64(len(table) - 1)
    fp = ((x.view(np.uint64) >> np.uint64(40)) % np.uint64(32767) + np.uint64(1)).astype(np.int64)
    one = y & mask
    return fp, one, _other(one, fp, mask)


def _other(bucket, fp, mask):
    return bucket ^ ((fp * 0x5BD1E995 >> 7) & mask)


def _put(table: np.ndarray, entry: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Place entries in free slots of their buckets; the indices that found none."""
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    first = np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1]] if len(order) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else order
    rank = np.arange(len(order)) - begin
    free = np.argsort(table[sorted_bucket] != 0, axis=1, kind="stable")  # free slots first
    count = (table[sorted_bucket] == 0).sum(axis=1)
    fits = rank < count
    table[sorted_bucket[fits], free[fits, rank[fits]]] = entry[order][fits]
    return order[~fits]


def insert(table: np.ndarray, x: np.ndarray, y: np.ndarray, shared: np.ndarray) -> None:
    """Add an entry for each key; raises Full where none can be placed."""
    fp, one, two = _places(table, x, y)
    entry = (fp * 2 + shared).astype(np.uint16)
    left = _put(table, entry, one)
    left = left[_put(table, entry[left], two[left])]
    mask = len(table) - 1
    rng = np.random.default_rng(len(x))
    for i in left:
        e, bucket = int(entry[i]), int(two[i])
        for _ in range(KICKS):
            slot = np.flatnonzero(table[bucket] == 0)
            if len(slot):
                table[bucket, slot[0]] = e
                break
            slot = rng.integers(SLOTS)
            e, table[bucket, slot] = int(table[bucket, slot]), e
            bucket = int(_other(bucket, e >> 1, mask))
        else:
            raise Full


def remove(table: np.ndarray, x: np.ndarray, y: np.ndarray, shared: np.ndarray) -> None:
    """Take one entry out for each key; the key must be in the table with that mark."""
    fp, one, two = _places(table, x, y)
    entry = fp * 2 + shared
    for e, a, b in zip(entry.tolist(), one.tolist(), two.tolist(), strict=True):
        for bucket in (a, b):
            slot = np.flatnonzero(table[bucket] == e)
            if len(slot):
                table[bucket, slot[0]] = 0
                break
        else:
            raise KeyError("an entry to remove is not in the filter")


def probe(table: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """ABSENT (certain), SINGLE or SHARED (each possible) for each key."""
    fp, one, two = _places(table, x, y)
    seen = np.concatenate([table[one], table[two]], axis=1).astype(np.int64)
    shared = (seen == (fp * 2 + 1)[:, None]).any(axis=1)
    single = (seen == (fp * 2)[:, None]).any(axis=1)
    return np.where(shared, SHARED, np.where(single, SINGLE, ABSENT)).astype(np.int32)


def dump(table: np.ndarray) -> bytes:
    return table.tobytes()


def load(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint16).reshape(-1, SLOTS)
