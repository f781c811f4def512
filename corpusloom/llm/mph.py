"""Minimal perfect hashing of 64-bit keys, by hash and displace.

Keys fall into buckets; the buckets, largest first, each take the first displacement that sends their keys to free
slots. A bucket of one key names its slot outright, so n keys fill exactly n slots. A slot stores the 32-bit
fingerprint of its key, with which a key that was never indexed is refused, but for one in four thousand million.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
KEYS_PER_BUCKET = 3
#: Displacements that a bucket of distinct keys never comes near.
TRIES = 1 << 24


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """The SplitMix64 finaliser."""
    x = x + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def keys_of(doc_ids: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """A 64-bit key for the nth row of a document id."""
    with np.errstate(over="ignore"):
        return mix(mix(doc_ids.astype(np.int64).view(np.uint64), 1) + nth.astype(np.uint64), 2)


def _slot(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    return mix(h ^ mix(d.astype(np.uint64), 3), 4) % np.uint64(n)


class PerfectHash:
    """``displacements`` (negative: a slot named outright) and ``prints``, the fingerprint in each slot."""

    def __init__(self, displacements: np.ndarray, prints: np.ndarray):
        self.displacements, self.prints = displacements, prints

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash of distinct keys, and the slot of each."""
        n = len(keys)
        if len(np.unique(keys)) < n:
            raise ValueError("keys are not distinct")
        with np.errstate(over="ignore"):
            buckets = max(1, -(-n // KEYS_PER_BUCKET))
            of = (mix(keys, 5) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            sizes = np.bincount(of, minlength=buckets)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            displacements, slots = np.zeros(buckets, np.int32), np.zeros(n, np.int64)
            free = np.ones(n, bool)
            tries = np.arange(256, dtype=np.uint64)
            by_size = np.argsort(-sizes, kind="stable")
            for b in by_size[: int((sizes > 1).sum())]:
                own = order[starts[b] : starts[b + 1]]
                for at in range(0, TRIES, 256):
                    found = _slot(keys[own][None, :], tries[:, None] + np.uint64(at), n).astype(np.int64)
                    ok = free[found].all(axis=1)
                    for k in np.flatnonzero(ok):
                        if len(set(found[k].tolist())) == len(own):
                            displacements[b], slots[own] = at + k, found[k]
                            free[found[k]] = False
                            break
                    else:
                        continue
                    break
                else:
                    raise ValueError("no displacement fits a bucket")
            alone = by_size[int((sizes > 1).sum()) : int((sizes > 0).sum())]
            left = np.flatnonzero(free)
            displacements[alone] = -left - 1
            slots[order[starts[alone]]] = left
            prints = np.zeros(n, np.uint32)
            prints[slots] = mix(keys, 6).astype(np.uint32)
        return cls(displacements, prints), slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key whose fingerprint is not the slot's."""
        n = len(self.prints)
        if not n:
            return np.full(len(keys), -1)
        with np.errstate(over="ignore"):
            d = self.displacements[(mix(keys, 5) % np.uint64(len(self.displacements))).astype(np.int64)].astype(np.int64)
            slots = np.where(d < 0, -d - 1, _slot(keys, np.maximum(d, 0), n).astype(np.int64))
            return np.where(self.prints[slots] == mix(keys, 6).astype(np.uint32), slots, -1)
