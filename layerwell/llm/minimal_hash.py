"""Minimal perfect hash of 64-bit keys, in buckets that are built independently.

A key's mixed value names its bucket. Inside a bucket, level after level, keys that are alone in their cell of a bit
field of about twice their number keep it, the others go on to the next level. A key's index is the number of set bits
before its own, so n keys get the indices 0 to n - 1, at about 3.3 bits a key. Keys that were not built in get
some index or none: compare the key stored there.
"""

from __future__ import annotations

import numpy as np

LEVELS = 16
KEYS_PER_BUCKET = 1 << 15
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(keys: np.ndarray, seed: np.ndarray | int = 0) -> np.ndarray:
    """Well spread non-negative 63-bit values."""
    x = keys.astype(np.uint64) + np.asarray(seed, np.uint64) * _ODD + _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct keys: seed, bits per level, all levels' bits as 64-bit words, and the keys in the order of their index."""
    seed = 1
    while True:
        left, sizes, fields, placed = keys, [], [], []
        for level in range(LEVELS):
            size = -(-2 * len(left) // 64) * 64
            cells = mix(left, seed + level) % size if size else np.empty(0, np.int64)
            alone = np.bincount(cells, minlength=size) == 1
            sizes.append(size)
            fields.append(alone)
            keeps = alone[cells]
            placed.append(left[keeps][np.argsort(cells[keeps])])
            left = left[~keeps]
        if not len(left):
            bits = np.packbits(np.concatenate(fields), bitorder="little").view(np.uint64)
            return seed, np.array(sizes, np.int64), bits, np.concatenate(placed)
        seed += LEVELS


class MinimalHash:
    """Lookup over the buckets' parts, given in the order of their numbers; an index counts through all buckets."""

    def __init__(self, seeds: list[int], sizes: list[np.ndarray], bits: list[np.ndarray]):
        self.seeds = np.array(seeds, np.int64)
        self.sizes = np.array(sizes, np.int64).reshape(len(seeds), LEVELS)
        ends = np.cumsum(self.sizes.ravel())
        self.first = (ends - self.sizes.ravel()).reshape(self.sizes.shape)
        self.bits = np.concatenate([*bits, np.empty(0, np.uint64)])
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key, -1 where it certainly was not built in."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.seeds):
            return out
        rest = np.arange(len(keys))
        bucket = mix(keys) % len(self.seeds)
        for level in range(LEVELS):
            size = self.sizes[bucket, level]
            rest, bucket, size = rest[size > 0], bucket[size > 0], size[size > 0]
            if not len(rest):
                break
            at = self.first[bucket, level] + mix(keys[rest], self.seeds[bucket] + level) % size
            word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
            values = self.bits[word]
            here = (values & bit) != 0
            out[rest[here]] = self.before[word[here]] + np.bitwise_count(values[here] & (bit[here] - np.uint64(1)))
            rest, bucket = rest[~here], bucket[~here]
        return out
