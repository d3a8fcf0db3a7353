"""Word shingles and SetSketch registers of texts, vectorised over the texts of a batch.

SetSketch: every shingle drives a Poisson process whose arrivals fall on ``m`` registers
at random; a register keeps the earliest arrival x of all shingles, stored on an
exponential scale as floor(1 - log_b(x / a)), cut to 0 .. q + 1. Registers of a union
are the maxima of the registers, and two sets agree in a register with about the
probability of their Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
REGISTERS = 256  # a power of two
BASE, RATE, LIMIT = 1.001, 20.0, 65534  # b, a, q
CHUNK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte, the same for A-Z and a-z, and which bytes are space."""
    code = np.arange(256, dtype=np.uint64)
    folded = np.where((code >= 65) & (code <= 90), code + np.uint64(32), code)
    space = np.isin(code, [9, 10, 11, 12, 13, 32])
    return mix((folded + np.uint64(1)) * _ODD), space


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and their inverses."""
    odd = 0xD1342543DE82EF95
    ones = np.ones(1, np.uint64)
    up = np.cumprod(np.concatenate([ones, np.full(count, odd, np.uint64)]))
    down = np.cumprod(np.concatenate([ones, np.full(count, pow(odd, -1, 1 << 64), np.uint64)]))
    return up, down


class Shingler:
    """Distinct shingle hashes of texts given as UTF-8."""

    def __init__(self, width: int = SHINGLE):
        self.width = width
        self.values, self.space = byte_values()
        self.up, self.down = powers(0)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and the index of each word's text."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if len(data) >= len(self.up):
            self.up, self.down = powers(len(data))
        gap = self.space[data]
        edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[0::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        return hashes, np.searchsorted(firsts, starts, "right") - 1

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes per text; fewer words than the width make one shingle."""
        words, text = self.words(texts)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        many = max(0, len(words) - self.width + 1)
        rolled = words[:many].copy()
        for k in range(1, self.width):
            rolled = rolled * _ODD + words[k : many + k]
        rolled = mix(rolled)
        found = []
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if last - first >= self.width:
                found.append(np.unique(rolled[first : last - self.width + 1]))
            elif last > first:
                short = np.uint64(last - first)
                for w in words[first:last]:
                    short = np.uint64((int(short) * int(_ODD) + int(w)) & 0xFFFFFFFFFFFFFFFF)
                found.append(mix(np.array([short], np.uint64)))
            else:
                found.append(np.empty(0, np.uint64))
        return found


def sketch(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """SetSketch registers (sets x registers, uint16) of sets of 64-bit hashes."""
    low = np.full(len(sets) * registers, np.inf)
    state = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    time = np.zeros(len(state))
    step = 0
    while len(state):
        state = state + _ODD
        drawn = mix(state)
        time -= np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / registers
        np.minimum.at(low, owner * registers + (drawn & np.uint64(registers - 1)).astype(np.int64), time)
        step += 1
        if step <= 4 or step % 8 == 0:  # later arrivals of these shingles cannot be the earliest any more
            going = time < low.reshape(-1, registers).max(axis=1)[owner]
            state, owner, time = state[going], owner[going], time[going]
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(low / RATE) / np.log(BASE))
    return np.clip(level, 0, LIMIT + 1).astype(np.uint16).reshape(-1, registers)


def likely_similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes.

    The counts of registers that are higher left, higher right and equal have
    probabilities that depend on the similarity and the two sizes only.
    """
    registers = left.shape[1]
    above = (left > right).sum(axis=1)[:, None]
    below = (left < right).sum(axis=1)[:, None]
    equal = registers - above - below
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    most = (np.minimum(u, v) / np.maximum(u, v))
    grid = np.linspace(0, 1, 101)[None, :] * most

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * grid), p(v - u * grid)
    same = np.clip(1 - up - down, 1e-12, 1)
    value = above * np.log(np.maximum(up, 1e-12)) + below * np.log(np.maximum(down, 1e-12)) + equal * np.log(same)
    return np.take_along_axis(grid, value.argmax(axis=1)[:, None], axis=1)[:, 0]


def chunks(sizes: list[int], limit: int = CHUNK_BYTES):
    """Index ranges of consecutive texts of about ``limit`` bytes together."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)
