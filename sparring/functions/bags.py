"""What Spark's forests draw for the rows of a partition: bootstrap counts, tree by tree, and a sample for thresholds.

The counts are Poisson(1) numbers of the generator WELL19937c (Panneton, L'Ecuyer, Matsumoto 2006), seeded by partition.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np

_WORDS = 624
# A word depends on its predecessor and on words at least this far back, so as many are prepared at once.
_STRIDE = 70
_BLOCKS = 500  # of each such stretch


def _first_words(seed: int) -> np.ndarray:
    v = [seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF]
    for i in range(2, _WORDS):
        last = v[i - 2] - ((v[i - 2] & 0x80000000) << 1)
        v.append((1812433253 * (last ^ (last >> 30)) + i) & 0xFFFFFFFF)
    return np.array(v, np.uint32)


def _step(z: np.ndarray) -> np.ndarray:
    """What a word gives to the next one; linear, so that its halves can be looked up."""
    y = z ^ (z << np.uint32(25))
    return (y << np.uint32(9)) ^ (y >> np.uint32(21))


def _uniforms(seed: int) -> Iterator[list[float]]:
    """Numbers in [0, 1) with 52 bits."""
    halves = np.arange(65536, dtype=np.uint32)
    low, high = _step(halves).tolist(), _step(halves << np.uint32(16)).tolist()
    v = _first_words(seed)
    last, size = int(v[0]), _STRIDE * _BLOCKS
    past = np.empty(_WORDS + size, np.uint32)
    past[:_WORDS] = np.roll(v[::-1], 1)
    out = np.empty(size, np.uint32)
    while True:
        for s in range(0, size, _STRIDE):
            def back(n: int) -> np.ndarray:
                at = _WORDS + s - n
                return past[at : at + _STRIDE]

            near, mid, far = back(70), back(179), back(449)
            a = near ^ (near >> 27)
            z2 = (mid >> 9) ^ far ^ (far >> 1)
            c = a ^ z2
            z0 = (back(623) & 0x80000000) | (back(622) & 0x7FFFFFFF)
            rest = z0 ^ a ^ (a << 9) ^ z2 ^ (z2 << 21) ^ c ^ (c >> 21)
            words = [last]
            for b in rest.tolist():
                last = b ^ low[last & 65535] ^ high[last >> 16]
                words.append(last)
            z = np.array(words, np.uint32)
            past[_WORDS + s : _WORDS + s + _STRIDE] = z[:-1] ^ (z[:-1] << 25) ^ c
            out[s : s + _STRIDE] = z[1:]
        past[:_WORDS] = past[size:].copy()
        w = out ^ ((out << 7) & 0xE46E1700)
        w = (w ^ ((w << 15) & 0x9B868000)) >> 6
        pairs = w.astype(np.int64).reshape(-1, 2)
        yield ((pairs[:, 0] << 26 | pairs[:, 1]) * 2.0**-52).tolist()


def poisson_ones(seed: int) -> Iterator[int]:
    """An endless row of Poisson numbers of mean 1."""
    limit, n, product = math.exp(-1.0), 0, 1.0
    for block in _uniforms(seed):
        for u in block:
            product *= u
            if product >= limit:
                n += 1
            else:
                yield n
                n, product = 0, 1.0


_LONG = 0xFFFFFFFFFFFFFFFF


def _hashed(words: tuple[int, int], seed: int) -> int:
    """MurmurHash3 of two 32-bit words."""
    h = seed
    for k in words:
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


class _XorShift:
    """The generator that Spark samples rows with."""

    def __init__(self, seed: int) -> None:
        swapped = (seed & _LONG).to_bytes(8, "big")
        words = int.from_bytes(swapped[:4], "little"), int.from_bytes(swapped[4:], "little")
        low = _hashed(words, 0x3C074A61)
        self.state = _hashed(words, low) << 32 | low

    def bits(self, n: int) -> int:
        s = self.state
        s ^= s << 21 & _LONG
        s ^= s >> 35
        s ^= s << 4 & _LONG
        self.state = s
        return s & ((1 << n) - 1)

    def uniform(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


def _partition_seed(seed: int, partition: int) -> int:
    """The seed of a partition's sample: numbers of `java.util.Random`, one by one."""
    state, mask = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), (1 << 48) - 1
    words = []
    for _ in range(2 * partition + 2):
        state = (state * 0x5DEECE66D + 0xB) & mask
        words.append(state >> 16)
    high, low = words[-2:]
    return (high << 32) + (low - ((low & 0x80000000) << 1)) & _LONG


def sampled(share: float, seed: int, partition: int) -> Iterator[bool]:
    """Which rows of a partition Spark's forests take for thresholds, an endless row."""
    first = _XorShift(seed).bits(32)
    rng = _XorShift(_partition_seed(first - ((first & 0x80000000) << 1), partition))
    if share >= 1.0:
        yield from itertools.repeat(True)
    if share > 0.4:
        while True:
            yield rng.uniform() <= share
    rest = math.log1p(-share)
    while True:
        for _ in range(int(math.log(max(rng.uniform(), 5e-11)) / rest)):
            yield False
        yield True
