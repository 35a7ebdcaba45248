"""Words as numbers: each distinct token of a text is looked at once, and texts become arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class WordTable(dict):
    """token -> row number; the rows hold a 64-bit hash and small facts of the token. Emptied when over ``bound`` tokens."""

    def __init__(self, describe: Callable[[str], tuple[str, int]] = lambda token: (token, 0), bound: int = 250_000):
        self.describe, self.bound = describe, bound
        self.hashes = np.zeros(1 << 14, np.uint64)
        self.facts = np.zeros(1 << 14, np.int32)

    def __missing__(self, token: str) -> int:
        row = len(self)
        if row >= len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        word, fact = self.describe(token)
        self.hashes[row] = xxhash.xxh64_intdigest(word)
        self.facts[row] = fact
        self[token] = row
        return row

    def read(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and facts of the tokens."""
        if len(self) > self.bound:
            self.clear()
        rows = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return self.hashes[rows], self.facts[rows]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out = (out + words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return mix(out)
