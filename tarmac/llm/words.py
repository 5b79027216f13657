"""Hashes of words and of runs of words, the same in every process."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

from tarmac.llm.remembered import kept_for

SHINGLE = 5

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_1
        x = (x ^ (x >> np.uint64(27))) * _MIX_2
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash; remembers so many words at most."""

    LIMIT = 150_000

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = value
        return value


HASHES = WordHashes()
kept_for("words", HASHES.clear)


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text after text, and where each text begins.

    Words are what lies between white space. A text of fewer words, but at least one, is one
    run; a text without words has none. Runs that occur several times are there several times.
    """
    words = [text.split() for text in texts]
    counts = np.fromiter((len(w) for w in words), np.int64, len(words))
    hashes = np.fromiter(map(HASHES.__getitem__, chain.from_iterable(words)), np.uint64, int(counts.sum()))
    begins = np.concatenate([[0], np.cumsum(counts)])
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(int(starts[-1]), np.uint64)
    with np.errstate(over="ignore"):
        if len(hashes) >= size:
            rolled = hashes[: len(hashes) - size + 1].copy()
            for i in range(1, size):
                rolled = rolled * _FACTOR + hashes[i : len(hashes) - size + 1 + i]
        for k in np.flatnonzero(runs):
            a, n = begins[k], counts[k]
            if n >= size:
                out[starts[k] : starts[k + 1]] = rolled[a : a + n - size + 1]
            else:
                value = np.uint64(n)
                for h in hashes[a : a + n]:
                    value = value * _FACTOR + h
                out[starts[k]] = value
    return mixed(out), starts
