"""Minimal perfect hashes of sets of words, and looking words up in them by the thousand.

A level is a row of bits. Each key has a bit in it, by its hash; where it is alone the bit is set, the others go
on to the next level. A key's slot is the number of set bits before its own, so the slots of n keys are 0 to n - 1
and take a few bits a key. Any other word has a slot as well, or none; the keys are therefore stored by slot, and a
word is found only if it equals the key of its slot. Keys whose 64-bit hashes are equal have slots by name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tarmac.llm.words import mixed

LEVELS = 32
BITS_PER_KEY = 1.5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _places(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mixed(h + _STEP * np.uint64(level + 1)) % np.uint64(bits)).astype(np.int64)


def build(words: list[bytes]) -> tuple[list[int], list[bytes], list[bytes]]:
    """Bits of each level, the levels packed, and the distinct words in order of their slots."""
    rest = np.array(sorted(set(words)), object)
    h = hashes(rest.tolist())
    sizes, levels, by_slot = [], [], []
    while len(rest) and len(levels) < LEVELS:
        bits = max(8, int(len(rest) * BITS_PER_KEY))
        places = _places(h, len(levels), bits)
        alone = np.bincount(places, minlength=bits) == 1
        placed = alone[places]
        by_slot.extend(rest[placed][np.argsort(places[placed])])
        sizes.append(bits)
        levels.append(np.packbits(alone).tobytes())
        rest, h = rest[~placed], h[~placed]
    return sizes, levels, [*by_slot, *rest]


class PerfectHash:
    """A set of words made by ``build``, to look words up in."""

    def __init__(self, sizes: list[int], levels: list[bytes], by_slot: pa.Array):
        self.keys = by_slot
        self.levels = []
        before = 0
        for size, packed in zip(sizes, levels):
            bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=size)
            rank = np.cumsum(bits, dtype=np.int64)
            self.levels.append(np.where(bits, rank - 1 + before, -1))
            before += int(rank[-1])
        self.named = {word: slot for slot, word in enumerate(by_slot[before:].to_pylist(), before)}

    def slots(self, words: pa.Array, h: np.ndarray) -> np.ndarray:
        """The slot of each of the words, whose hashes are given; -1 where it is no key."""
        out = np.full(len(words), -1, np.int64)
        left = np.arange(len(words))
        for level, slot_at in enumerate(self.levels):
            found = slot_at[_places(h[left], level, len(slot_at))]
            out[left] = found
            left = left[found < 0]
        hit = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[hit])), words.take(pa.array(hit)))
        out[hit[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.named:
            for k in np.flatnonzero(out < 0):
                out[k] = self.named.get(words[k].as_py(), -1)
        return out
