"""What a Python process remembers between batches, within bounds.

Spark keeps its Python processes and gives them tasks of one operator after another. Each cache here belongs to an
operator and is emptied as soon as the process begins a task of another one, so that the caches of
several operators never add up. What was freed then goes back to the machine: else a process that once held much
keeps it beside all that its executor needs later.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CLEARS: dict[str, list[Callable[[], None]]] = {}
_NOW = [""]


def kept_for(operator: str, clear: Callable[[], None]) -> None:
    """Names what empties a cache of an operator."""
    _CLEARS.setdefault(operator, []).append(clear)


def begin(operator: str) -> None:
    """To be called where a task of an operator begins."""
    if _NOW[0] != operator:
        _NOW[0] = operator
        for other, clears in _CLEARS.items():
            if other != operator:
                for clear in clears:
                    clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Returns free memory of this process, Python's and Arrow's, to the machine."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def by_size(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes sum to at most ``most``, or of one item."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + most, "right")))
        yield at, end
        at = end


def runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs, one after another: each begins somewhere and has a size."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(sizes.sum())


class Units:
    """Distinct units of text and the ids of each, as columns: many are looked up at once, and one
    takes a fraction of the memory that an entry of a dictionary takes."""

    def __init__(self):
        self.units = pa.array([], pa.large_string())
        self.ids, self.begins, self.sizes = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.units)

    def places(self, units: pa.Array) -> np.ndarray:
        """Where each of the units is, -1 for none."""
        if not len(self):
            return np.full(len(units), -1)
        return pc.fill_null(pc.index_in(units, value_set=self.units), -1).to_numpy().astype(np.int64)

    def add(self, units: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.units = pa.concat_arrays([self.units, units])
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])


class Remembering:
    """Remembers the ids of units that ``_units`` finds; of a full memory, what occurs again stays."""

    LIMIT = 300_000  # units remembered, and as many of those before that
    LONGEST = 64  # of longer ones none is

    def __init__(self):
        self.known, self.before = Units(), Units()

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after another, and how many each has."""
        raise NotImplementedError

    def _known(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each of the distinct units begin and how many they are."""
        if len(self.known) > self.LIMIT:
            self.known, self.before = Units(), self.known
        known, before = self.known, self.before
        begins, sizes = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        at = known.places(units)
        there, rest = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        begins[there], sizes[there] = known.begins[at[there]], known.sizes[at[there]]
        others = units.take(pa.array(rest))
        at = before.places(others)
        there, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        begins[rest[there]], sizes[rest[there]] = len(known.ids) + before.begins[at[there]], before.sizes[at[there]]
        asked = others.take(pa.array(new))
        found = [self._units(asked.slice(k, 10_000).to_pylist()) for k in range(0, len(asked), 10_000)]
        ids = np.concatenate([known.ids, before.ids, *(f[0] for f in found)])
        if found:
            sizes[rest[new]] = own = np.concatenate([f[1] for f in found])
            begins[rest[new]] = len(known.ids) + len(before.ids) + np.cumsum(own) - own
        if len(rest):
            short = pc.less_equal(pc.utf8_length(others), self.LONGEST)
            rest = rest[short.to_numpy(zero_copy_only=False)]
            known.add(others.filter(short), ids[runs(begins[rest], sizes[rest])], sizes[rest])
        return ids, begins, sizes

    def _of_texts(self, units: pa.Array, codes: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Ids of texts as bytes; ``codes`` are the numbers of their units, of which each text has those from its start
        to that of the next."""
        ids, begins, sizes = self._known(units)
        lengths = sizes[codes]
        raw = ids[runs(begins[codes], lengths)].tobytes()
        cuts = (np.concatenate([[0], np.cumsum(lengths)])[starts] * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]
