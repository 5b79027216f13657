"""Token ids of whole texts with the tokenizers library.

A byte-level tokenizer cuts a text into pieces before it looks them up, and no piece reaches over the
beginning of white space that follows something else. So a text is the sum of its units, runs of
white space with the word after them, and each distinct unit is encoded once by the library. In most texts each
blank stands alone, between other characters: these are split at their blanks and looked up by Arrow and numpy,
many texts at once. Tokenizers that are built otherwise get each text whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tarmac.llm.remembered import Remembering, begin, give_back, kept_for, runs

ID = np.dtype("<u4")

# White space as tokenizers count it; Python's \s has four characters more.
_UNIT = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


class Encoder(Remembering):
    """Texts to ids as bytes, little-endian unsigned 32-bit, with an id at the end of each.

    A text that holds the string of an added token goes to the library whole, which puts the token's id in
    its place. A null text is an empty one.
    """

    AT_ONCE = 4_000_000  # characters
    JOINED = 200  # units in one text

    def __init__(self, path: str, end_id: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], ID).tobytes()
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        added = sorted((t["content"] for t in parts.get("added_tokens", [])), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        before = parts.get("pre_tokenizer") or {}
        self.in_units = (
            parts.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
        )
        # characters of a byte-level token are bytes
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units. Many go to the library in one text and are told apart by their bytes:
        where one that ends in no white space is followed by one that begins with a blank."""
        fits = np.fromiter((u[0] == " " and not u[-1].isspace() for u in units), bool, len(units))
        joined = list(compress(units, fits))
        parts = ["".join(joined[k : k + self.JOINED]) for k in range(0, len(joined), self.JOINED)]
        found = [np.array(x.ids, ID) for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        ids = np.concatenate([np.empty(0, ID), *found])
        ends = np.cumsum(pc.binary_length(pa.array(joined, pa.large_string())).to_numpy())
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        alone = [np.frombuffer(i, ID) for i in self._library(list(compress(units, ~fits)))]
        sizes = np.empty(len(units), np.int64)
        sizes[fits], sizes[~fits] = np.diff(cuts, prepend=0), list(map(len, alone))
        # those alone come last; in the order of the units
        begins = np.empty(len(units), np.int64)
        order = np.concatenate([np.flatnonzero(fits), np.flatnonzero(~fits)])
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([ids, *alone])[runs(begins, sizes)], sizes

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, ID).tobytes() for x in found]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size >= self.AT_ONCE:
                yield from self._encode(part)
                part, size = [], 0
                give_back()  # a part takes many times its size while its units are told apart
        yield from self._encode(part)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        if not self.in_units:
            for ids in self._library(texts):
                yield ids + self.end
            return
        marked = [k for k, text in enumerate(texts) if self.added and self.added.search(text)]
        found = dict(zip(marked, self._library([texts[k] for k in marked])))
        rest = [k for k in range(len(texts)) if k not in found]
        others = []
        for k, ids in zip(rest, self._split([texts[k] for k in rest])):
            if ids is None:
                others.append(k)
            else:
                found[k] = ids
        units = [_UNIT.findall(texts[k]) for k in others]
        coded = pa.array(list(chain.from_iterable(units)), pa.large_string()).dictionary_encode()
        starts = np.cumsum([0, *map(len, units)])
        found.update(zip(others, self._of_texts(coded.dictionary, coded.indices.to_numpy(), starts)))
        for k in range(len(texts)):
            yield found[k] + self.end

    def _split(self, texts: list[str]) -> list[bytes | None]:
        """Ids of the texts in which each blank stands alone, None for others; a unit is what stands before the first
        blank, or a blank and what stands between it and the next one."""
        if not texts:
            return []
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = parts.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(parts.flatten())
        codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        # white space beside a blank: a word that is empty, or begins with some, or ends with some and isn't the last
        before = (pc.binary_length(words).to_numpy() == 0) | _spaces(pc.utf8_slice_codeunits(words, 0, 1))
        after = _spaces(pc.utf8_slice_codeunits(words, -1))[codes]
        after[starts[1:] - 1] = False
        alone = ~np.logical_or.reduceat(before[codes] | after, starts[:-1])
        if not alone.any():
            return [None] * len(texts)
        sizes = np.diff(starts)
        codes = codes[np.repeat(alone, sizes)]
        starts = np.concatenate([[0], np.cumsum(sizes[alone])])
        # the first of a text has no blank before it
        first = starts[:-1]
        leading, place = np.unique(codes[first], return_inverse=True)
        codes[first] = len(words) + place
        none, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        units = pa.concat_arrays([pc.binary_join_element_wise(none, words, blank), words.take(pa.array(leading))])
        used = np.flatnonzero(np.bincount(codes, minlength=len(units)))
        number = np.zeros(len(units), np.int64)
        number[used] = np.arange(len(used))
        some = iter(self._of_texts(units.take(pa.array(used)), number[codes], starts))
        return [next(some) if there else None for there in alone.tolist()]


def _spaces(characters: pa.Array) -> np.ndarray:
    """Which of the characters are white space; of these there are few different ones."""
    coded = characters.dictionary_encode()
    return np.array([c.isspace() for c in coded.dictionary.to_pylist()], bool)[coded.indices.to_numpy()]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One per process."""
    begin("encode")
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


kept_for("encode", _ENCODERS.clear)
