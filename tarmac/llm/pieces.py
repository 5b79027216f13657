"""SentencePiece encoding and decoding, with the pieces in one Aho-Corasick automaton.

A text is normalised as its model says. One pass over the automaton then gives, at each position, the
pieces that end there, the longest first along the output links; each of them relaxes the best
score of the position from the best score of the place where it begins. A character that no piece
holds is unknown and becomes its bytes.

In a unigram model the score of a piece is its log probability and every piece may follow every other. In a
byte-pair model scores are merge ranks, and merging leaves only some pieces next to each
other: the pass then relaxes only from a piece to one that merging the two leaves as they are, and
the ids are those of the library.

If no piece has a blank mark after a letter, a text is the sum of its words and each distinct word is
searched once. Null texts are empty and have no ids. Other columns are left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from tarmac.llm.encode import ID
from tarmac.llm.remembered import Remembering, begin, by_size, kept_for

AT_ONCE = 4_000_000  # bytes of text

BLANK = "▁"
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
UNKNOWN_PENALTY = 10.0

# Field numbers and model types of the model file.
TRAINER_SPEC, NORMALIZER_SPEC, MODEL_TYPE, ADD_DUMMY_PREFIX = 2, 3, 3, 3
UNIGRAM, BPE = 1, 2


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
            yield tag >> 3, value
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            yield tag >> 3, raw[at : at + size]
            at += size


class Model(Remembering):
    """Encodes and decodes with one model file; remembers words, and which pieces fit each other."""

    LIMIT = 450_000
    PAIRS = 600_000

    def __init__(self, model_file: str | None = None, proto: bytes | None = None):
        super().__init__()
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file, model_proto=proto)
        top = {}
        for field, value in fields(self.library.serialized_model_proto()):
            if field in (TRAINER_SPEC, NORMALIZER_SPEC):
                top[field] = dict(fields(value))
        self.kind = top.get(TRAINER_SPEC, {}).get(MODEL_TYPE, UNIGRAM)
        self.prefix = bool(top.get(NORMALIZER_SPEC, {}).get(ADD_DUMMY_PREFIX, 1))
        sp = self.library
        self.names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.scores = [sp.get_score(i) for i in range(sp.get_piece_size())]
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(len(self.names)) if sp.is_byte(i)}
        plain = [
            i for i in range(len(self.names))
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        ]
        self.ids = {self.names[i]: i for i in plain}
        self.singles = {name for name in self.ids if len(name) == 1}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.names[i], (i, len(self.names[i])))
        self.automaton.make_automaton()
        self.unknown_score = min((self.scores[i] for i in plain), default=0.0) - UNKNOWN_PENALTY
        self.by_word = not any(BLANK in name.lstrip(BLANK) for name in self.ids)
        self.fits: dict[int, bool] = {}  # both pieces in one number
        byte_of = {i: b for b, i in self.bytes.items()}
        silent = {i for i in range(len(self.names)) if sp.is_control(i)}
        self.spelt = [
            b"" if i in silent else bytes([byte_of[i]]) if i in byte_of else b" \xe2\x81\x87 " if sp.is_unknown(i)
            else name.replace(BLANK, " ").encode() for i, name in enumerate(self.names)
        ]

    def search(self, word: str) -> list[int]:
        """Ids of the best way to spell a normalised word with pieces: one pass of the automaton."""
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        last = [-1] * (n + 1)  # piece that ends here; -1: none, or an unknown character
        best[0] = 0.0
        scores, fits = self.scores, self.fits
        unknown = [] if self.singles.issuperset(word) else [k for k, c in enumerate(word) if c not in self.singles]
        if self.kind == BPE:
            for at, (piece, length) in self.automaton.iter(word):
                end = at + 1
                if best[end] is not None:  # one spelling at most survives merging
                    continue
                while unknown and unknown[0] <= at:
                    self._relax_unknown(unknown.pop(0), best)
                start = end - length
                before = best[start]
                if before is None:
                    continue
                left = last[start]
                if left >= 0:
                    fit = fits.get(left << 32 | piece)
                    if not (self._fit(left, piece) if fit is None else fit):
                        continue
                best[end], last[end] = before + scores[piece], piece
        else:
            for at, (piece, length) in self.automaton.iter(word):
                while unknown and unknown[0] <= at:
                    self._relax_unknown(unknown.pop(0), best)
                before = best[at + 1 - length]
                if before is not None:
                    score = before + scores[piece]
                    if best[at + 1] is None or score > best[at + 1]:
                        best[at + 1], last[at + 1] = score, piece
        for k in unknown:
            self._relax_unknown(k, best)
        out: list[int] = []
        end = n
        while end:
            piece = last[end]
            if piece >= 0:
                out.append(piece)
                end -= len(self.names[piece])
                continue
            end -= 1
            if self.bytes:
                out.extend(self.bytes[b] for b in reversed(word[end].encode()))
            else:
                out.append(self.library.unk_id())
        return out[::-1]

    def _relax_unknown(self, at: int, best: list) -> None:
        """A character that is no piece of its own may be unknown."""
        if best[at] is not None and best[at + 1] is None:
            best[at + 1] = best[at] + self.unknown_score

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging leaves two pieces next to each other as they are."""
        if len(self.fits) >= self.PAIRS:
            self.fits.clear()
        a, b = self.names[left], self.names[right]
        parts = list(a + b)
        ids, scores = self.ids, self.scores
        while len(parts) > 1:
            best, at = -math.inf, -1
            for k in range(len(parts) - 1):
                piece = ids.get(parts[k] + parts[k + 1])
                if piece is not None and scores[piece] > best:
                    best, at = scores[piece], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        fit = self.fits[left << 32 | right] = parts == [a, b]
        return fit

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.search(word) for word in units]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), ID, int(sizes.sum())), sizes

    def encode(self, text: str | None) -> bytes:
        """Ids as bytes, little-endian unsigned 32-bit."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as bytes."""
        normal = [self.library.normalize(text or "") for text in texts]
        words = [_WORD.findall(n) for n in normal] if self.by_word else [[n] for n in normal]
        coded = pa.array(list(chain.from_iterable(words)), pa.large_string()).dictionary_encode()
        return self._of_texts(coded.dictionary, coded.indices.to_numpy(), np.cumsum([0, *map(len, words)]))

    def decode(self, ids: bytes) -> str:
        """The text that ids spell; bytes that are no characters become replacement marks."""
        spelt = self.spelt
        text = b"".join([spelt[i] for i in np.frombuffer(ids, ID).tolist()]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """One per process."""
    begin("pieces")
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


kept_for("pieces", _MODELS.clear)


def spelt(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ``ids`` (bytes) of each row and ``text``, what they spell, in one pass of one process.

    Results leave in batches of a bounded size, however many rows a batch of texts has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = batch.column("text")
            for at, end in by_size(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), AT_ONCE):
                ids = own.encode_all(texts.slice(at, end - at).to_pylist())
                spelled = pa.array([own.decode(i) for i in ids], pa.string())
                doc_ids = batch.column("doc_id").slice(at, end - at)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.binary()), spelled], ["doc_id", "ids", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, text string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids`` (bytes) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = batch.column("text")
            for at, end in by_size(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), AT_ONCE):
                ids = pa.array(own.encode_all(texts.slice(at, end - at).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, end - at), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the ``text`` that they spell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model(path).decode
        for batch in batches:
            texts = pa.array([decode(i or b"") for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), texts], ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
