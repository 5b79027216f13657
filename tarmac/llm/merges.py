"""Byte-pair encoding of long unsplit text by a tree of halves, and decoding.

The library's normaliser and pre-tokenizer say how a text is split. What they leave unsplit is cut into
leaves of ``LEAF`` symbols. The leaves of all pieces of a batch are merged side by side, as the rows of one matrix:
a step merges in every row its pair of least rank. Neighbours are then joined level by level until one
sequence is left, all joins of a level side by side again. Batches run in parallel as Spark's tasks.

Joining looks at the tokens around the border only. The last token before it and the first after it are spelt out
and merged anew; if the result begins with the token that the window began with and ends with the one that it
ended with, both sides agree and nothing further out can change. A side that does not agree gets twice as
many tokens. This is exact: a sequence of tokens is what merging gives as soon as each two
neighbours are, and after a join every two neighbours were neighbours in one of the three encodings.

Texts that hold the string of an added token are cut there and the token's id stands in its place, as in the
library. A null or empty text has no ids and is decoded to "". Repeated rows and null ids are rows like any other;
other columns are left out.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tarmac.llm.remembered import begin, by_size, kept_for

ID = np.dtype("<i4")
LEAF = 16  # symbols
WIDEST = 64  # symbols of a window in a matrix; longer ones are merged one by one
AT_ONCE = 4_000_000  # bytes of text
FLUSH = 1_000_000  # ids in one batch of results

# White space as tokenizers count it; Python's \s has four characters more.
_BETWEEN_BLANKS = re.compile(r"[\S\x1c-\x1f]+")

# The splitting that drops white space, so that a text is the sum of what lies between.
_SPACES = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same over ASCII and Latin letters, which are normal as they are and have small letters among themselves.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
_PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]| |[^a-z0-9À-ÖØ-öø-ſ ]+")


class Merger:
    """The merges of one tokenizer file over sequences of symbols (single bytes as token ids)."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in merges]
        self.ranks: dict[int, int] = {}  # both ids in one number -> rank of their merge
        for rank, (a, b) in enumerate(pairs):
            self.ranks.setdefault(vocabulary[a] << 32 | vocabulary[b], rank)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], ID)  # by rank
        self.never = len(pairs)
        known = sorted(self.ranks)
        self._pairs = np.array([*known, 1 << 62])
        self._rank = np.array([*(self.ranks[k] for k in known), self.never], ID)
        self.symbols: dict[int, list[int]] = {}  # token -> the symbols it is made of
        for token, i in vocabulary.items():
            bare, end = (token[: -len(suffix)], suffix) if suffix and token.endswith(suffix) else (token, "")
            letters = [*bare[:-1], bare[-1:] + end]
            if all(letter in vocabulary for letter in letters):
                self.symbols[i] = [vocabulary[letter] for letter in letters]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``never`` where they don't merge; -1 is no token."""
        pairs = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self._pairs, pairs)
        at[(right < 0) | (self._pairs[at] != pairs)] = len(self._pairs) - 1
        return self._rank[at]

    def side_by_side(self, rows: np.ndarray) -> np.ndarray:
        """What merging makes of each row: the pair of least rank first, the leftmost of equal ones. -1 fills up."""
        out = np.full_like(rows, -1)
        place = np.arange(len(rows))
        column = np.arange(rows.shape[1])
        ranks = self._ranks_of(rows[:, :-1], rows[:, 1:]) if rows.shape[1] > 1 else np.empty((len(rows), 0), ID)
        while len(rows) and ranks.shape[1]:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            done = least == self.never
            if done.any():
                out[place[done], : rows.shape[1]] = rows[done]
                rows, ranks, place, at, least = (x[~done] for x in (rows, ranks, place, at, least))
                if not len(rows):
                    return out
            each = np.arange(len(rows))
            # what stands right of the merged pair moves up
            rows[each, at] = self.made[least]
            width = rows.shape[1]
            source = column[: width - 1] + (column[: width - 1] > at[:, None])
            rows = np.take_along_axis(rows, source, axis=1)
            ranks = np.take_along_axis(ranks, source[:, : width - 2] + (column[: width - 2] == at[:, None]), axis=1)
            if width > 2:
                before, behind = np.maximum(at - 1, 0), np.minimum(at, width - 3)
                ranks[each, before] = self._ranks_of(rows[each, before], rows[each, before + 1])
                ranks[each, behind] = self._ranks_of(rows[each, behind], rows[each, behind + 1])
        out[place, : rows.shape[1]] = rows
        return out

    def by_heap(self, ids: list[int]) -> list[int]:
        """The same for one long sequence, in n log n steps."""
        n = len(ids)
        ids = list(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(k: int) -> None:
            rank = self.ranks.get(ids[k] << 32 | ids[after[k]])
            if rank is not None:
                heapq.heappush(heap, (rank, k, ids[k], ids[after[k]]))

        for k in range(n - 1):
            offer(k)
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            right = after[k]
            if ids[k] != a or right >= n or ids[right] != b:
                continue  # merged in the meantime
            ids[k], ids[right] = int(self.made[rank]), -1
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
                offer(k)
            if before[k] >= 0:
                offer(before[k])
        return [i for i in ids if i >= 0]

    def merged(self, sequences: list[list[int]]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(sequences)
        short = [k for k, s in enumerate(sequences) if len(s) <= WIDEST]
        if short:
            rows = np.full((len(short), max(len(sequences[k]) for k in short)), -1, ID)
            for row, k in zip(rows, short):
                row[: len(sequences[k])] = sequences[k]
            for k, row in zip(short, self.side_by_side(rows).tolist()):
                out[k] = [i for i in row if i >= 0]
        for k, s in enumerate(sequences):
            if len(s) > WIDEST:
                out[k] = self.by_heap(s)
        return out

    def joined(self, sides: list[tuple[list[int], list[int]]]) -> list[list[int]]:
        """The encodings of pieces from those of their two halves."""
        out: list[list[int]] = [[]] * len(sides)
        sizes = [(1, 1)] * len(sides)  # tokens of each side in the window
        open_ = list(range(len(sides)))
        while open_:
            windows = []
            for k in open_:
                left, right = sides[k]
                i, j = sizes[k] = min(sizes[k][0], len(left)), min(sizes[k][1], len(right))
                windows.append([s for token in left[len(left) - i :] + right[:j] for s in self.symbols[token]])
            apart = []
            for k, window in zip(open_, self.merged(windows)):
                (left, right), (i, j) = sides[k], sizes[k]
                left_agrees = i == len(left) or window[0] == left[-i]
                right_agrees = j == len(right) or window[-1] == right[j - 1]
                if left_agrees and right_agrees:
                    out[k] = left[: len(left) - i] + window + right[j:]
                else:
                    sizes[k] = (i if left_agrees else 2 * i), (j if right_agrees else 2 * j)
                    apart.append(k)
            open_ = apart
        return out

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Token ids of pieces, whose symbols follow each other: all leaves first, then all joins of each level."""
        ends = np.cumsum(lengths)
        leaves = -(-lengths // LEAF)
        owner = np.repeat(np.arange(len(lengths)), leaves)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(leaves) - leaves, leaves)
        begin = (ends - lengths)[owner] + nth * LEAF
        size = np.minimum(ends[owner] - begin, LEAF)
        places = begin[:, None] + np.arange(LEAF)
        rows = np.where(np.arange(LEAF) < size[:, None], symbols[np.minimum(places, len(symbols) - 1)], -1).astype(ID)
        rows = self.side_by_side(rows) if len(rows) else rows
        raw = rows[rows >= 0].tobytes()
        edges = np.concatenate([[0], np.cumsum((rows >= 0).sum(axis=1))]) * ID.itemsize
        starts = np.concatenate([[0], np.cumsum(leaves)])
        edges_of = edges[starts].tolist()
        out = [raw[a:b] for a, b in zip(edges_of, edges_of[1:])]
        parts = {
            k: [np.frombuffer(raw[edges[i] : edges[i + 1]], ID).tolist() for i in range(starts[k], starts[k + 1])]
            for k in np.flatnonzero(leaves > 1).tolist()
        }
        while True:
            sides = [(k, i) for k, ids in parts.items() for i in range(0, len(ids) - 1, 2)]
            if not sides:
                break
            new: dict[int, list[list[int]]] = {}
            for (k, _), ids in zip(sides, self.joined([(parts[k][i], parts[k][i + 1]) for k, i in sides])):
                new.setdefault(k, []).append(ids)
            parts |= {k: ids + (parts[k][-1:] if len(parts[k]) % 2 else []) for k, ids in new.items()}
        for k, ids in parts.items():
            out[k] = np.array(ids[0], ID).tobytes()
        return out


class Codec:
    """Encodes and decodes with one tokenizers file; remembers what lies between blanks."""

    LIMIT = 300_000  # of these, and of unsplit pieces
    LONGEST = 64  # characters; of longer ones none is remembered

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model = parts["model"]
        unknown = [name for name in ("dropout", "unk_token", "continuing_subword_prefix") if model.get(name)]
        unknown += [name for name in ("byte_fallback", "ignore_merges") if model.get(name)]
        if model["type"] != "BPE" or unknown or parts.get("post_processor") or parts.get("decoder"):
            raise ValueError(f"not a plain byte-pair file: {model['type']} {unknown}")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        suffix = model.get("end_of_word_suffix") or ""
        self.merger = Merger(model["vocab"], model["merges"], suffix)
        # the characters that stand for bytes, in the order of the bytes
        names = [_byte_name(byte) for byte in range(256)]
        if any(n not in model["vocab"] or n + suffix not in model["vocab"] for n in names):
            raise ValueError("not every byte is a token")
        self.byte_of = {name: byte for byte, name in enumerate(names)}
        self.inner = np.array([model["vocab"][name] for name in names], ID)
        self.final = np.array([model["vocab"][name + suffix] for name in names], ID)
        added = {t["content"]: t for t in parts.get("added_tokens", [])}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added.values()):
            raise ValueError("added tokens that take their surroundings into account")
        self.added = {content: ID.type(t["id"]).tobytes() for content, t in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.added_at = re.compile("|".join(map(re.escape, longest_first))) if added else None
        # a text is the sum of what lies between blanks only if blanks are dropped
        steps = (parts.get("normalizer") or {}).get("normalizers")
        split = ((parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        dropped = split.get("behavior") == "Removed" and split.get("invert") and split["pattern"] == {"Regex": _WORDS}
        self.by_blanks = bool(steps == _SPACES and dropped)
        self.names = {i: token for token, i in model["vocab"].items()} | {t["id"]: c for c, t in added.items()}
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str | bytes, bytes] = {}

    def _split(self, units: list[str]) -> list[list[str | bytes]]:
        """The unsplit pieces of each text: bytes, or text where that is plain."""
        if not self.by_blanks:
            return [self._split_by_library(unit) for unit in units]
        plain = [bool(_PLAIN.fullmatch(unit)) for unit in units]
        pieces: list[list[str | bytes]] = [[]]
        for word in _PLAIN_WORDS.findall(" ".join(compress(units, plain)).lower()):
            if word == " ":
                pieces.append([])
            else:
                pieces[-1].append(word)
        of_plain = iter(pieces)
        return [next(of_plain) if p else self._split_by_library(unit) for unit, p in zip(units, plain)]

    def _split_by_library(self, unit: str) -> list[str | bytes]:
        normal = self.normalizer.normalize_str(unit) if self.normalizer else unit
        pieces = self.splitter.pre_tokenize_str(normal) if self.splitter else [(normal, None)]
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in pieces if piece]

    def _encode_units(self, units: list[str]) -> Iterator[bytes]:
        split = self._split(units)
        known = self.pieces
        distinct = set(chain.from_iterable(split))
        if len(known) + len(distinct) > self.LIMIT:
            known = self.pieces = {piece: known[piece] for piece in distinct if piece in known}
        new = [piece for piece in distinct if piece not in known]
        raws = [piece.encode() if isinstance(piece, str) else piece for piece in new]
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        raw = np.frombuffer(b"".join(raws), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[raw[ends]]
        some = {}
        for piece, ids in zip(new, self.merger.encode(symbols, lengths)):
            (known if len(piece) <= self.LONGEST else some)[piece] = ids
        of = (lambda p: known[p] if p in known else some[p]) if some else known.__getitem__
        return (of(pieces[0]) if len(pieces) == 1 else b"".join(map(of, pieces)) for pieces in split)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, those of added tokens where a text has their string."""
        units = [self._cut(text or "") for text in texts]
        distinct = {u for found in units for u in found}
        if len(self.known) + len(distinct) > self.LIMIT:  # what occurs again stays
            self.known = {u: self.known[u] for u in distinct if u in self.known}
        known, some = self.known, dict(self.added)
        new = [u for u in distinct if u not in known and u not in some]
        for k in range(0, len(new), 50_000):
            for unit, ids in zip(new[k : k + 50_000], self._encode_units(new[k : k + 50_000])):
                (known if len(unit) <= self.LONGEST else some)[unit] = ids
        if len(some) > len(self.added) or any(t in distinct for t in self.added):
            return [np.frombuffer(b"".join([known[u] if u in known else some[u] for u in found]), ID) for found in units]
        return [np.frombuffer(b"".join(map(known.__getitem__, found)), ID) for found in units]

    def _cut(self, text: str) -> list[str]:
        if self.added_at is None or not self.added_at.search(text):
            return self._between_blanks(text)
        out, at = [], 0
        for match in self.added_at.finditer(text):
            out += self._between_blanks(text[at : match.start()])
            out.append(match[0])
            at = match.end()
        return out + self._between_blanks(text[at:])

    def _between_blanks(self, text: str) -> list[str]:
        return _BETWEEN_BLANKS.findall(text) if self.by_blanks else [text] if text else []

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' names, special ones too, with a blank between: such files have no decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _byte_name(byte: int) -> str:
    """The character that stands for a byte. Those that print are themselves, the others, in order,
    the characters from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(byte) if byte in prints else chr(256 + byte - sum(p < byte for p in prints))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per process."""
    begin("merges")
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


kept_for("merges", _CODECS.clear)


def spelt(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ``ids`` of the text and ``decoded``, the text that they spell, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column("text")
            for begin_, end in by_size(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), AT_ONCE):
                ids = own.encode(texts.slice(begin_, end - begin_).to_pylist())
                yield from results(batch.column("doc_id").slice(begin_, end - begin_), ids, own)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def results(doc_ids: pa.Array, ids: list[np.ndarray], own: Codec) -> Iterator[pa.RecordBatch]:
    at, held = 0, 0
    for k in range(len(ids)):
        held += len(ids[k])
        if held < FLUSH and k + 1 < len(ids):
            continue
        part = ids[at : k + 1]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in part])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part).astype(np.int32), pa.int32()))
        texts = pa.array([own.decode(p) for p in part], pa.string())
        yield pa.RecordBatch.from_arrays([doc_ids.slice(at, k + 1 - at), lists, texts], ["doc_id", "ids", "decoded"])
        at, held = k + 1, 0
