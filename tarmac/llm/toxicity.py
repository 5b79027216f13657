"""Toxicity of texts whose words may be disguised.

What was written is taken for a noisy copy of what was meant: letters replaced by digits and
marks that look alike, letters repeated, words spaced out or cut by marks. A word that shows
any of this becomes a lattice of what each character may stand for, and a Viterbi search under
a language model of characters (trigrams, counted over all documents) finds the likeliest
original. A word of plain letters has one path only and is not searched. There is no length that
is not searched; words glued by marks are also searched each by itself.

Restored words are scored with terms learnt from labels: whole words and their first four or
five letters, each with the share of toxic documents among those that hold it. To learn a
term takes proof that copies of one document don't give: its neighbours must differ. Terms
combine as independent causes.

Null and empty texts get the score of a text without any term. Labels that are null, and labels
of documents that are missing, teach nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.remembered import begin

# Symbols of the character model: 0 space, 1 anything else, then letters.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
CODES = {c: i + 2 for i, c in enumerate(LETTERS)} | {c: 0 for c in " \t\n\r"}
N_SYMBOLS = 64

# What a disguised character may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l", "¡": "i", "×": "x", "µ": "u",
}
CUTS = ".,;:-_*'\"/\\~^`#&%=<>[]{}()!?+|$@"  # marks that may also mean nothing

COST_LOOKS_LIKE = 0.7
COST_CUT = 0.4
COST_FOLD = 0.5  # a run of the same letter written for one or two
COST_JOIN = 0.1  # a blank within a spaced word
COST_BLANK = 4.0  # a blank that is meant, among letters that stand alone

LETTER, DOUBLED, BLANK = re.compile(r"[^\W\d_]"), re.compile(r"([^\W\d_])\1"), re.compile(r"[ \t]")
MARK_BEFORE, MARK_AFTER = re.compile(r"[\d@$!+|(€£¡×µ]"), re.compile(r"[\d@$!+|(€£¡×µ.,;:\-_*'/~^&%#]")
GLUE = re.compile(r"[.,;:\-_*'\"/\\~^`#&%=<>\[\]{}]+")  # marks that look like no letter and may stand between words
PLAIN_EDGES = CUTS + " "
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")

LABELLED = 24_000  # labelled rows that terms are learnt from, at most
MIN_PRECISION = 0.9
MIN_PROOF = 0.5  # lower bound of the precision, at Z standard errors
Z = 2.5
SURE = 5  # letters of a term that is looked for anywhere among spaced letters
LEAK = 0.01
CUT_OFF = 0.3


# --- The character model -----------------------------------------------------------------


_TABLE = np.ones(0x250, np.int64)
for _char, _code in CODES.items():
    _TABLE[ord(_char)] = _code


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    return _TABLE[np.minimum(points, len(_TABLE) - 1)]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin("toxicity")
    total = np.zeros(N_SYMBOLS**3, np.int64)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for k in range(0, len(texts), 500):
            x = symbols(" " + "  ".join(t for t in texts[k : k + 500] if t) + " ")
            total += np.bincount((x[:-2] * N_SYMBOLS + x[1:-1]) * N_SYMBOLS + x[2:], minlength=len(total))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["trigram", "times"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Costs (negative log probabilities) of a symbol after two others.

    Each task sends at most N_SYMBOLS ** 3 counts, and as many come back in all.
    """
    rows = docs.select("text").mapInArrow(_trigrams, "trigram long, times long").groupBy("trigram").agg(F.sum("times").alias("times"))
    counts = np.zeros(N_SYMBOLS**3)
    for trigram, times in rows.collect():
        counts[trigram] = times
    three = counts.reshape(N_SYMBOLS, N_SYMBOLS, N_SYMBOLS)
    two = three.sum(axis=0)
    one = two.sum(axis=0) + 1
    p_one = one / one.sum()
    p_two = (two + 20 * p_one) / (two.sum(axis=1, keepdims=True) + 20)
    p_three = (three + 20 * p_two[None]) / (three.sum(axis=2, keepdims=True) + 20)
    return -np.log(p_three).astype(np.float32)


# --- Restoring ---------------------------------------------------------------------------


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each character, or run of one letter, what it may stand for and what that costs."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(word):
        c = word[i]
        j = i + 1
        while j < len(word) and word[j] == c:
            j += 1
        run = j - i
        options: dict[str, float] = {}
        if c in CODES and c not in " \t\n\r":
            options = {c: 0.0 if run == 1 else COST_FOLD}
            if run > 1:
                options[c * 2] = 0.0 if run == 2 else COST_FOLD
            if 2 < run <= 4:
                options[c * run] = 2 * COST_FOLD
        elif c in " \t":
            options = {"": COST_JOIN, " ": COST_BLANK}
        else:
            for letter in LOOKS_LIKE.get(c, ""):
                options[letter] = COST_LOOKS_LIKE
                if run == 2:
                    options[letter * 2] = COST_LOOKS_LIKE
            if c in CUTS:
                options[""] = COST_CUT
            if not options or c.isdigit():
                options[c * run] = 0.0 if not options else 2 * COST_LOOKS_LIKE
        out.append(list(options.items()))
        i = j
    return out


def disguised(word: str) -> bool:
    """Letters with blanks between them, with marks or digits after or before them, or a letter twice; in time
    linear in the word."""
    letter, mark = LETTER.search(word), MARK_BEFORE.search(word)
    if not letter:
        return False
    after = MARK_AFTER.search(word, letter.end()) or (mark and LETTER.search(word, mark.end()))
    return bool(after or DOUBLED.search(word) or BLANK.search(word))


def restored(word: str, costs: np.ndarray, keep: int = 64) -> str:
    """The likeliest original of a disguised word: Viterbi over the last two symbols.

    ``keep`` bounds the states of a position; there are at most as many as pairs of symbols that
    two neighbouring characters can stand for. Each state points back to the one before, so the time is
    linear in the word.
    """
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in lattice(word):
        following: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in states.items():
            for letters, extra in options:
                total, x, y = cost + extra, a, b
                for letter in letters:
                    z = CODES.get(letter, 1)
                    total += float(costs[x, y, z])
                    x, y = y, z
                known = following.get((x, y))
                if known is None or total < known[0]:
                    following[(x, y)] = (total, (path, letters))
        if len(following) > keep:
            following = dict(sorted(following.items(), key=lambda s: s[1][0])[:keep])
        states = following
    path = min(((cost + float(costs[a, b, 0]), path) for (a, b), (cost, path) in states.items()), key=lambda s: s[0])[1]
    said = []
    while path:
        path, letters = path
        said.append(letters)
    return "".join(reversed(said))


class Restorer:
    """Words of a text as they were meant; remembers words it has seen."""

    LIMIT = 200_000
    REMEMBERED = 100  # characters; longer words are restored each time, so that memory stays small

    def __init__(self, costs: np.ndarray):
        self.costs = costs
        self.seen: dict[str, tuple[str, ...]] = {}

    def word(self, written: str) -> tuple[str, ...]:
        found = self.seen.get(written)
        if found is None:
            bare = written.strip(PLAIN_EDGES)
            if bare.isalpha() and not disguised(bare):
                found = (bare,)
            elif not disguised(written):
                found = tuple(re.findall(r"[^\W\d_]+", written))
            else:
                said = [*re.findall(r"[^\W\d_]+", written), *restored(written, self.costs).split()]
                # words glued by marks, each by itself
                for part in GLUE.split(written):
                    if 2 < len(part) < len(bare) and " " not in part and disguised(part):
                        said += self.word(part)
                found = tuple(dict.fromkeys(said))
            if len(written) <= self.REMEMBERED:
                if len(self.seen) >= self.LIMIT:
                    self.seen.clear()
                self.seen[written] = found
        return found

    def words(self, text: str | None) -> list[tuple[str, ...]]:
        """For each written word what it says; a spaced word adds what its letters spell."""
        lowered = (text or "").lower()
        out = [self.word(w) for w in lowered.split()]
        out += [self.word(m.group()) for m in SPACED.finditer(lowered)]
        return out


# --- Terms and scores --------------------------------------------------------------------


def terms_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings, the longest first; ^ marks a beginning."""
    return (word, *(f"^{word[:k]}" for k in (5, 4) if len(word) >= k)) if len(word) > 2 else ()


@dataclass
class Model:
    costs: np.ndarray
    terms: dict[str, float] = field(default_factory=dict)  # term to the probability that it makes a text toxic

    def __post_init__(self):
        self._restorer = None
        sure = sorted(self.terms, key=lambda t: (-len(t), t))
        self._sure = [(t, t.lstrip("^")) for t in sure if len(t.lstrip("^")) >= SURE]
        self._known: dict[str, dict[str, float]] = {}

    def __getstate__(self):
        return {"costs": self.costs, "terms": self.terms}

    def __setstate__(self, state):
        self.__init__(**state)

    def _terms(self, written: str) -> dict[str, float]:
        """The strongest term in what a written word says; if it is several words, spaced or glued, that of each.
        Where a word ends is a guess among spaced letters, so terms of SURE letters count anywhere in them."""
        found: dict[str, float] = {}
        spaced = BLANK.search(written)
        words = restored(written, self.costs).split() if spaced else self._restorer.word(written)
        for word in words:
            best = max(terms_of(word), key=lambda t: self.terms.get(t, 0.0), default="")
            if self.terms.get(best, 0.0) > 0:
                found[best] = self.terms[best]
        if spaced:
            letters = "".join(words)
            for term, bare in self._sure:
                # a word and its beginnings are one cause
                if bare in letters and not any(o.startswith(bare) or bare.startswith(o) for o in (f.lstrip("^") for f in found)):
                    found[term] = self.terms[term]
        elif len(found) > 1 and not GLUE.search(written):
            found = dict([max(found.items(), key=lambda f: f[1])])
        return found

    def score(self, text: str | None) -> float:
        if self._restorer is None:
            self._restorer = Restorer(self.costs)
        lowered = (text or "").lower()
        written = set(lowered.split())
        written.update(m.group() for m in SPACED.finditer(lowered))
        found: dict[str, float] = {}
        known = self._known
        for w in written:
            hit = known.get(w)
            if hit is None:
                hit = self._terms(w)
                if len(w) <= Restorer.REMEMBERED:
                    if len(known) >= 300_000:
                        known.clear()
                    known[w] = hit
            found |= hit
        return 1 - (1 - LEAK) * math.prod(1 - p for p in sorted(found.values()))


def contexts_seen(bits: int) -> float:
    """How many different neighbourhoods set so many of 64 bits, by linear counting."""
    zero = 64 - bits.bit_count()
    return 64 * math.log(64 / zero) if zero else math.inf


def learnt(rows) -> dict[str, float]:
    """Terms from (term, toxic documents, other documents, bits of contexts) that hold up.

    The precision must reach MIN_PRECISION, and its Wilson lower bound MIN_PROOF, where copies of a
    document count once: no more proof than there are different neighbourhoods.
    """
    out = {}
    for term, toxic, clean, bits in rows:
        share = toxic / (toxic + clean)
        proof = min(toxic + clean, contexts_seen(bits % 2**64))
        bound = (share + Z * Z / (2 * proof) - Z * math.sqrt(share * (1 - share) / proof + Z * Z / (4 * proof * proof))) / (1 + Z * Z / proof)
        if share >= MIN_PRECISION and bound >= MIN_PROOF:
            out[term] = (toxic + 0.5) / (toxic + clean + 1)
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """The character model from all documents; terms from at most ``labelled`` labelled rows that
    are not held out, drawn by a hash of doc_id."""
    spark = docs.sparkSession
    costs = character_model(docs)
    held = spark.sparkContext.broadcast(costs)
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("_toxic")).where(
        F.col("doc_id").isNotNull() & F.col("_toxic").isin(0, 1) & ~held_out()
    )
    drawn = rows.groupBy("doc_id").agg(F.max("_toxic").alias("_toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    taught = docs.select("doc_id", "text").where(~held_out()).join(F.broadcast(drawn), "doc_id").select("text", "_toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        restorer, found = Restorer(held.value), {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("_toxic").to_pylist()):
                words = restorer.words(text)
                own: dict[str, int] = {}
                for k, said in enumerate(words):
                    before = words[k - 1] if k else ()
                    after = words[k + 1] if k + 1 < len(words) else ()
                    bit = None
                    for word in said:
                        for term in terms_of(word):
                            if toxic:
                                if bit is None:
                                    bit = 1 << (xxhash.xxh3_64_intdigest(f"{before} {after}") & 63)
                                own[term] = own.get(term, 0) | bit
                            else:
                                own[term] = 0
                for term, bits in own.items():
                    entry = found.get(term)
                    if entry is None:
                        entry = found[term] = [0, 0, 0]
                    entry[1 - toxic] += 1
                    entry[2] |= bits
            if len(found) > 400_000:
                yield _term_rows(found)
                found = {}
        yield _term_rows(found)

    counted = taught.mapInArrow(count, "term string, toxic long, clean long, bits long")
    sums = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("bits").alias("bits"))
    # only terms that can hold up come back: the labelled rows bound their number
    worth = sums.where(F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))).where(
        (F.col("toxic") > 3) & (F.bit_count("bits") > 3)
    )
    return Model(costs, learnt(tuple(row) for row in worth.collect()))


def _term_rows(found: dict[str, list[int]]) -> pa.RecordBatch:
    toxic, clean, bits = zip(*found.values()) if found else ((), (), ())
    signed = np.array(bits, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64()), pa.array(signed)],
        ["term", "toxic", "clean", "bits"],
    )


def toxic_score(spark, model: Model):
    """A column function: text to its score."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        begin("toxicity")
        return pd.Series([held.value.score(t) for t in texts], dtype=float)

    return score
