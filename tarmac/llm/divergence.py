"""Where the sources of a language differ in the terms that they use.

Terms are runs of letters and of characters outside ASCII; only A to Z become small. The first pass over the texts counts in
how many documents of each language a term occurs, and terms in fewer than ten are dropped, exactly. The others get
slots by minimal perfect hashes, sharded by the term's checksum and stored with their terms. The second pass has
the shards broadcast, as many at a time as fit ``AT_ONCE`` bytes; it looks each distinct term of some megabytes of text up,
checks it against the stored one, and increments dense counts, one array for each language and source. Slots with counts
are summed by Spark. Blocks of slots, which hold every source of a language, then give their part
of the sums over terms for each two sources, and their best terms for each source.

All arithmetic is on whole numbers. No text, term list or table is ever in one place: a shard has a bounded
number of terms, a block a bounded number of counts, and a group with a third of all documents is counted by all
tasks. The only result that grows faster than the input's groups is what is asked for, a row for each two sources.

Null texts, languages and sources are ''. Repeated rows, and equal or null ids, are documents of their own. A source
without terms has rows as any other, a language without kept terms gives each pair 0, a language with one source no pairs. An
empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import perfect_hash
from tarmac.llm.store import saved

MIN_DOCUMENTS = 10
TOP = 10
SHARD = 8_192  # terms in a shard, so that many tasks make them
SHARD_BYTES = 1 << 18  # of its terms
AT_ONCE = 64 << 20  # bytes of shards broadcast for one pass
SLICE = 8_000_000  # bytes of text looked at together
HELD = 4_000_000  # counts that a task holds
CELLS = 1 << 17  # counts in a block
SCALE = 1_000_000_000

# A to Z become small; what is no letter, and is ASCII, separates.
_FOLDED = bytes(c if c >= 128 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))

_CELL = "lang string, source string, shard int, slot long, count long"
_PART = "lang string, source string, part string, item string, value long"


def tidy(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source", "text")))


class Words:
    """The terms of some texts: ``terms`` are the distinct ones; of each occurrence, ``text`` and ``term`` say where."""

    def __init__(self, texts: pa.Array):
        folded = [raw.translate(_FOLDED) for raw in texts.cast(pa.large_binary()).to_pylist()]
        lists = pc.ascii_split_whitespace(pa.array(folded, pa.large_binary()).cast(pa.large_string()))
        encoded = lists.flatten().dictionary_encode()
        self.terms = encoded.dictionary.cast(pa.large_binary())
        self.term = encoded.indices.to_numpy().astype(np.int64)
        self.text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
        # splitting leaves empty terms at the ends
        real = (pc.binary_length(self.terms).to_numpy() > 0)[self.term] if len(self.terms) else np.empty(0, bool)
        self.term, self.text = self.term[real], self.text[real]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about SLICE bytes of text, one text at least."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
        at = 0
        while at < len(batch):
            reach = (sizes[at - 1] if at else 0) + SLICE
            end = max(at + 1, int(np.searchsorted(sizes, reach, "right")))
            yield batch.slice(at, end - at)
            at = end


def _numbered(*columns: pa.Array) -> tuple[np.ndarray, list[tuple]]:
    """A number for each row's values, and the values of each number."""
    numbers: dict[tuple, int] = {}
    rows = zip(*(c.to_pylist() for c in columns))
    return np.fromiter((numbers.setdefault(row, len(numbers)) for row in rows), np.int64), list(numbers)


def document_counts(docs: DataFrame) -> DataFrame:
    """lang, term and the number of documents that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            n = max(1, len(words.terms))
            lang, names = _numbered(batch.column("lang"))
            once = np.unique(words.text * n + words.term)
            pairs, documents = np.unique(lang[once // n] * n + once % n, return_counts=True)
            columns = [
                pa.array([names[k][0] for k in (pairs // n).tolist()], pa.string()),
                words.terms.take(pa.array(pairs % n)).cast(pa.binary()).cast(pa.string()),
                pa.array(documents, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "documents"])

    found = tidy(docs).select("lang", "text").mapInArrow(run, "lang string, term string, documents long")
    return found.groupBy("lang", "term").agg(F.sum("documents").alias("documents"))


def shards(kept: DataFrame) -> DataFrame:
    """The perfect hash of each language and shard of the kept terms, stored."""
    size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    number = max(1, -(-size[0] // SHARD), -(-size[1] // SHARD_BYTES))

    def run(table: pa.Table) -> pa.Table:
        sizes, levels, terms = perfect_hash.build(table.column("term").cast(pa.binary()).to_pylist())
        row = {
            "lang": table.column("lang")[0].as_py(),
            "shard": table.column("shard")[0].as_py(),
            "sizes": sizes,
            "levels": levels,
            "terms": [t.decode() for t in terms],
        }
        return pa.Table.from_pylist([row], schema=_SHARDS)

    shard = F.pmod(F.crc32("term"), F.lit(number)).cast("int").alias("shard")
    dealt = kept.select("lang", "term", shard).groupBy("lang", "shard")
    return saved(dealt.applyInArrow(run, "lang string, shard int, sizes array<int>, levels array<binary>, terms array<string>"), "shards")


_SHARDS = pa.schema(
    [
        ("lang", pa.string()), ("shard", pa.int32()), ("sizes", pa.list_(pa.int32())),
        ("levels", pa.list_(pa.binary())), ("terms", pa.list_(pa.string())),
    ]
)


class Slots:
    """The dense slots of one language's terms in the shards at hand."""

    def __init__(self, rows: list):
        self.shards, self.begins, self.n = {}, {}, 0
        for shard, sizes, levels, terms in rows:
            self.shards[shard] = perfect_hash.PerfectHash(sizes, levels, pa.array(terms, pa.large_binary()))
            self.begins[shard] = self.n
            self.n += len(terms)

    def of(self, terms: pa.Array, number: int) -> np.ndarray:
        """The dense slot of each term; -1 for terms that were dropped or are in other shards."""
        raw = terms.to_pylist()
        h = perfect_hash.hashes(raw)
        shard = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % number
        out = np.full(len(raw), -1, np.int64)
        for s, perfect in self.shards.items():
            mine = np.flatnonzero(shard == s)
            slots = perfect.slots(terms.take(pa.array(mine)), h[mine])
            out[mine] = np.where(slots >= 0, slots + self.begins[s], -1)
        return out


def recounted(docs: DataFrame, stored: DataFrame) -> DataFrame:
    """How often each kept term, by its shard and slot, occurs in each language and source; none where never."""
    spark = docs.sparkSession
    weight = F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 40))
    weights = {row.shard: row.bytes for row in stored.groupBy("shard").agg(weight.alias("bytes")).collect()}
    if not weights:
        return spark.createDataFrame([], _CELL)
    number, passes = max(weights) + 1, 1
    while passes < number and max(sum(b for s, b in weights.items() if s % passes == k) for k in range(passes)) > AT_ONCE:
        passes += 1
    counts = []
    for k in range(passes):
        some = stored.where(F.col("shard") % passes == k).collect()
        rows: dict[str, list] = {}
        for row in some:
            raw = ([t.encode() for t in row.terms], [bytes(level) for level in row.levels])
            rows.setdefault(row.lang, []).append((row.shard, row.sizes, raw[1], raw[0]))
        counts.append(saved(_counted(docs, spark.sparkContext.broadcast(rows), number), "counts"))
    cells = reduce(DataFrame.unionAll, counts).groupBy("lang", "source", "shard", "slot")
    return saved(cells.agg(F.sum("count").alias("count")), "cells")


def _counted(docs: DataFrame, rows, number: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[str, Slots] = {}
        dense: dict[tuple[str, str], np.ndarray] = {}
        held = 0
        for batch in slices(batches):
            words = Words(batch.column("text"))
            n = max(1, len(words.terms))
            group, names = _numbered(batch.column("lang"), batch.column("source"))
            pairs, times = np.unique(group[words.text] * n + words.term, return_counts=True)
            by_lang: dict[str, np.ndarray] = {}
            for g, (lang, source) in enumerate(names):
                if lang not in rows.value:
                    continue
                if lang not in slots:
                    slots[lang] = Slots(rows.value[lang])
                if lang not in by_lang:  # the slots of this slice's terms in documents of the language
                    mine = np.isin(pairs // n, [k for k, name in enumerate(names) if name[0] == lang])
                    terms = np.unique(pairs[mine] % n)
                    by_lang[lang] = np.full(n, -1, np.int64)
                    by_lang[lang][terms] = slots[lang].of(words.terms.take(pa.array(terms)), number)
                if (lang, source) not in dense:
                    if held + slots[lang].n > HELD and dense:
                        yield from _handed_on(dense, slots)
                        held = 0
                    dense[lang, source] = np.zeros(slots[lang].n, np.int64)
                    held += slots[lang].n
                begin, end = np.searchsorted(pairs, (g * n, (g + 1) * n))
                slot = by_lang[lang][pairs[begin:end] % n]
                dense[lang, source][slot[slot >= 0]] += times[begin:end][slot >= 0]
        yield from _handed_on(dense, slots)

    return tidy(docs).mapInArrow(run, _CELL)


def _handed_on(dense: dict[tuple[str, str], np.ndarray], slots: dict[str, Slots]) -> Iterator[pa.RecordBatch]:
    """The counts that are not 0, which are then forgotten."""
    for (lang, source), counts in dense.items():
        for shard, begin in slots[lang].begins.items():
            part = counts[begin : begin + len(slots[lang].shards[shard].keys)]
            used = np.flatnonzero(part)
            same = [pa.array([value] * len(used), kind) for value, kind in ((lang, pa.string()), (source, pa.string()), (shard, pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(used, pa.int64()), pa.array(part[used])], ["lang", "source", "shard", "slot", "count"]
            )
    dense.clear()


def shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), three digits at a time to stay within a long."""
    rest, whole = counts + 2, np.zeros_like(counts)
    below = total + 2 * kept
    out = rest // below
    rest = rest - out * below
    for _ in range(3):
        rest = rest * 1000
        whole = rest // below
        out = out * 1000 + whole
        rest = rest - whole * below
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _block(cells: pa.Table, facts: pa.Table) -> pa.Table:
    """A block's part of the sums for each two sources of its language, and its best terms for each source."""
    is_term = pc.is_valid(facts.column("slot"))
    sources, terms = facts.filter(pc.invert(is_term)), facts.filter(is_term)
    lang, kept = facts.column("lang")[0].as_py(), sources.column("kept")[0].as_py()
    names = sources.column("name").to_pylist()
    totals = sources.column("total").to_numpy()
    row_of = {name: k for k, name in enumerate(names)}
    slots = terms.column("slot").to_numpy()
    by_slot = np.argsort(slots)
    counts = np.zeros((len(names), len(slots)), np.int64)
    rows = np.fromiter((row_of[s] for s in cells.column("source").to_pylist()), np.int64)
    counts[rows, np.searchsorted(slots[by_slot], cells.column("slot").to_numpy())] = cells.column("count").to_numpy()
    items = terms.column("name").take(pa.array(by_slot))
    place = np.empty(len(slots), np.int64)
    place[pc.sort_indices(items.cast(pa.binary())).to_numpy()] = np.arange(len(slots))
    p = shares(counts, totals[:, None], kept)
    q = shares(counts.sum(axis=0), totals.sum(), kept)
    out: list[tuple] = []
    for k, name in enumerate(names):
        sums = apart(p, p[k]).sum(axis=1)
        out += [(lang, name, "pair", names[i], int(sums[i])) for i in range(len(names)) if i != k]
        over = np.flatnonzero((counts[k] > 0) & (p[k] > q))
        values = apart(p[k][over], q[over])
        best = np.lexsort((place[over], -values))[:TOP]
        out += [(lang, name, "term", items[int(over[b])].as_py(), int(values[b])) for b in best]
    columns = list(zip(*out)) or [()] * 5
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.Table.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["lang", "source", "part", "item", "value"]
    )


def audited(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source is from each other one of its
    language ("pair"), and the terms that it uses more than the language does ("term")."""
    kept = saved(document_counts(docs).where(F.col("documents") >= MIN_DOCUMENTS).select("lang", "term"), "terms")
    stored = shards(kept)
    cells = recounted(docs, stored)
    groups = tidy(docs).select("lang", "source").distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = stored.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    known = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "kept"])
    known = saved(known.select("lang", "source", "total", "kept"), "groups")
    widest = known.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    width = max(1, CELLS // widest)

    def block(slot: Column) -> Column:
        return F.floor(slot / width).cast("long").alias("block")

    terms = stored.select("lang", "shard", F.posexplode("terms").alias("slot", "name"))
    nothing = F.lit(None).cast("long")
    term_facts = terms.select("lang", "shard", block(F.col("slot")), F.col("slot").cast("long"), "name", nothing.alias("total"), nothing.alias("kept"))
    last = F.floor((F.size("terms") - 1) / width).cast("long")
    blocks = stored.select("lang", "shard", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    source_facts = blocks.join(known, "lang").select(
        "lang", "shard", "block", nothing.alias("slot"), F.col("source").alias("name"), "total", "kept"
    )
    keys = ("lang", "shard", "block")
    parts = (
        cells.select("lang", "shard", block(F.col("slot")), "source", "slot", "count")
        .groupBy(*keys)
        .cogroup(source_facts.unionAll(term_facts).groupBy(*keys))
        .applyInArrow(_block, _PART)
    )
    parts = saved(parts, "parts")
    bare = known.where("kept = 0").select("lang", "source")
    others = bare.select("lang", F.col("source").alias("item"))
    zero = bare.join(others, "lang").where(F.col("source") != F.col("item"))
    pairs = (
        parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
        .unionByName(zero.select("*", F.lit("pair").alias("part"), F.lit(0).cast("long").alias("value")))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return ranked.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
