"""Near-duplicate texts: weighted MinHash of bags of word runs, banded and verified.

A text is the bag (multiset) of its runs of five words. Two texts are linked if the overlap of
their bags, minima over maxima of the counts, is at least ``THRESHOLD``; linked texts, directly or
through others, are one class. Equal texts are one class in any case, also those without words;
null texts are empty ones.

Signature. Each run carries, for each component of the signature, a Poisson process over time and
over the axis of weights. The axis is cut into whole blocks [0,1), [1,2), [2,4), [4,8) ...; each block
has a process of its own, and a point in a block that a weight covers in part belongs to one
half of it, a quarter, and so on down to a unit. A component's value is the time of the first point
below the weight of its run, over all runs; two texts agree in a component with the
probability of their weighted overlap. Only points up to a time that all components will have
passed are drawn, so a text costs about m log m points however long it is.

Search. Equal texts are collapsed first; each distinct text is a number from then on. Of the texts that
share a band, each is compared with the most central one (``stars``), and, where parts are left, with others in turn; what is still apart is
compared pairwise within the bands, by signature and in blocks, of which each is one row, so that a group of
copies is never spelt out in pairs, no bucket is one task's work, and no link is given up. All pairs
are verified on the bags before they count. Rows of texts or classes that are very
frequent get their class from a broadcast table, which is small because they are few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import components, extended
from tarmac.llm.remembered import begin, by_size
from tarmac.llm.store import BROADCAST_ROWS, broadcast_if_few, free_names, id_and_text, saved
from tarmac.llm.words import mixed, shingles

THRESHOLD = 0.8
M = 512  # components of a signature
BANDS, ROWS = 25, 5  # 0.99995 of the pairs at the threshold share a band
# Pairs whose signatures agree in fewer components aren't verified: four standard errors below
# the threshold, of four bits kept of each component.
AGREE = int(M * (0.8125 - 4 * np.sqrt(0.8125 * 0.1875 / M)))
LANES = M * 4 // 64
AT_ONCE = 2_000_000  # bytes of text signed or compared together
HELD = 10_000_000  # characters of texts whose bags a task remembers
BROADCAST_BYTES = 64_000_000
HOT = 1000  # rows of a text, or texts of a class, that are not left to a shuffle
TURNS = 2  # in which other texts of open buckets are the centres, before these are compared pairwise
BLOCK, BLOCK_BYTES = 500, 10_000_000  # texts of a bucket that are compared pairwise in one task, and their bytes
PAIRS = 20_000  # compared at once

_ODD = np.uint64(0xD6E8FEB86659FD93)


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """Times of the first points: one row of ``m`` for each of ``n`` bags.

    ``elements`` are hashes, ``weights`` whole numbers from 1, ``owner`` the bag of each element. A bag
    without elements gets infinities.
    """
    first = np.full((n, m), np.inf)
    flat = first.reshape(-1)
    total = np.bincount(owner, weights, n)
    todo = np.flatnonzero(total > 0)
    limit = np.zeros(n)
    limit[todo] = (np.log(m) + 3) / total[todo]
    while len(todo):
        active = np.zeros(n, bool)
        active[todo] = True
        mine = active[owner]
        e, w, o = elements[mine], weights[mine], owner[mine]
        low, high, level = 0, 1, 0
        while len(e):
            _block(flat, e, w, o, low, high, level, limit, m)
            low, high, level = high, high * 2, level + 1
            deeper = w > low
            e, w, o = e[deeper], w[deeper], o[deeper]
        # a component that has no point yet may have one later
        todo = todo[first[todo].max(axis=1) > limit[todo]]
        limit[todo] *= 1.6
    return first


def _block(flat, elements, weights, owner, low, high, level, limit, m) -> None:
    """Adds the points of one block of the axis of weights, [low, high), up to the limits."""
    size = high - low
    seeds = mixed(elements + np.uint64((level + 1) * int(_ODD) % 2**64))
    until = limit[owner]
    time = np.zeros(len(seeds))
    base, room = owner * m, weights - low
    step = np.uint64(0)
    while len(seeds):
        step += np.uint64(1)
        with np.errstate(over="ignore"):
            bits = mixed(seeds + step * _ODD)
        # 32 bits for the gap to the next point, the rest for its component and place
        time = time - np.log(((bits >> np.uint64(32)).astype(np.float64) + 0.5) / 2.0**32) / (size * m)
        alive = time <= until
        if not alive.all():
            seeds, until, time, base, room, bits = (x[alive] for x in (seeds, until, time, base, room, bits))
        rest = mixed(bits ^ _ODD)
        component = (rest % np.uint64(m)).astype(np.int64)
        place = ((rest >> np.uint64(32)) % np.uint64(size)).astype(np.int64)  # the unit that halving ends in
        inside = place < room
        np.minimum.at(flat, (base + component)[inside], time[inside])


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word runs, their counts, and the text that each belongs to, in order of texts."""
    runs, starts = shingles(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    order = np.lexsort((runs, owner))
    runs, owner = runs[order], owner[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return runs[at], np.diff(np.append(at, len(runs))), owner[at]


def digest(text: str) -> bytes:
    return hashlib.md5(text.encode(), usedforsecurity=False).digest()


def _digest(text: str = "text") -> Column:
    """``digest`` of a column, null as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _bits(values: np.ndarray) -> np.ndarray:
    """The bits of times as numbers; equal times, equal numbers."""
    return values.view(np.uint64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin("words")
    for batch in batches:
        # texts of like length together: short ones take many steps, all of them the same ones
        order = pa.array(np.argsort(pc.binary_length(batch.column("text")).to_numpy(), kind="stable"))
        ids, all_texts = batch.column("doc_id").take(order), batch.column("text").take(order)
        for k, end in by_size([n + 1000 for n in pc.binary_length(all_texts).to_pylist()], AT_ONCE):
            texts = all_texts.slice(k, end - k).to_pylist()
            runs, counts, owner = bags(texts)
            first = signatures(runs, counts, owner, len(texts))
            values = mixed(_bits(first))
            with np.errstate(over="ignore"):
                bands = np.zeros((len(texts), BANDS), np.uint64)
                for r in range(ROWS):
                    bands = bands * _ODD + values[:, r : BANDS * ROWS : ROWS]
                bands = mixed(bands)
            nibbles = (values & np.uint64(15)).reshape(len(texts), LANES, 16)
            lanes = np.zeros((len(texts), LANES), np.uint64)
            for j in range(16):
                lanes |= nibbles[:, :, j] << np.uint64(4 * j)
            wordless = np.bincount(owner, minlength=len(texts)) == 0
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(k, len(texts)),
                    pa.array([digest(t) for t in texts], pa.binary()),
                    pa.array([None if no else row.tolist() for no, row in zip(wordless, bands.view(np.int64))], pa.list_(pa.int64())),
                    pa.array(list(lanes.view(np.int64)), pa.list_(pa.int64())),
                    pc.binary_length(all_texts.slice(k, end - k)).cast(pa.int64()),
                ],
                ["doc_id", "key", "bands", "lanes", "bytes"],
            )


def _agreeing(a: str, b: str) -> Column:
    """Components in which two signatures agree, of which four bits each are kept in lanes."""
    ones = F.lit(0x1111111111111111)
    parts = []
    for i in range(LANES):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        parts.append(F.bit_count(x.bitwiseAND(ones)))
    return F.lit(M) - reduce(add, parts)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a text of ``texts_a`` and one of ``texts_b`` that are of different parts and whose signatures agree
    enough, as one row with a number of its own; a pair comes from the first band it shares only, as all its buckets
    are open ones."""
    job = TaskContext.get().partitionId() << 33
    for batch in batches:
        for k in range(batch.num_rows):
            same = batch.column("low")[k].as_py() == batch.column("high")[k].as_py()
            one, other = (_block_of(batch.column(c)[k].values) for c in ("texts_a", "texts_b"))
            apart = one["part"][:, None] != other["part"][None, :]
            if same:
                apart &= one["node"][:, None] < other["node"][None, :]
            for band in range(batch.column("band")[k].as_py()):
                apart &= one["bands"][:, band, None] != other["bands"][None, :, band]
            x, y = np.nonzero(apart)
            parts = [(x[i : i + PAIRS], y[i : i + PAIRS]) for i in range(0, len(x), PAIRS)]
            near = [_agreeing_lanes(one["lanes"][a], other["lanes"][b]) >= AGREE for a, b in parts]
            if any(n.any() for n in near):
                chosen = np.concatenate(near)
                found = one["node"][x[chosen]], other["node"][y[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array([job]), *(pa.array([f], pa.list_(pa.int64())) for f in found)], ["job", "a", "b"])
                job += 1


def _block_of(texts: pa.StructArray) -> dict[str, np.ndarray]:
    """The columns of a block; of ``bands`` and ``lanes`` a row for each text."""
    found = {c: texts.field(c).to_numpy() for c in ("node", "part")}
    return found | {c: texts.field(c).flatten().to_numpy().view(np.uint64).reshape(len(texts), -1) for c in ("bands", "lanes")}


def _agreeing_lanes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_agreeing`` of rows of lanes."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return M - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def _lanes(prefix: str) -> list[Column]:
    return [F.col("lanes")[i].alias(f"{prefix}{i}") for i in range(LANES)]


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Minima over maxima of the counts of two bags, each sorted distinct elements and counts."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    both = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    least = np.minimum(a[1][at[both]], b[1][both]).sum()
    return float(least) / max(1.0, float(a[1].sum() + b[1].sum() - least))


def verified(pairs: DataFrame, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of texts whose bags overlap enough. ``pairs`` are stored; ``rows`` has node and text, one
    row for each distinct text.

    A text travels once for each text it is compared with as ``b``, and once as ``a``; the latter are the fewer.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("word bags")  # what signing took goes back first
        last: dict[int, tuple] = {}
        held = 0
        for batch in batches:
            sizes = [pc.binary_length(batch.column(c)).to_numpy() for c in ("text_a", "text_b")]
            keep = np.zeros(batch.num_rows, bool)
            for k, end in by_size((sizes[0] + sizes[1] + 1000).tolist(), AT_ONCE):
                part = [batch.column(c).slice(k, end - k).to_pylist() for c in ("a", "b", "text_a", "text_b")]
                wanted = dict(zip(part[0] + part[1], part[2] + part[3]))
                if held > HELD:
                    last = {key: last[key] for key in wanted if key in last}
                    held = sum(len(wanted[key]) for key in last)
                missing = [key for key in wanted if key not in last]
                if missing:
                    held += sum(len(wanted[key]) for key in missing)
                    runs, counts, owner = bags([wanted[key] for key in missing])
                    edges = np.searchsorted(owner, np.arange(len(missing) + 1))
                    for i, key in enumerate(missing):
                        last[key] = (runs[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]])
                keep[k:end] = [overlap(last[a], last[b]) >= threshold for a, b in zip(part[0], part[1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], ["a", "b"]
            )

    others = rows.select(F.col("node").alias("b"), F.col("text").alias("text_b")).join(broadcast_if_few(pairs), "b")
    centres = saved(pairs.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("pairs")), "centres")
    texts = rows.join(broadcast_if_few(centres), "node")
    one = saved(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"), "pairs"), "centre-texts")
    both = split_join(others, one, "a", F.col("pairs") > HOT, F.octet_length("text_a"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def verified_jobs(jobs: DataFrame, rows: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose bags overlap enough, of jobs: ``job`` and the pairs as two lists. ``jobs`` are stored.

    A text travels once for each job, not for each pair, and a job has the texts of two blocks at most.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("word bags")  # what signing took goes back first
        held: dict[int, tuple] = {}  # bags of one job
        for batch in batches:
            texts = batch.column("text")
            told = batch.column("a").is_valid().to_numpy(zero_copy_only=False)
            begins = 0
            for at in [*np.flatnonzero(told).tolist(), batch.num_rows]:
                sizes = [n + 1000 for n in pc.binary_length(texts.slice(begins, at - begins)).to_pylist()]
                for k, end in by_size(sizes, AT_ONCE) if sizes else ():
                    keys = batch.column("node").slice(begins + k, end - k).to_pylist()
                    runs, counts, owner = bags(texts.slice(begins + k, end - k).to_pylist())
                    edges = np.searchsorted(owner, np.arange(len(keys) + 1))
                    for i, key in enumerate(keys):
                        held[key] = (runs[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]])
                if at < batch.num_rows:  # the job's pairs come after its texts
                    pairs = zip(batch.column("a")[at].as_py(), batch.column("b")[at].as_py())
                    linked = [(a, b) for a, b in pairs if overlap(held[a], held[b]) >= threshold]
                    if linked:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*linked)], ["a", "b"])
                    held = {}
                begins = at + 1

    members = jobs.select("job", F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    texts = _texts(rows, nodes, members.select("node"))
    none = F.lit(None).cast("array<long>")
    sent = members.join(texts, "node").select("job", "node", "text", none.alias("a"), none.alias("b"))
    asked = jobs.select("job", F.lit(None).cast("long").alias("node"), F.lit(None).cast("string").alias("text"), "a", "b")
    dealt = sent.unionByName(asked).repartition("job").sortWithinPartitions("job", F.col("a").isNotNull())
    return dealt.mapInArrow(check, "a long, b long")


def stars(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries whose bucket has other texts as well, stored; and for each text of such a bucket the
    pair with the bucket's most central text: the one that meets most texts over all its buckets."""
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("bytes").alias("volume")).where("size > 1")
    sizes = saved(sizes, "bucket-sizes")
    large = F.col("size") > HOT
    met = saved(split_join(entries, sizes, "bucket", large).select("bucket", "node", "band", "size", "volume"), "met")
    weight = met.groupBy("node").agg(F.sum("size").alias("weight"))
    centres = met.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "node")).getField("node").alias("a"), F.max("size").alias("size")
    )
    pairs = split_join(met.select("bucket", "node"), saved(centres, "bucket-centres"), "bucket", large)
    return met, pairs.where(F.col("a") != F.col("node")).select("a", F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its class) for each row of ``docs``.

    Rows without a doc_id take part; a class that has no doc_id at all has class_id null. An empty
    table gives an empty one. Extra columns aren't looked at.
    """
    rows, groups = _placed(docs, threshold)
    return with_part(rows, groups, F.min("doc_id").alias("class_id")).select("doc_id", "class_id")


def with_part(rows: DataFrame, groups: DataFrame, *found: Column) -> DataFrame:
    """Rows, which have ``node``, with the aggregates ``found`` of all rows of their class. ``groups`` has
    node and component of the texts that are not the smallest of their class.

    Rows are counted by text first. Texts of many rows, which are few, are joined by broadcast; the rest has no hot key.
    """
    names = [f"_{i}" for i in range(len(found))]
    nodes = rows.groupBy("node").agg(F.count("*").alias("rows"), F.struct(*found).alias("found"))
    parts = nodes.join(groups, "node", "left").select("node", "rows", "found", F.coalesce("component", "node").alias("part"))
    parts = saved(parts, "text-classes")
    # minima of minima are minima of all
    fields = parts.schema["found"].dataType.names
    classes = parts.groupBy("part").agg(F.count("*").alias("texts"), *(F.min(f"found.{f}").alias(n) for f, n in zip(fields, names)))
    classes = saved(classes, "classes")
    known = saved(split_join(parts.select("node", "rows", "part"), classes, "part", F.col("texts") > HOT).drop("part", "texts"), "known-texts")
    return split_join(rows, known, "node", F.col("rows") > HOT).drop("rows").withColumnsRenamed(dict(zip(names, fields)))


def split_join(rows: DataFrame, stored: DataFrame, key: str, hot: Column, size: Column | None = None) -> DataFrame:
    """The join of rows with a stored table that has each key once. Keys that are hot, by a count in the table,
    are broadcast if there are few of them (and the sizes of their rows sum to little); the others are shuffled."""
    frequent = stored.where(hot)
    number, weight = frequent.agg(F.count("*"), F.coalesce(F.sum(F.lit(16) if size is None else size), F.lit(0))).first()
    if not number or number > BROADCAST_ROWS or weight > BROADCAST_BYTES:
        return rows.join(stored, key)
    rest = rows.join(F.broadcast(frequent.select(key)), key, "left_anti").join(stored.where(~hot), key)
    return rows.join(F.broadcast(frequent), key).unionByName(rest)


def _placed(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, digest and ``node`` (the number of the text) for each row of ``docs``; and node and component
    of the texts that are not the smallest of their class."""
    rows = id_and_text(docs)
    signed = saved(rows.mapInArrow(_signed, "doc_id long, key binary, bands array<long>, lanes array<long>, bytes long"), "signatures")
    numbered = signed.groupBy("key").agg(
        F.first("bands").alias("bands"), F.first("lanes").alias("lanes"), F.first("bytes").alias("bytes"), F.count("*").alias("rows")
    )
    distinct = saved(numbered.withColumn("node", F.monotonically_increasing_id()), "distinct-texts")
    nodes = saved(distinct.select("key", "node"), "nodes")
    known = distinct.select("key", "node", "rows")
    placed = saved(split_join(signed.select("doc_id", "key"), known, "key", F.col("rows") > HOT).drop("rows"), "placed")

    worded = distinct.where(F.col("bands").isNotNull()).select("node", "bands", "lanes", "bytes")
    # a bucket is a band and its value in one number; should two fall together, the pairs are verified anyway
    entries = saved(
        worded.select("node", "bytes", F.posexplode("bands").alias("band", "value")).select("node", "bytes", "band", F.xxhash64("band", "value").alias("bucket")),
        "entries",
    )
    close = worded.select("node", *_lanes("x")), worded.select("node", *_lanes("y"))
    met, candidates = stars(entries)
    candidates = saved(candidates, "candidates")
    one, other = close[0].withColumnRenamed("node", "a"), close[1].withColumnRenamed("node", "b")

    def linked(candidates: DataFrame) -> DataFrame:
        """Candidates, stored, whose signatures agree and whose bags overlap enough."""
        alike = candidates.join(one, "a").join(other, "b").where(_agreeing("x", "y") >= AGREE).select("a", "b")
        pairs = saved(alike, "pairs")
        ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
        return saved(verified(pairs, _texts(rows, nodes, ends), threshold), "verified")

    links = linked(candidates)
    groups = components(links)

    # buckets that the stars left in several parts: other texts are the centres, for the parts that are not theirs
    for turn in range(TURNS):
        open_ = _open_entries(met, groups)
        last = F.max(F.struct(F.xxhash64("node", F.lit(turn)).alias("place"), "node", "part")).alias("last")
        centres = open_.groupBy("bucket").agg(last, F.max("size").alias("size"))
        centres = saved(centres.select("bucket", F.col("last.node").alias("a"), F.col("last.part").alias("part_a"), "size"), "bucket-centres")
        across = split_join(open_.select("bucket", "node", "part"), centres, "bucket", F.col("size") > HOT)
        across = across.where(F.col("part") != F.col("part_a")).select("a", F.col("node").alias("b")).distinct()
        groups = extended(groups, linked(saved(across, "candidates")))

    # what is still in several parts: texts pairwise, across the parts
    open_ = _open_entries(met, groups)
    signs = worded.drop("bytes").join(broadcast_if_few(saved(open_.select("node").distinct(), "open-texts")), "node")
    signs = saved(signs, "open-signatures")
    # no bucket is one key: its texts are dealt into blocks, a row each, and each two blocks meet once
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("volume") / BLOCK_BYTES)).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = open_.select("bucket", "band", "node", "part", blocks.alias("blocks"), block.alias("block")).join(signs, "node")
    held = dealt.groupBy("bucket", "blocks", "block").agg(
        F.max("band").alias("band"), F.collect_list(F.struct("node", "part", "bands", "lanes")).alias("texts")
    )
    held = saved(held, "open-blocks")
    later = F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))
    earlier = F.explode(F.sequence(F.lit(0), F.col("block")))
    low = held.select("bucket", "band", F.col("block").alias("low"), later.alias("high"), F.col("texts").alias("texts_a"))
    high = held.select("bucket", earlier.alias("low"), F.col("block").alias("high"), F.col("texts").alias("texts_b"))
    rest = low.join(high, ["bucket", "low", "high"]).mapInArrow(_alike, "job long, a array<long>, b array<long>")
    more = saved(verified_jobs(saved(rest, "jobs"), rows, nodes, threshold), "verified")
    return placed, extended(groups, more)


def _open_entries(met: DataFrame, groups: DataFrame) -> DataFrame:
    """bucket, size, volume, band, node and part of the texts in buckets that hold several parts; stored."""
    parted = met.join(groups, "node", "left").select("bucket", "size", "volume", "band", "node", F.coalesce("component", "node").alias("part"))
    spread = parted.groupBy("bucket").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    split = saved(spread.where("least != most").select("bucket"), "open-buckets")
    return saved(parted.join(broadcast_if_few(split), "bucket"), "open")


def _texts(rows: DataFrame, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """node and text of the nodes in ``ends``, each once: copies are collapsed before any of them travels far,
    as each task sends one of those it holds."""
    if ends.count() <= BROADCAST_ROWS:
        keys = saved(nodes.join(F.broadcast(ends), "node", "left_semi"), "wanted-keys")
    else:
        keys = saved(nodes.join(saved(ends.distinct(), "wanted"), "node"), "wanted-keys")
    texts = rows.select(_digest().alias("key"), "text")
    if keys.count() > BROADCAST_ROWS:  # first one of each text, as the join deals them by text
        return saved(texts.groupBy("key").agg(F.first("text").alias("text")).join(keys, "key").select("node", "text"), "texts")
    return saved(texts.join(F.broadcast(keys), "key").groupBy("node").agg(F.first("text").alias("text")), "texts")


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of near-duplicates, with the columns of ``docs``: the one with the smallest doc_id,
    of those the one whose text has the smallest digest. Rows without a doc_id come last."""
    rows, groups = _placed(docs, threshold)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    by_text = rows.groupBy("node").agg(first)
    parts = by_text.join(groups, "node", "left").groupBy(F.coalesce("component", "node").alias("part"))
    names = free_names(docs, "key", "id", "kept")
    kept = parts.agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias(names["id"]), F.col("first.key").alias(names["kept"]))
    keyed = docs.withColumn(names["key"], _digest())
    same = F.col("doc_id").eqNullSafe(F.col(names["id"])) & (F.col(names["key"]) == F.col(names["kept"]))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", names["key"]]).drop(names["key"])
