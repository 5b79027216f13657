"""Documents scored by masked pseudo-likelihood.

A small network sees two words to either side of a place and gives every word a probability of standing there.
The score of a document is the sum, over all its words, of the log probability of the word
given its neighbours; ``pseudo_perplexity`` is the usual form of the mean.

Vocabulary: the most frequent words of all documents; any other word is one of ``OTHERS`` marks by its hash,
and its probability that of the mark times the word's share of all that the mark stands for. The counts of
these words stay in Spark tables: documents are encoded in blocks, each with a list of its distinct
words, and only these are joined with the counts.
Network: an embedding for each of the four places, added up, tanh, then a class of words and a word
of that class, so a word costs two small softmaxes. Training: every place of every document is predicted
once; of ``rounds`` rounds each takes every ``rounds``-th place, one further on than the round before, from a beginning
that the document's number decides. Each task trains a copy on
the documents it reads; the copies' mean, weighted by their places, begins the next round. What is
gathered, word counts and copies, grows with the input; the model does not.

Null and empty texts have no words: n_tokens 0, log_likelihood 0, pseudo_perplexity null. Documents
that repeat are scored as often. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.remembered import by_size, runs
from tarmac.llm.store import saved
from tarmac.llm.words import mixed

REACH = 2
CLASSES, CLASS_SIZE = 64, 64
VOCABULARY = CLASSES * CLASS_SIZE
OTHERS = 256
WIDTH = 32
ROUNDS = 2
BATCH = 2048
AT_ONCE = 1 << 12  # places scored together, few enough for a processor's own memory
BOUND = 60  # powers of e up to it, and their sums, are far from the largest number of 32 bits
SHORT = 4  # rows of a run that are added along with those of others
RATE = 0.1
TEXT_BYTES = 2_000_000  # of texts whose words are told apart together
PIECE = 1 << 14  # numbers of the model that travel in one row
BLOCK_WORDS, BLOCK_PLACES = 100_000, 2_000_000  # distinct other words of a block, and places of such words, that end it
SMOOTHING = 0.1  # added to the count of a word, and of one more that stands for those never seen


# --- Words -------------------------------------------------------------------------------


class Words:
    """The words of texts in lower case, text after text, as one column; between white space as ``str.split`` has it."""

    def __init__(self, texts: list[str | None]):
        parts = pc.utf8_split_whitespace(pa.array([(t or "").lower() for t in texts], pa.large_string()))
        self.words, begins = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
        # white space at either end of a text leaves an empty word there
        empty = pc.equal(self.words, pa.scalar("", pa.large_string())).to_numpy(zero_copy_only=False)
        if empty.any():
            self.words = self.words.filter(pa.array(~empty))
            begins -= np.concatenate([[0], np.cumsum(empty)])[begins]
        self.begins = begins  # of each text, and the end

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Iterator[Words]:
        """Of the texts of a batch, so many as have few bytes together."""
        texts = batch.column("text")
        for k, end in by_size([(n or 0) + 100 for n in pc.binary_length(texts).to_pylist()], TEXT_BYTES):
            yield cls(texts.slice(k, end - k).to_pylist())


def word_counts(docs: DataFrame) -> DataFrame:
    """word and times, over all documents; counted in each task before anything is sent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in Words.of(batch):
                seen = texts.words.value_counts()
                yield pa.RecordBatch.from_arrays([seen.field("values").cast(pa.string()), seen.field("counts")], ["word", "times"])

    return (
        docs.select("text").mapInArrow(count, "word string, times long").groupBy("word").agg(F.sum("times").alias("times"))
    )


@dataclass
class Encoded:
    """``docs``: block, at (number in the block), doc_id and ``ids`` (bytes, 16 bits a word). ``rest``: block, at and the log shares of the document's other words, added up."""

    docs: DataFrame
    rest: DataFrame


class Block:
    """Documents with a list of their distinct words outside the vocabulary, which get numbers from VOCABULARY on, in
    the order they come."""

    def __init__(self, vocabulary: pa.Array, number: int, words: int):
        self.vocabulary, self.number, self.most = vocabulary, number, words
        self.others = pa.array([], pa.large_string())
        self.hashes, self.marks = np.empty(0, np.int64), np.empty(0, np.int16)
        self.places, self.sizes = [], []

    def encode(self, texts: Words, first: int) -> list[bytes]:
        """Ids of the texts from the ``first`` on, up to the one that makes the block full."""
        begins = texts.begins[first:] - texts.begins[first]
        coded = texts.words.slice(texts.begins[first]).dictionary_encode()
        distinct = coded.dictionary
        numbers = _at(distinct, self.vocabulary)
        known = _at(distinct, self.others)
        numbers = np.where((numbers < 0) & (known >= 0), known + VOCABULARY, numbers)
        new = np.flatnonzero(numbers < 0)
        numbers[new] = VOCABULARY + len(self.others) + np.arange(len(new))
        codes = numbers[coded.indices.to_numpy()]

        other = codes >= VOCABULARY
        places = np.concatenate([[0], np.cumsum(other)])[begins[1:]] + self.held()
        # how many other words there are after each text: they are numbered as they come
        most = np.maximum.accumulate(np.concatenate([[VOCABULARY + len(self.others) - 1], codes]))[begins[1:]] - VOCABULARY + 1
        full = np.flatnonzero((most >= self.most) | (places >= BLOCK_PLACES))
        taken = int(full[0]) + 1 if len(full) else len(begins) - 1
        self.full = bool(len(full))

        begins = begins[: taken + 1]
        codes, other = codes[: begins[-1]], other[: begins[-1]]
        self._add(distinct.take(pa.array(new[: most[taken - 1] - len(self.others)])))
        self.places.append((codes[other] - VOCABULARY).astype(np.int32))
        self.sizes.append(np.diff(np.concatenate([[0], np.cumsum(other)])[begins]).astype(np.int32))
        codes[other] = self.marks[self.places[-1]]
        raw, cuts = codes.astype(np.int16).tobytes(), (2 * begins).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def held(self) -> int:
        return sum(map(len, self.places))

    def texts(self) -> int:
        return sum(map(len, self.sizes))

    def _add(self, words: pa.Array) -> None:
        # as the function xxhash64 of Spark
        values = np.array([xxhash.xxh64_intdigest(word, 42) for word in words.to_numpy(zero_copy_only=False)], np.uint64)
        self.others = pa.concat_arrays([self.others, words])
        self.hashes = np.concatenate([self.hashes, values.view(np.int64)])
        marks = values % np.uint64(OTHERS) + np.uint64(VOCABULARY - OTHERS)
        self.marks = np.concatenate([self.marks, marks.astype(np.int16)])

    def closed(self) -> pa.RecordBatch:
        """The row that tells of the block itself."""
        places, sizes = (np.concatenate([np.empty(0, np.int32), *x]).tobytes() for x in (self.places, self.sizes))
        row = {"block": [self.number], "hashes": [self.hashes], "places": [places], "sizes": [sizes]}
        return _rows_of(row, 1)


def _at(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Where the words are among those known, -1 for none."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)


ENCODED = "block long, at int, doc_id long, ids binary, hashes array<long>, places binary, sizes binary"
_FIELDS = pa.schema(
    {"block": pa.int64(), "at": pa.int32(), "doc_id": pa.int64(), "ids": pa.binary()}
    | {"hashes": pa.list_(pa.int64()), "places": pa.binary(), "sizes": pa.binary()}
)


def _rows_of(columns: dict, n: int) -> pa.RecordBatch:
    """``n`` rows of ENCODED; columns that aren't given are null."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FIELDS], schema=_FIELDS
    )


def encoded(docs: DataFrame, words: dict[str, int], block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents as in ``Encoded``, and the blocks: the hashes of their distinct other words, at which of
    these each place of such a word points, and how many places each document has. Both stored."""
    held = docs.sparkSession.sparkContext.broadcast(sorted(words, key=words.get))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(held.value, pa.large_string())
        block = Block(vocabulary, TaskContext.get().partitionId() << 32, block_words)
        for batch in batches:
            doc_ids, done = batch.column("doc_id"), 0
            for texts in Words.of(batch):
                first = 0
                while first < len(texts.begins) - 1:
                    at, ids = block.texts(), block.encode(texts, first)
                    n = len(ids)
                    numbers = np.arange(at, at + n, dtype=np.int32)
                    row = {"block": np.full(n, block.number), "at": numbers, "doc_id": doc_ids.slice(done, n), "ids": ids}
                    yield _rows_of(row, n)
                    first, done = first + n, done + n
                    if block.full:
                        yield block.closed()
                        block = Block(vocabulary, block.number + 1, block_words)
        yield block.closed()

    table = saved(docs.select("doc_id", "text").mapInArrow(run, ENCODED), "word-ids")
    blocks = table.where("sizes is not null").select("block", "hashes", "places", "sizes")
    return table.where("sizes is null").select("block", "at", "doc_id", "ids"), blocks


def _mark(hash_: str = "hash") -> Column:
    return F.pmod(F.col(hash_), F.lit(OTHERS)).cast("int").alias("mark")


def mark_sums(others: DataFrame) -> DataFrame:
    """mark, ``total`` and ``words`` of it: how often its words occur and how many there are; OTHERS rows at most."""
    return others.groupBy(_mark()).agg(F.sum("times").alias("total"), F.count("*").alias("words"))


def rest_sums(blocks: DataFrame, others: DataFrame, sums: DataFrame) -> DataFrame:
    """block, at and ``rest``: the log shares that a document's other words have of their marks, added up."""
    words = blocks.select("block", F.posexplode("hashes").alias("number", "hash"))
    counted = words.join(others.select("hash", "times"), "hash", "left").select("block", "number", _mark(), "times")
    times, total, n = (F.coalesce(c, F.lit(0)) for c in ("times", "total", "words"))
    share = F.log((times + SMOOTHING) / (total + SMOOTHING * (n + 1)))
    shares = counted.join(F.broadcast(sums), "mark", "left").select("block", "number", share.alias("share"))
    listed = shares.groupBy("block").agg(F.collect_list("number").alias("numbers"), F.collect_list("share").alias("shares"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sizes = np.frombuffer(batch.column("sizes")[k].as_py(), np.int32)
                places = np.frombuffer(batch.column("places")[k].as_py(), np.int32)
                logs = np.zeros(len(places))
                if len(places):
                    numbers = batch.column("numbers")[k].values.to_numpy(zero_copy_only=False)
                    by_number = np.empty(numbers.max() + 1)
                    by_number[numbers] = batch.column("shares")[k].values.to_numpy(zero_copy_only=False)
                    logs = by_number[places]
                rest = np.bincount(np.repeat(np.arange(len(sizes)), sizes), logs, len(sizes)).astype(float)
                block = np.full(len(sizes), batch.column("block")[k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.arange(len(sizes), dtype=np.int32)), pa.array(rest)], ["block", "at", "rest"])

    both = blocks.select("block", "places", "sizes").join(listed, "block", "left")
    return saved(both.mapInArrow(add, "block long, at int, rest double"), "rest-sums")


def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, text after text, and how many each text has."""
    return np.frombuffer(b"".join(ids), np.int16), np.array([len(i) // 2 for i in ids], np.int64)


def windows(ids: np.ndarray, sizes: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """The neighbours of each word, or of those at the places ``chosen``: [word][place]; outside the
    text there is the mark VOCABULARY."""
    shift = np.repeat(np.arange(1, len(sizes) + 1) * REACH, sizes)
    places = np.arange(len(ids)) + shift
    marked = np.full(len(ids) + REACH * (len(sizes) + 1), VOCABULARY, np.int16)
    marked[places] = ids
    if chosen is not None:
        places = places[chosen]
    out = np.empty((len(places), 2 * REACH), np.int16)
    for k, step in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
        out[:, k] = marked[places + step]
    return out


# --- Network -----------------------------------------------------------------------------


@dataclass
class Network:
    around: np.ndarray  # [place][word][width]
    bias: np.ndarray  # [width]
    classes: np.ndarray  # [class][width + 1]; the last is the bias
    words: np.ndarray  # [class][word of it][width + 1]

    SHAPES = (
        (2 * REACH, VOCABULARY + 1, WIDTH),
        (WIDTH,),
        (CLASSES, WIDTH + 1),
        (CLASSES, CLASS_SIZE, WIDTH + 1),
    )

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for shape in cls.SHAPES:
            size = int(np.prod(shape))
            parts.append(flat[at : at + size].reshape(shape).copy())
            at += size
        return cls(*parts)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.around, self.bias, self.classes, self.words)])

    @classmethod
    def new(cls, counts: np.ndarray) -> Network:
        """Small random weights; the biases give each word its frequency."""
        random = np.random.default_rng(11)
        parts = [random.normal(0, 0.1, shape).astype(np.float32) for shape in cls.SHAPES]
        seen = (counts + 1.0).reshape(CLASSES, CLASS_SIZE)
        parts[1][:] = 0
        parts[2][:, -1] = np.log(seen.sum(axis=1) / seen.sum())
        parts[3][:, :, -1] = np.log(seen / seen.sum(axis=1, keepdims=True))
        return cls(*parts)

    def hidden(self, near: np.ndarray) -> np.ndarray:
        """Activations for rows of neighbours, with a 1 at the end for the biases."""
        total = self.around[0].take(near[:, 0], axis=0)
        total += self.bias
        for k in range(1, near.shape[1]):
            total += self.around[k].take(near[:, k], axis=0)
        out = np.ones((len(near), WIDTH + 1), np.float32)
        np.tanh(total, out=out[:, :WIDTH])
        return out

    def log_probabilities(self, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        h = self.hidden(near)
        group, member = np.divmod(target, CLASS_SIZE)
        out = _log_chosen(h @ self.classes.T, group)
        order, edges = _by_class(group)
        h, within = h.take(order, axis=0), np.empty((len(h), CLASS_SIZE), np.float32)
        for k, a, b in edges:
            np.matmul(h[a:b], self.words[k].T, out=within[a:b])
        out[order] += _log_chosen(within, member[order])
        return out


def _by_class(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that sorts rows by class, and each class that occurs with where it begins and ends in it."""
    group = group.astype(np.int8)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(CLASSES + 1)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def _bounded(x: np.ndarray) -> np.ndarray:
    """``x`` such that no power of e leaves the range of the numbers: rows less their largest, where that is needed."""
    if x.size and not (x.max() < BOUND and x.min() > -BOUND):
        x -= x.max(axis=1, keepdims=True)
    return x


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _places(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Where the one place of each row is in the flat array."""
    return np.arange(0, x.size, x.shape[1]) + chosen


def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row at one place; overwrites ``x``."""
    out = _bounded(x).reshape(-1).take(_places(x, chosen))
    return out - np.log(_row_sums(np.exp(x, out=x)))


def _error(x: np.ndarray, chosen: np.ndarray, n: int) -> np.ndarray:
    """Gradient of the mean loss over ``n`` rows: softmax of each row, less 1 at one place; overwrites ``x``."""
    np.exp(_bounded(x), out=x)
    x *= (1 / (_row_sums(x) * np.float32(n)))[:, None]
    x.reshape(-1)[_places(x, chosen)] -= np.float32(1 / n)
    return x


def _sums(rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, each from its beginning to the next. Most runs are of a few rows: the first ones of all
    runs are added at once, then what is left of longer runs."""
    sizes = np.diff(begins, append=len(rows))
    out = rows.take(begins, axis=0)
    longer = np.flatnonzero(sizes > 1)
    for step in range(1, SHORT):
        out[longer] = out.take(longer, axis=0) + rows.take(begins[longer] + step, axis=0)
        longer = longer[sizes[longer] > step + 1]
    if len(longer):
        left = sizes[longer] - SHORT
        rest = rows.take(runs(begins[longer] + SHORT, left), axis=0)
        out[longer] += np.add.reduceat(rest, np.cumsum(left) - left)
    return out


class Trainer:
    """Adaptive gradient steps on one copy of a network."""

    def __init__(self, network: Network):
        self.network = network
        self.grown = [np.full(s, 1e-6, np.float32) for s in Network.SHAPES]

    def _step(self, part: np.ndarray, grown: np.ndarray, at: np.ndarray | None, change: np.ndarray) -> None:
        """Overwrites ``change``; without ``at`` it is of the whole part."""
        sums = change * change
        if at is None:
            grown += sums
            np.sqrt(grown, out=sums)
        else:
            sums += grown.take(at, axis=0)
            grown[at] = sums
            np.sqrt(sums, out=sums)
        change /= sums
        change *= np.float32(RATE)
        if at is None:
            part -= change
        else:
            part[at] = np.subtract(part.take(at, axis=0), change, out=change)

    def learn(self, near: np.ndarray, target: np.ndarray) -> None:
        net, n = self.network, len(target)
        h = net.hidden(near)
        group, member = np.divmod(target, CLASS_SIZE)
        off = _error(h @ net.classes.T, group, n)
        back = off @ net.classes
        order, edges = _by_class(group)
        own, within = h.take(order, axis=0), np.empty((n, CLASS_SIZE), np.float32)
        for k, a, b in edges:
            np.matmul(own[a:b], net.words[k].T, out=within[a:b])
        within, more = _error(within, member[order], n), np.empty_like(own)
        change = np.empty((len(edges), *net.words.shape[1:]), np.float32)
        for i, (k, a, b) in enumerate(edges):
            np.matmul(within[a:b], net.words[k], out=more[a:b])
            np.matmul(within[a:b].T, own[a:b], out=change[i])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        back += more.take(place, axis=0)
        self._step(net.words, self.grown[3], np.array([k for k, _, _ in edges]) if len(edges) < CLASSES else None, change)
        self._step(net.classes, self.grown[2], None, off.T @ h)
        inner = h[:, :WIDTH] * h[:, :WIDTH]
        np.subtract(np.float32(1), inner, out=inner)
        inner *= back[:, :WIDTH]
        self._step(net.bias, self.grown[1], None, inner.sum(axis=0))
        for place in range(near.shape[1]):
            column = np.ascontiguousarray(near[:, place])
            order = np.argsort(column, kind="stable")
            column = column[order]
            first = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            self._step(net.around[place], self.grown[0][place], column[first], _sums(inner.take(order, axis=0), first))


# --- Training and scoring in Spark -------------------------------------------------------


def _chosen(numbers: np.ndarray, sizes: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Places that round ``turn`` of ``rounds`` trains on: every ``rounds``-th of each text, so that all rounds
    together take each place once. The texts' numbers spread where they begin, also for copies."""
    first = (mixed(numbers.astype(np.uint64)) % np.uint64(rounds)).astype(np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)
    return np.flatnonzero(within % rounds == turn)


def train_round(rows: DataFrame, flat: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """One round over its places of encoded documents: a copy of the network for each task, and their mean."""
    model = rows.sparkSession.sparkContext.broadcast(flat)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, places = Trainer(Network.of(model.value)), 0
        for batch in batches:
            held, at = batch.column("ids").to_pylist(), batch.column("at").to_numpy()
            for k in range(0, len(held), 1000):
                ids, sizes = _joined(held[k : k + 1000])
                chosen = _chosen(at[k : k + 1000], sizes, turn, rounds)
                near, target = windows(ids, sizes, chosen), ids[chosen]
                for b in range(0, len(chosen), BATCH):
                    trainer.learn(near[b : b + BATCH], target[b : b + BATCH])
                places += len(chosen)
        if places:
            task = TaskContext.get().partitionId()
            yield from _rows(task, places, trainer.network.flat().astype(np.float64) * places)

    kinds = "piece int, task int, places double, sums binary"
    copies = rows.select("at", "ids").mapInArrow(train, kinds)
    # two steps, so that no task adds up more than a small share of the copies of a piece
    some = copies.withColumn("task", F.floor(F.col("task") / 64).cast("int")).repartition("piece", "task").mapInArrow(_added, kinds)
    sums = some.withColumn("task", F.lit(0)).repartition("piece").mapInArrow(_added, kinds).collect()
    if not sums:
        return flat
    new = np.concatenate([np.frombuffer(r["sums"], np.float32) / r["places"] for r in sorted(sums, key=lambda r: r["piece"])])
    return new.astype(np.float32)


def _rows(task: int, places: float, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for piece in range(0, len(sums), PIECE):
        yield _row(piece // PIECE, task, places, sums[piece : piece + PIECE])


def _row(piece: int, task: int, places: float, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([piece], pa.int32()), pa.array([task], pa.int32()), pa.array([float(places)]), pa.array([sums.astype(np.float32).tobytes()], pa.binary())],
        ["piece", "task", "places", "sums"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each piece and group of tasks; holds one sum for each, not the rows."""
    held: dict[tuple[int, int], tuple[float, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["piece"], row["task"])
            places, sums = held.get(key, (0.0, 0.0))
            held[key] = (places + row["places"], sums + np.frombuffer(row["sums"], np.float32).astype(np.float64))
    for (piece, task), (places, sums) in held.items():
        yield _row(piece, task, places, sums)


def fit(docs: DataFrame, rounds: int = ROUNDS, block_words: int = BLOCK_WORDS) -> tuple[Encoded, np.ndarray]:
    """The encoded documents and the network's weights."""
    all_words = saved(word_counts(docs).withColumn("hash", F.xxhash64("word")), "word-counts")
    top = all_words.orderBy(F.desc("times"), "word").limit(VOCABULARY - OTHERS).collect()
    least = top[-1] if top else {"times": 0, "word": ""}
    others = all_words.where(
        (F.col("times") < least["times"]) | ((F.col("times") == least["times"]) & (F.col("word") > F.lit(least["word"])))
    )
    sums = saved(mark_sums(others), "mark-sums")
    counts = np.zeros(VOCABULARY)
    counts[: len(top)] = [row["times"] for row in top]
    for row in sums.collect():
        counts[VOCABULARY - OTHERS + row["mark"]] = row["total"]
    rows, blocks = encoded(docs, {row["word"]: i for i, row in enumerate(top)}, block_words)
    rest = rest_sums(blocks, others, sums)
    flat = Network.new(counts).flat().astype(np.float32)
    for turn in range(rounds):
        flat = train_round(rows, flat, turn, rounds)
    return Encoded(rows, rest), flat


def scored(rows: Encoded, flat: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, log_likelihood and pseudo_perplexity of each encoded document."""
    model = rows.docs.sparkSession.sparkContext.broadcast(flat)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of(model.value)
        for batch in batches:
            held = batch.column("ids").to_pylist()
            for k in range(0, len(held), 200):
                ids, sizes = _joined(held[k : k + 200])
                near = windows(ids, sizes)
                logs = np.empty(len(ids))
                for b in range(0, len(ids), AT_ONCE):
                    logs[b : b + AT_ONCE] = network.log_probabilities(near[b : b + AT_ONCE], ids[b : b + AT_ONCE])
                owner = np.repeat(np.arange(len(sizes)), sizes)
                given = [batch.column(c).slice(k, len(sizes)) for c in ("block", "at", "doc_id")]
                yield pa.RecordBatch.from_arrays(
                    [*given, pa.array(sizes), pa.array(np.bincount(owner, logs, len(sizes)).astype(float))],
                    ["block", "at", "doc_id", "n_tokens", "marks"],
                )

    marked = rows.docs.select("block", "at", "doc_id", "ids").mapInArrow(score, "block long, at int, doc_id long, n_tokens long, marks double")
    found = marked.join(rows.rest, ["block", "at"]).select("doc_id", "n_tokens", (F.col("marks") + F.col("rest")).alias("log_likelihood"))
    mean = F.when(F.col("n_tokens") > 0, F.exp(-F.col("log_likelihood") / F.col("n_tokens")))
    return found.withColumn("pseudo_perplexity", mean)
