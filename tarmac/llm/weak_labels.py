"""A quality classifier learnt without labels.

Heuristic labellers each look at one side of a text and vote good, bad or nothing. Documents
with the same votes are counted together, so there are at most 3 to the number of labellers
rows of counts, over all documents. On these expectation-maximisation estimates how often each
labeller votes what on good and on bad documents, and the share of bad ones. The resulting
probability of a document's votes is then the label from which a linear scorer on hashed
features of the words is trained, on a sample of at most ``sample`` distinct documents, where one that
repeats is likelier to be drawn and weighs as often; the scorer judges the text itself and not the votes.

Null and empty texts have no features: they get the scorer's bias, and no labeller votes.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import measure
from tarmac.llm.remembered import begin, kept_for

# Name to (bad, good); what is neither gets no vote. Texts of fewer than ten words get none.
LABELLERS: dict[str, tuple[str, str]] = {
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    "pipes": ("10 * n_pipes > n_words", "n_pipes = 0"),
    "capitals": ("5 * n_upper_words > n_words", "20 * n_upper_words < n_words"),
    "repeated": ("5 * n_repeat_words > 2 * n_words", "10 * n_repeat_words < n_words"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    "same": ("20 * n_same_words > n_words", "50 * n_same_words < n_words"),
    "distinct": ("10 * n_distinct_words < 3 * n_words", "2 * n_distinct_words > n_words"),
    "stops": ("50 * n_stops < n_words or 2 * n_stops > n_words", "30 * n_stops > n_words and 3 * n_stops < n_words"),
}
BUCKETS = 1 << 14
SAMPLE = 20_000
CUT_OFF = 0.5


def vote(bad: str, good: str) -> Column:
    enough = F.col("n_words") >= 10
    return (
        F.when(enough & F.expr(bad), F.lit(1)).when(enough & F.expr(good), F.lit(2)).otherwise(F.lit(0)).cast("int")
    )


def voted(docs: DataFrame) -> DataFrame:
    """doc_id and one column of votes per labeller: 0 none, 1 bad, 2 good."""
    counts = docs.select("doc_id", "text").mapInArrow(measure.measured, measure.SCHEMA)
    return counts.select("doc_id", *(vote(*rule).alias(name) for name, rule in LABELLERS.items()))


@dataclass
class LabelModel:
    """One kind of good documents and, for each labeller, one kind of bad ones: what makes a document
    bad differs, and labellers that look for other faults then have nothing to say."""

    shares: np.ndarray  # of the kinds, the good one first
    table: np.ndarray  # [kind][labeller][vote], log probabilities of the votes given; 0 for no vote

    def kinds(self, votes: np.ndarray) -> np.ndarray:
        """Probability of each kind for rows of votes."""
        at = np.arange(votes.shape[1])
        logs = self.table[:, at[None, :], votes].sum(axis=2).T + np.log(self.shares)
        chance = np.exp(logs - logs.max(axis=1, keepdims=True))
        return chance / chance.sum(axis=1, keepdims=True)

    def bad(self, votes: np.ndarray) -> np.ndarray:
        return 1 - self.kinds(votes)[:, 0]

    def accuracy(self) -> np.ndarray:
        """[labeller][class: good, bad][vote - 1]: how often each labeller, if it votes, votes what."""
        p = np.exp(self.table[:, :, 1:])
        bad = np.tensordot(self.shares[1:], p[1:], 1) / self.shares[1:].sum()
        return np.stack([p[0], bad], axis=1)


def label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over distinct rows of votes and how often each occurs.

    It starts from: a document is of the kind of the first labeller that calls it bad, else good.
    Labellers are taken for cautious: a prior of one in two hundred documents says that they don't
    call good ones bad. No vote says nothing, and no document is of the kind of a labeller that
    calls it good; otherwise the kinds of bad documents could share the good ones among themselves.
    Without any votes everything is good.
    """
    n = len(LABELLERS)
    if not len(votes):
        return LabelModel(np.array([1.0] + [1e-9] * n), np.full((n + 1, n, 3), [0.0, *np.log([0.5, 0.5])]))
    called = votes == 1
    first = np.where(called.any(axis=1), called.argmax(axis=1) + 1, 0)
    p = np.full((len(votes), n + 1), 0.05 / n)
    p[np.arange(len(votes)), first] = 0.95
    model = LabelModel(np.ones(n + 1), np.zeros((n + 1, n, 3)))
    for _ in range(rounds):
        weights = p * counts[:, None]
        for kind in range(n + 1):
            for j in range(n):
                seen = np.bincount(votes[:, j], weights[:, kind], 3)[1:] + 0.1
                if kind == 0:
                    seen[1] += counts.sum() / 200
                elif kind == j + 1:
                    seen[1] = 1e-6 * seen[0]
                model.table[kind, j, 1:] = np.log(seen / seen.sum())
        model.shares = (weights.sum(axis=0) + 0.1) / (weights.sum() + 0.1 * (n + 1))
        p = model.kinds(votes)
    return model


_RUNS = re.compile(r"[^\W\d_]+|\d+")


@lru_cache(maxsize=100_000)
def word_bucket(word: str) -> int:
    """The feature of one word: its shape, that is letters and digits folded, marks as they are."""

    def fold(m: re.Match) -> str:
        run = m.group()
        return "0" if run[0].isdigit() else "A" if len(run) > 1 and run.isupper() else "a"

    return xxhash.xxh3_64_intdigest(_RUNS.sub(fold, word)[:12]) % BUCKETS


kept_for("weak labels", word_bucket.cache_clear)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text: buckets, and shares of the words that fall there."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    seen = Counter(map(word_bucket, words))
    distinct = Counter(words)
    n = len(words)
    more = {
        "=": sum(a == b for a, b in zip(words, words[1:])) / n,
        "often": sum(k for k in distinct.values() if k > max(3, n // 8)) / n,
        "few": 1 - len(distinct) / n,
    }
    buckets = np.fromiter(seen.keys(), np.int64, len(seen))
    shares = np.fromiter(seen.values(), np.float64, len(seen)) / n
    extra = np.array([xxhash.xxh3_64_intdigest(f"\0{k}") % BUCKETS for k in more], np.int64)
    return np.concatenate([buckets, extra]), np.concatenate([shares, np.array(list(more.values()))])


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def bad(self, texts) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            buckets, shares = features(text)
            out[i] = self.bias + self.weights[buckets] @ shares
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, times: np.ndarray | None = None, epochs: int = 60) -> Scorer:
    """Logistic regression on sparse rows, each of which stands for ``times`` documents (on average 1 after
    scaling), by adaptive gradient steps over batches."""
    weights, grown, bias, bias_grown = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8), 0.0, 1e-8
    if not len(labels):
        return Scorer(weights, -5.0)
    sizes = np.array([len(b) for b, _ in rows])
    buckets = np.concatenate([b for b, _ in rows])
    shares = np.concatenate([s for _, s in rows])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    order = np.random.default_rng(7)
    # both classes weigh the same, but a rare class at most twenty times itself
    times = np.ones(len(labels)) if times is None else times / times.mean()
    share = np.clip((labels * times).mean(), 0.05, 0.95)
    weight = np.where(labels > 0.5, 0.5 / share, 0.5 / (1 - share)) * times
    for epoch in range(epochs):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 256)):
            at = np.concatenate([np.arange(begins[k], begins[k + 1]) for k in part])
            who = np.repeat(np.arange(len(part)), sizes[part])
            z = bias + np.bincount(who, weights[buckets[at]] * shares[at], len(part))
            error = weight[part] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels[part]) / len(part)
            step = np.bincount(buckets[at], error[who] * shares[at], BUCKETS) + 1e-6 * weights
            grown += step * step
            weights -= 0.5 * step / np.sqrt(grown)
            bias_grown += error.sum() ** 2
            bias -= 0.5 * error.sum() / np.sqrt(bias_grown)
    return Scorer(weights, float(bias))


def draw(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and ``weight`` of at most ``sample`` distinct rows (doc_id, text).

    Drawn are those with the smallest quotient of a hash and how often the row occurs; with the next
    quotient as the limit, a row weighs its times over those that the limit lets through, and at least 1.
    """
    cells = 1 << 40
    content = F.xxhash64("doc_id", "text").alias("content")
    counted = docs.select(content).groupBy("content").agg(F.count("*").alias("times"))
    hashed = (F.pmod(F.xxhash64("content", F.lit(1)), F.lit(cells)) + 1) / F.lit(float(cells))
    first = counted.select("content", "times", (hashed / F.col("times")).alias("rank")).orderBy("rank", "content").limit(sample + 1).collect()
    limit = first[sample]["rank"] if len(first) > sample else 1.0
    chosen = [(r["content"], max(1.0, r["times"] * limit) if len(first) > sample else float(r["times"])) for r in first[:sample]]
    weights = docs.sparkSession.createDataFrame(chosen, "content long, weight double")
    rows = docs.select(content, "text").join(F.broadcast(weights), "content")
    return rows.groupBy("content").agg(F.first("text").alias("text"), F.first("weight").alias("weight")).select("text", "weight")


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, Scorer]:
    """The label model from all documents; the scorer from at most ``sample`` distinct ones, drawn by a
    hash of their content."""
    names = list(LABELLERS)
    patterns = voted(docs).groupBy(*names).count().collect()  # at most 3 ** len(LABELLERS) rows
    votes = np.array([[row[n] for n in names] for row in patterns], np.int64).reshape(-1, len(names))
    counts = np.array([row["count"] for row in patterns], float)
    labels = label_model(votes, counts)
    bad_by_votes = {tuple(v): float(p) for v, p in zip(votes.tolist(), labels.bad(votes))}
    drawn = draw(docs, sample)

    conditions = [vote(*rule).alias(name) for name, rule in LABELLERS.items()]

    def with_counts(batches):
        begin("weak labels")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [measure.measure(t) for t in texts]
            found = [features(t) for t in texts]
            columns = list(zip(*rows)) or [()] * len(measure.COUNTS)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, pa.int64()) for c in columns),
                    pa.array([b.tolist() for b, _ in found], pa.list_(pa.int64())),
                    pa.array([s.tolist() for _, s in found], pa.list_(pa.float64())),
                    batch.column("weight"),
                ],
                [*measure.COUNTS, "buckets", "shares", "weight"],
            )

    kinds = ", ".join(f"{n} long" for n in measure.COUNTS) + ", buckets array<long>, shares array<double>, weight double"
    rows = drawn.mapInArrow(with_counts, kinds).select(*conditions, "buckets", "shares", "weight").collect()
    scorer = train(
        [(np.array(r["buckets"], np.int64), np.array(r["shares"], float)) for r in rows],
        np.array([bad_by_votes[tuple(r[n] for n in names)] for r in rows], float),
        np.array([r["weight"] for r in rows], float),
    )
    return labels, scorer


def bad_score(spark, scorer: Scorer):
    """A column function: text to the probability that the document is bad."""
    held = spark.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        begin("weak labels")
        return pd.Series(held.value.bad(texts))

    return score
