"""Near-duplicate vectors: cross-polytope hashing, then exact cosines of the candidates.

Vectors are compared within one label and one dimension. Equal vectors are collapsed first and counted.
A vector is turned by three rounds of random signs and a fast Hadamard transform; the
coordinate that is largest in size, with its sign, is the corner of the cross-polytope nearest to it.
Three turns together give a bucket. Each of ``TABLES`` tables probes, besides that bucket, those with
the second nearest corner in one of the turns. Vectors that share a bucket in any
table are candidates, and their cosine in double precision decides.

Buckets are compared in blocks of at most two chunks of vectors, however large a bucket is, by
one matrix product each. A pair counts only in the first bucket that it shares, so blocks send sums
per vector and the links that hold their parts together, never pairs.

Vectors that are null, zero, empty, or hold null or non-finite numbers, and vectors without a label, link
with nothing: no links, a component of their own. Rows that repeat are vectors of their own. A null
vec_id takes part; a component without any vec_id is null. Extra columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import components
from tarmac.llm.store import saved
from tarmac.llm.words import mixed

THRESHOLD = 0.93
TABLES = 10
TURNS = 3
CHUNK = 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, size = x.shape
    step = 1
    while step < size:
        x = x.reshape(n, size // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(n, size)


def corners(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest and the second nearest corner after the turn that ``seed`` names."""
    n, d = x.shape
    size = max(2, 1 << (d - 1).bit_length())
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, size))
    turned = np.zeros((n, size))
    turned[:, :d] = x
    for s in signs:
        turned = hadamard(turned * s) / np.sqrt(size)
    by_size = np.argpartition(-np.abs(turned), 1, axis=1)[:, :2]
    rows = np.arange(n)[:, None]
    sizes = np.abs(turned[rows, by_size])
    order = np.argsort(-sizes, axis=1, kind="stable")
    by_size = by_size[rows, order]
    codes = by_size * 2 + (turned[rows, by_size] < 0)
    return codes[:, 0], codes[:, 1]


def buckets(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Hashes of the buckets of each row: [row][table][probe]."""
    out = np.empty((len(x), TABLES, 1 + TURNS), np.uint64)
    ground = mixed(label.astype(np.int64).view(np.uint64) + np.uint64(x.shape[1] << 32))
    for table in range(TABLES):
        found = [corners(x, 1000 * table + turn) for turn in range(TURNS)]
        for probe in range(1 + TURNS):
            key = ground + np.uint64(table)
            for turn, (first, second) in enumerate(found):
                key = mixed(key ^ ((second if probe == turn + 1 else first).astype(np.uint64) + np.uint64(1 + turn * 2**20)))
            out[:, table, probe] = key
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("embedding")
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        dims = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(dims)])
        keys = np.empty((len(dims), TABLES, 1 + TURNS), np.uint64)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            for some in np.array_split(at, max(1, len(at) * int(d) // 2_000_000)):
                x = values[starts[some][:, None] + np.arange(d)].astype(float)
                keys[some] = buckets(x, labels[some])
        flat = keys.reshape(len(dims), -1).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("node", "label", "copies", "embedding")] + [pa.array(list(flat), pa.list_(pa.int64()))],
            ["node", "label", "copies", "embedding", "buckets"],
        )


def block(vectors: np.ndarray, other: np.ndarray | None, threshold: float) -> np.ndarray:
    """Which rows of one set reach the threshold with which of another; None: with later rows of the same."""
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    if other is None:
        return np.triu(x @ x.T >= threshold, 1)
    return x @ (other / np.linalg.norm(other, axis=1, keepdims=True)).T >= threshold


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of pairs the first bucket that both have: the smallest of the first table with one."""
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), 4096):
        x, y = (m[k : k + 4096].reshape(-1, TABLES, 1 + TURNS) for m in (a, b))
        same = x[:, :, :, None] == y[:, :, None, :]
        table = same.any(axis=(2, 3)).argmax(axis=1)
        rows = np.arange(len(x))
        held = same[rows, table].any(axis=2)
        out[k : k + 4096] = np.where(held, x[rows, table], np.iinfo(np.int64).max).min(axis=1)
    return out


def _parts(mask: np.ndarray) -> np.ndarray:
    """The smallest row that each row is linked to, through any others, by a symmetric mask."""
    part = np.arange(len(mask))
    while True:
        near = np.where(mask, part[None, :], len(mask)).min(axis=1)
        new = np.minimum(part, near)
        new = new[new]
        if (new == part).all():
            return part
        part = new


def _compared(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        rows_out: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["bucket"], row["i"], row["j"]) != (held[0]["bucket"], held[0]["i"], held[0]["j"]):
                    rows_out += compare(held, threshold)
                    held = []
                held.append(row)
            if len(rows_out) > 10_000:
                yield _links(rows_out)
                rows_out = []
        yield _links(rows_out + compare(held, threshold))

    return run


def compare(rows: list[dict], threshold: float) -> list[tuple[int, int, int]]:
    """One block: for each row with a link (node, linked vectors that count here, a node of its part)."""
    if len(rows) < 2:
        return []
    nodes = np.array([r["node"] for r in rows])
    copies = np.array([r["copies"] for r in rows])
    chunk = np.array([r["chunk"] for r in rows])
    labels = np.array([r["label"] for r in rows])
    dims = np.array([len(r["embedding"]) for r in rows])
    same = (labels[:, None] == labels) & (dims[:, None] == dims)
    if rows[0]["i"] != rows[0]["j"]:
        same &= chunk[:, None] != chunk
    mask = np.zeros((len(rows), len(rows)), bool)
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        x = np.array([rows[k]["embedding"] for k in at], float)
        mask[np.ix_(at, at)] = block(x, None, threshold)
    mask &= same
    one, two = np.nonzero(mask)
    if not len(one):
        return []
    codes = np.array([r["buckets"] for r in rows], np.int64)
    counts = first_shared(codes[one], codes[two]) == rows[0]["bucket"]
    links = np.bincount(one[counts], copies[two[counts]], len(rows)) + np.bincount(two[counts], copies[one[counts]], len(rows))
    part = _parts(mask | mask.T)
    linked = mask.any(axis=0) | mask.any(axis=1)
    return [(int(nodes[k]), int(links[k]), int(nodes[part[k]])) for k in np.flatnonzero(linked)]


def _links(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "other"])


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row for each row of ``embeddings``."""
    rows = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    whole = rows.where(valid)
    distinct = whole.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    distinct = saved(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")

    kinds = "node long, label long, copies long, embedding array<double>, buckets array<long>"
    hashed = saved(distinct.select("node", "label", "copies", "embedding").mapInArrow(_hashed, kinds), "hashed-vectors")
    entries = hashed.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    full = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    dealt = entries.join(full, "bucket").select(
        "node", "bucket", F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("k")
    )
    blocks = dealt.join(hashed, "node").select(
        "bucket", F.least("chunk", "k").alias("i"), F.greatest("chunk", "k").alias("j"), "chunk", "node", "label", "copies", "embedding", "buckets"
    )
    found = saved(
        blocks.repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j", "node")
        .mapInArrow(_compared(threshold), "node long, links long, other long"),
        "vector-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    parts = (
        distinct.select("label", "embedding", "least", "copies", "node")
        .join(groups, "node", "left")
        .join(links, "node", "left")
        .withColumn("part", F.coalesce("component", "node"))
    )
    least = parts.groupBy("part").agg(F.min("least").alias("component_id"))
    known = parts.join(least, "part").select(
        F.col("label").alias("_label"),
        F.col("embedding").alias("_embedding"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id",
    )
    linked = whole.join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))).select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where(~valid).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
