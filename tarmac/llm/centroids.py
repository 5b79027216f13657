"""Centroid clustering over dictionaries of subvectors, in whole numbers.

Each vector's components become the integers floor(1024 x). The dimensions are cut into blocks, and the vectors, dealt into
chunks, are stored with a dictionary for each block: the chunk's distinct subvectors there and, for each vector, the
code of its own. Nothing is lost by it. A round computes the exact squared distances of each distinct subvector to
each centroid once; a vector's distance is the sum over its codes, and the sum of a cluster's vectors is the
sum of its subvectors times how often they occur. Equal vectors, and equal parts of them, are dealt to the same chunks
as far as their number allows, so that repeated ones cost a code.

A round is one pass over the chunks without a join; only counts and sums, one row for each task and cluster, are
shuffled, and only the centroids come to the driver. Nothing depends on the order of rows.

Vectors that are null, of another length, or with a null or non-finite component are left out. Rows that repeat are
vectors of their own. A null id is kept and clustered, but no centroid starts from it. With fewer vectors than
centroids there are as many centroids as vectors with an id, and without any no vector has a cluster: the result is
then empty. Components beyond 2 ** 17 in size are an error, as distances would leave the range of a long.
Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import saved

SCALE = 1024
LARGEST = SCALE * 2**17
CHUNK = 8192  # vectors, so that a code has two bytes
PARTS = 16  # a vector that is most of the table goes to so many places


def kept_vectors(vectors: DataFrame, size: int) -> DataFrame:
    """vec_id and embedding of vectors with ``size`` finite components."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.where((F.size(x) == size) & fine).select("vec_id", "embedding")


def whole(embedding: str = "embedding") -> Column:
    """The components as whole numbers."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE)).alias("v")


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of seed and id; equal rows are vectors of their own."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id is not null").orderBy(by_hash, "embedding").limit(k).select(whole()).collect()
    return np.array([row.v for row in rows], np.int64)


class Chunk:
    """Some vectors: for each block its distinct subvectors, and a code into them for each vector."""

    def __init__(self, ids: pa.Array, dictionaries: list[np.ndarray], codes: np.ndarray):
        self.ids, self.dictionaries, self.codes = ids, dictionaries, codes

    @classmethod
    def of(cls, ids: pa.Array, vectors: np.ndarray, block: int) -> Chunk:
        if vectors.size and max(vectors.max(), ~vectors.min()) > LARGEST:
            raise ValueError(f"a component is beyond {LARGEST // SCALE}")
        dictionaries, codes = [], []
        for at in range(0, vectors.shape[1], block):
            part = np.ascontiguousarray(vectors[:, at : at + block])
            # distinct rows by their bytes: cheaper than comparing component by component
            raw = part.view(np.dtype((np.void, part.dtype.itemsize * part.shape[1]))).ravel()
            _, first, code = np.unique(raw, return_index=True, return_inverse=True)
            dictionaries.append(part[first])
            codes.append(code.astype(np.int32))
        return cls(ids, dictionaries, np.array(codes, np.int32).reshape(len(codes), len(ids)))

    def row(self) -> dict:
        return {
            "ids": self.ids,
            "sizes": [len(d) for d in self.dictionaries],
            "subvectors": np.concatenate([d.ravel() for d in self.dictionaries]).astype("<i4").tobytes(),
            "codes": self.codes.astype("<u2").tobytes(),
        }

    @classmethod
    def from_row(cls, ids: pa.Array, sizes: list[int], subvectors: bytes, codes: bytes, dims: int, block: int) -> Chunk:
        flat, dictionaries, at = np.frombuffer(subvectors, "<i4").astype(np.int64), [], 0
        for size, begin in zip(sizes, range(0, dims, block)):
            width = min(block, dims - begin)
            dictionaries.append(flat[at : at + size * width].reshape(size, width))
            at += size * width
        return cls(ids, dictionaries, np.frombuffer(codes, "<u2").reshape(len(sizes), len(ids)))

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's cluster (of equal distances the smaller number) and squared distance."""
        total = np.zeros((len(self.ids), len(centroids)), np.int64)
        at = 0
        for dictionary, code in zip(self.dictionaries, self.codes):
            width = dictionary.shape[1]
            apart = dictionary[:, None, :] - centroids[None, :, at : at + width]
            total += (apart * apart).sum(axis=2)[code]
            at += width
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster's vectors, from how often it has each code."""
        out = []
        for dictionary, code in zip(self.dictionaries, self.codes):
            n = len(dictionary)
            times = np.bincount(cluster * n + code.astype(np.int64), minlength=k * n).reshape(k, n)
            out.append(times @ dictionary)
        return np.concatenate(out, axis=1)


def chunked(kept: DataFrame, dims: int, block: int) -> DataFrame:
    """The vectors as a stored table of chunks."""
    same = F.xxhash64("embedding")
    dealt = same, F.pmod(F.xxhash64("vec_id"), F.lit(PARTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.slice(at, CHUNK)
                flat = part.column("v").flatten().to_numpy()
                chunk = Chunk.of(part.column("vec_id"), flat.reshape(len(part), dims), block)
                yield pa.RecordBatch.from_pylist([chunk.row() | {"ids": chunk.ids.to_pylist()}], schema=_CHUNKS)

    rows = kept.repartition(*dealt).sortWithinPartitions(same).select("vec_id", whole())
    return saved(rows.mapInArrow(run, "ids array<long>, sizes array<int>, subvectors binary, codes binary"), "chunks")


_CHUNKS = pa.schema(
    [("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("subvectors", pa.binary()), ("codes", pa.binary())]
)


def _each(batches: Iterator[pa.RecordBatch], dims: int, block: int) -> Iterator[Chunk]:
    for batch in batches:
        ids = batch.column("ids")
        for k, (sizes, subvectors, codes) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("sizes", "subvectors", "codes")))):
            yield Chunk.from_row(ids[k].values, sizes, subvectors, codes, dims, block)


def moved(chunks: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """The centroids after a round: the floor of the mean of each cluster's vectors; empty ones stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for chunk in _each(batches, dims, block):
            cluster, _ = chunk.nearest(centroids)
            counts += np.bincount(cluster, minlength=k)
            sums += chunk.sums(cluster, k)
        cluster, dim = (x.ravel() for x in np.indices((k, dims)))
        used = counts[cluster] > 0
        columns = [cluster, dim, counts[cluster], sums.ravel()]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[used], kind) for c, kind in zip(columns, kinds)], ["cluster", "dim", "vectors", "total"]
        )

    parts = chunks.mapInArrow(run, "cluster int, dim int, vectors long, total long")
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    out = centroids.copy()
    for row in parts.groupBy("cluster", "dim").agg(F.sum("vectors").alias("vectors"), total.alias("total")).collect():
        out[row.cluster, row.dim] = int(row.total) // row.vectors
    return out


def assigned(chunks: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """vec_id, cluster and squared distance of each vector."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _each(batches, dims, block):
            cluster, distance = chunk.nearest(centroids)
            yield pa.RecordBatch.from_arrays(
                [chunk.ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, block: int = 4, seed: int = 3
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance of each vector after so many rounds, and the centroids."""
    kept = kept_vectors(vectors, dims)
    chunks = chunked(kept, dims, block)
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        nothing = kept.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return nothing, np.empty((0, dims), np.int64)
    for _ in range(rounds):
        centroids = moved(chunks, centroids, block)
    return assigned(chunks, centroids, block), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """At each vector its cluster's summed distances, those of all, and the cluster's centroid."""
    found = saved(found, "clusters")
    sums = {row.cluster: row.inertia for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    clusters = [(c, sums[c], sum(sums.values()), centroids[c].tolist()) for c in sums]
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    # a row for each centroid
    return found.join(F.broadcast(found.sparkSession.createDataFrame(clusters, schema)), "cluster")
