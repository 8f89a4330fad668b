"""Centroid clustering on integer vectors by subvector dictionaries.

Components become whole numbers, ``floor(scale * x)``. Every shard of vectors is
encoded once, without loss: for each block of ``BLOCK`` dimensions, the distinct
subvectors of the shard and a code for each vector. In a round, the squared
distances of a dictionary's subvectors to all centroids are computed once, a
vector's distance is the sum of its codes' partial distances, and the sums of a
cluster come from counts of codes. All of it is exact in 64-bit integers.

Shards are cut where the vectors are read, at ``SHARD`` vectors, and written to
the shared folder; a round reads them, and sends one row of sums per cluster and
shard into a map-side combined grouping. Only ``k`` centroids, a fixed size, pass
through the driver. Equal vectors share their codes wherever they lie; no key or
group is gathered.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercaflow.llm.storage import stored

#: Vectors of a shard: the unit of work and memory.
SHARD = 1 << 14
#: Dimensions of a block.
BLOCK = 2
#: Whole components beyond this could pass 64 bits in a squared distance.
LARGEST = 1 << 27
_SHARD_SCHEMA = "vec_ids binary, missing binary, sizes array<int>, subvectors binary, codes binary"


def _whole(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``whole``: the usable vectors in whole numbers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    fits = F.forall("whole", lambda v: (v > -LARGEST) & (v < LARGEST))
    error = F.raise_error(F.lit(f"a component beyond {LARGEST} does not fit 64-bit distances"))
    # Where sizes differ there is nothing to transform; the order of a filter's parts is not given.
    usable = vectors.filter(F.coalesce(F.size(x) == dims, F.lit(False))).filter(finite)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("whole")).withColumn(
        "whole", F.when(fits, F.col("whole")).otherwise(error)
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _encoded(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    ids, missing, rows, held = [], [], [], 0

    def shard() -> pa.RecordBatch:
        whole = np.concatenate(rows)
        sizes, subvectors, codes = [], [], []
        for first in range(0, dims, BLOCK):
            part = np.ascontiguousarray(whole[:, first : first + BLOCK])
            distinct, code = np.unique(part, axis=0, return_inverse=True)
            sizes.append(len(distinct))
            subvectors.append(distinct.ravel())
            codes.append(code.ravel().astype(np.uint16))
        values = [
            np.concatenate(ids).tobytes(),
            np.packbits(np.concatenate(missing)).tobytes(),
            sizes,
            np.concatenate(subvectors).tobytes(),
            np.concatenate(codes).tobytes(),
        ]
        kinds = [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        names = ["vec_ids", "missing", "sizes", "subvectors", "codes"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        for first in range(0, batch.num_rows, SHARD):
            piece = batch.slice(first, SHARD)
            if held and held + piece.num_rows > SHARD:
                yield shard()
                ids, missing, rows, held = [], [], [], 0
            ids.append(piece.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            missing.append(piece.column(0).is_null().to_numpy(zero_copy_only=False))
            rows.append(_matrix(piece.column(1), dims))
            held += piece.num_rows
    if held:
        yield shard()


class _Shard:
    """A shard's dictionaries and codes, as views of its row."""

    def __init__(self, row: dict, dims: int) -> None:
        self.ids = np.frombuffer(row["vec_ids"], dtype=np.int64)
        n = len(self.ids)
        self.missing = np.unpackbits(np.frombuffer(row["missing"], dtype=np.uint8), count=n).astype(bool)
        self.codes = np.frombuffer(row["codes"], dtype=np.uint16).reshape(-1, n)
        flat, at, self.blocks = np.frombuffer(row["subvectors"], dtype=np.int64), 0, []
        for first, size in zip(range(0, dims, BLOCK), row["sizes"]):
            width = min(BLOCK, dims - first)
            self.blocks.append((first, flat[at : at + size * width].reshape(size, width)))
            at += size * width

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid (the first of equals) and its distance."""
        total = np.zeros((len(self.ids), len(centroids)), np.int64)
        for (first, distinct), code in zip(self.blocks, self.codes):
            gap = distinct[:, None, :] - centroids[None, :, first : first + distinct.shape[1]]
            total += np.einsum("dkw,dkw->dk", gap, gap)[code]
        cluster = total.argmin(axis=1)
        return cluster.astype(np.int32), total[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """Per cluster the number of vectors and their sum, from counts of codes."""
        sums = np.zeros((k, dims), np.int64)
        for (first, distinct), code in zip(self.blocks, self.codes):
            pairs, counts = np.unique(cluster.astype(np.int64) * len(distinct) + code, return_counts=True)
            of, subvector = np.divmod(pairs, len(distinct))
            np.add.at(sums[:, first : first + distinct.shape[1]], of, distinct[subvector] * counts[:, None])
        return np.bincount(cluster, minlength=k), sums


def _rows(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[_Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Shard(batch.slice(i, 1).to_pylist()[0], dims)


def _moved(shards: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; one without vectors stays."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _rows(batches, dims):
            cluster, _ = shard.nearest(centroids)
            counts, total = shard.sums(cluster, k, dims)
            some = np.flatnonzero(counts)
            columns = [some.astype(np.int32), counts[some], *total[some].T]
            names = ["cluster", "n", *(f"s{i}" for i in range(dims))]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    parts = [f"s{i}" for i in range(dims)]
    schema = ", ".join(["cluster int", "n long", *(f"{p} long" for p in parts)])
    summed = shards.mapInArrow(sums, schema).groupBy("cluster").agg(F.sum("n"), *(F.sum(p) for p in parts))
    moved = centroids.copy()
    for row in summed.collect():
        moved[row[0]] = np.array(row[2:], dtype=np.int64) // row[1]
    return moved


def first_centroids(whole: DataFrame, k: int, order: Column) -> np.ndarray:
    """The ``k`` vectors that come first by ``order``; ties by their components."""
    chosen = whole.orderBy(order.asc_nulls_last(), "whole").limit(k).collect()
    return np.array([row["whole"] for row in chosen], dtype=np.int64)


def cluster_vectors(
    vectors: DataFrame, order: Column, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256
) -> tuple[DataFrame, np.ndarray]:
    """Assigns the vectors of ``vectors`` (``vec_id``, ``embedding``) to the
    nearest of ``k`` centroids: ``vec_id``, ``cluster`` and ``distance`` (squared),
    and the final centroids.

    The first centroids are the vectors that come first by ``order``; where there
    are fewer than ``k`` vectors, each is one. A tie goes to the smaller number, an
    empty cluster keeps its centroid. Vectors that are null, not of ``dims``
    components, or hold a null or a component that isn't finite take no part.
    A null ``vec_id`` is a vector like others, its id stays null; repeated ids and
    equal vectors are rows of their own. Components so large that a distance would
    not fit 64 bits raise an error. An empty table gives no rows and no centroids.
    """
    whole = _whole(vectors, dims, scale)
    centroids = first_centroids(whole, k, order)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    shards = stored(whole.mapInArrow(lambda batches: _encoded(batches, dims), _SHARD_SCHEMA), "vector_shards")
    for _ in range(rounds):
        centroids = _moved(shards, centroids)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _rows(batches, dims):
            cluster, distance = shard.nearest(centroids)
            ids = pa.array(shard.ids, mask=shard.missing)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    found = shards.mapInArrow(assigned, "vec_id long, cluster int, distance long")
    return stored(found, "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the distances summed by cluster and over all, and the
    digest of each final centroid."""
    sums = {row[0]: row[1] for row in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    rows = [
        (i, sums[i], sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
        if i in sums
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    of_cluster = assigned.sparkSession.createDataFrame(rows, schema)
    # One row for each centroid at most.
    return assigned.join(F.broadcast(of_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
