"""Clusters of integer vectors, with distances read from tables of scalars.

Components become integers, ``floor(scale * x)``. Vectors are staged once in blocks; a block keeps,
for each dimension, the integers that occur in it and for each vector the places of its
components among them. In a round a task tabulates, for each dimension, occurring integer and
centroid, the squared difference; the distances of a block are then gathers from that table, summed over
the dimensions. Tables are as long as the block has different components, so memory is bounded
by ``BLOCK_ROWS`` whatever values occur. All arithmetic is in 64-bit integers and exact.

A task sends one row for each cluster and dimension, and the driver gets clusters x dimensions sums
a round. Final distances are staged once and summed by cluster.

Vectors that are null, of another length than ``dims``, or with null or non-finite components take no part. Equal
rows are separate vectors. The first centroids are the ``k`` vectors with the smallest hash of their
id (a null id counts as empty text); vectors of equal hash are taken in the order of their components. With fewer
vectors than ``k`` there are as many centroids as vectors, and equal centroids
leave the later ones empty. An empty table gives an empty result. Columns other than vec_id and the
vector are not read. A component of 2**27 or more in absolute value after scaling raises an error, as
squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.operators.staging import stage

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Vectors in a block, so that places among its integers fit 16 bits.
BLOCK_ROWS = 4096
_LARGEST = 1 << 27
_BLOCK = "ids array<long>, places binary, integers array<long>, ends array<int>"
_SUMS = "cluster int, dim int, total long, n long"
_RESULT = "vec_id long, cluster int, distance long"


def whole(vector: str | Column) -> Column:
    """Whether a vector has only finite components."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def integer_vectors(table: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """vec_id and x (array of long) of the rows that take part."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where((F.size("x") == dims) & whole("x"))
    small = F.forall("x", lambda c: F.abs(c) * scale < _LARGEST)
    checked = F.when(small, F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))).otherwise(
        F.raise_error(F.concat(F.lit("component too large in vector "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    )
    return rows.select("vec_id", checked.alias("x"))


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """places (dims x rows), the integers of all dimensions one after another, and where each dimension's end."""
    places, integers, ends = np.empty(x.T.shape, np.uint16), [], []
    for d, column in enumerate(x.T):
        found, place = np.unique(column, return_inverse=True)
        places[d] = place
        integers.append(found)
        ends.append(len(found))
    return places, np.concatenate(integers), np.cumsum(ends)


def _blocks(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = part["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                places, integers, ends = encoded(x)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part["vec_id"])
                columns = [ids, pa.array([places.tobytes()]), pa.array([integers]), pa.array([ends.astype(np.int32)])]
                yield pa.record_batch(columns, ["ids", "places", "integers", "ends"])

    return run


def nearest(places: np.ndarray, integers: np.ndarray, ends: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector of a block (ties: the smaller number), and its vectors (dims x rows)."""
    starts = np.concatenate([[0], ends[:-1]])
    dim_of = np.repeat(np.arange(len(ends)), ends - starts)
    table = (integers[:, None] - centroids.T[dim_of]) ** 2
    at = places + starts[:, None]
    distances = np.zeros((places.shape[1], len(centroids)), np.int64)
    for row in at:
        distances += table[row]
    cluster = distances.argmin(1)
    return cluster, distances[np.arange(len(cluster)), cluster], integers[at]


def _decoded(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for k in range(batch.num_rows):
        ids = batch["ids"][k].values
        places = np.frombuffer(batch["places"][k].as_py(), np.uint16).reshape(dims, -1)
        integers = batch["integers"][k].values.to_numpy(zero_copy_only=False)
        yield ids, places, integers, batch["ends"][k].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _sums(blocks: DataFrame, centroids: np.ndarray) -> list:
    """Componentwise sums and sizes of the clusters around the given centroids: at most clusters x dimensions rows."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, sizes = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, places, integers, ends in _decoded(batch, dims):
                cluster, _, vectors = nearest(places, integers, ends, centroids)
                for c in range(k):
                    totals[c] += vectors[:, cluster == c].sum(1)
                sizes += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(sizes)
        columns = [np.repeat(used, dims).astype(np.int32), np.tile(np.arange(dims, dtype=np.int32), len(used))]
        columns += [totals[used].ravel(), np.repeat(sizes[used], dims)]
        yield pa.record_batch([pa.array(c) for c in columns], ["cluster", "dim", "total", "n"])

    sums = blocks.mapInArrow(run, _SUMS).groupBy("cluster", "dim")
    return sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.orderBy(F.sha2(name, 256), "x").limit(k).collect()
    return np.array([r["x"] for r in chosen], np.int64)


def cluster_vectors(
    table: DataFrame,
    vector: str = "embedding",
    dims: int = DIMS,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = 3,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    vectors = integer_vectors(table, vector, dims, scale)
    centroids = first_centroids(vectors, k, seed)
    blocks = stage(vectors.mapInArrow(_blocks(dims), _BLOCK), "integer_blocks")
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for r in _sums(blocks, centroids):
            moved[r["cluster"], r["dim"]] = r["total"] // r["n"]
        if (moved == centroids).all():
            break  # further rounds would change nothing
        centroids = moved

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, *block in _decoded(batch, dims):
                cluster, distance, _ = nearest(*block, centroids)
                columns = [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.record_batch(columns, ["vec_id", "cluster", "distance"])

    assigned = stage(blocks.mapInArrow(run, _RESULT), "assigned")
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def by_cluster(values: dict, kind: str) -> Column:  # at most k values
        pairs = [F.lit(x) for c, v in values.items() for x in (c, v)]
        return F.element_at(F.create_map(*pairs), F.col("cluster")).cast(kind) if pairs else F.lit(None).cast(kind)

    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(sums, "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        by_cluster(dict(enumerate(digests)), "string").alias("centroid_sha256"),
    )
