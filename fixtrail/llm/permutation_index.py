"""Approximate nearest neighbours with a permutation index.

A vector is represented by its ``prefix`` nearest pivots, in order. The index is cut into shards of
about ``shard_rows`` vectors; within a shard every pivot has an inverted file of (vector,
position). A query walks the files of its own pivots and adds up how much nearer than two unrelated
orders each vector is in Spearman's footrule distance; the ``candidates`` nearest vectors of the shard
(and all that tie with the last) are ranked again by their exact inner product. The best of all
shards are merged. Queries meet shards in blocks, so a task holds one shard and one block of queries.

The pivots are a hash sample of ``pivots`` vectors; every vector is indexed. For the largest inner product,
vectors get one more component that makes all lengths equal, so that nearness of direction and of
product agree. Equal vectors are indexed and searched once and expanded at the end, so a vector that
many rows share costs as much as any other, and ties among its rows go to the smallest ids exactly.

Rows whose vector is null, empty, zero, holds null or non-finite components or differs in length from
most, and rows without id, take no part. Rows of equal id and vector count once. An empty table gives
an empty result; with fewer candidates than ``k`` all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fixtrail.operators.staging import stage

PIVOTS = 256
PREFIX = 96
SHARD_ROWS = 16384
QUERY_ROWS = 4096
CANDIDATES = 800
K = 20
_SALTS = 64


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; all lengths are equal, so by inner product."""
    near = vectors @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with a component that brings every length to ``longest``."""
    rest = longest**2 - (vectors**2).sum(1)
    return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0.0))])


class Shard:
    """The pivot inverted files of some vectors."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, longest: float, prefix: int) -> None:
        self.vectors = vectors
        self._prefix = prefix
        near = orders(lifted(vectors, longest), pivots, prefix)
        width = near.shape[1]
        by_pivot = np.argsort(near.ravel(), kind="stable")
        ends = np.searchsorted(near.ravel()[by_pivot], np.arange(len(pivots) + 1))
        rows, places = by_pivot // width, (by_pivot % width).astype(np.int32)
        self._files = [(rows[a:b], places[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def candidates(self, order: np.ndarray, most: int) -> np.ndarray:
        """Rows of the shard nearest in footrule distance, with all ties of the last."""
        n = len(self.vectors)
        if n <= most:
            return np.arange(n)
        saved = np.zeros(n, np.int32)  # half of what shared pivots save against disjoint orders
        for place, pivot in enumerate(order):
            rows, places = self._files[pivot]
            saved[rows] += self._prefix - np.maximum(places, place)
        bound = np.partition(saved, n - most)[n - most]
        return np.flatnonzero(saved >= bound)

    def search(self, query: np.ndarray, order: np.ndarray, ids: np.ndarray, k: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows by exact inner product, ties to the smaller id."""
        rows = self.candidates(order, most)
        scores = self.vectors[rows] @ query
        best = np.lexsort((ids[rows], -scores))[:k]
        return rows[best], scores[best]


def _valid(table: DataFrame, vector: str) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & whole & F.exists("vector", lambda x: x != 0.0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (lengths[0]["n"] if lengths else 0)).distinct()


def search(
    table: DataFrame,
    query_ids: DataFrame,
    vector: str = "embedding",
    k: int = K,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``table`` for every id in ``query_ids`` (vec_id)."""
    rows = stage(_valid(table, vector), "vectors")
    # equal vectors form a class, named by its smallest id and a hash
    classes = stage(
        rows.groupBy("vector").agg(F.min("vec_id").alias("first")).withColumn(
            "class", F.concat_ws(":", F.col("first").cast("string"), F.hex(F.xxhash64("vector")))
        ),
        "vector_classes",
    )
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    count, longest = classes.agg(F.count("*"), F.coalesce(F.max(length), F.lit(1.0))).first()
    place = F.pmod(F.xxhash64("vector", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    # at most 4 * pivots vectors reach the driver
    drawn = classes.where(place < min(1.0, 2 * pivots / max(count, 1))).select("class", "vector").limit(4 * pivots).collect()
    chosen = [r["vector"] for r in sorted(drawn, key=lambda r: hash_order(r["class"]))[:pivots]]
    landmarks = lifted(np.array(chosen, float), longest) if chosen else np.zeros((1, 1))
    width = min(prefix, len(landmarks))

    named = rows.join(classes.select("vector", "class"), "vector").select("vec_id", "class")
    members = stage(named, "vector_members")
    asked = members.join(query_ids.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")

    shards = -(-max(count, 1) // shard_rows)
    wanted = stage(classes.join(asked.select("class").distinct(), "class", "left_semi"), "query_vectors")
    blocks = -(-max(wanted.count(), 1) // query_rows)
    shard, block = F.pmod(F.xxhash64("class"), F.lit(shards)), F.pmod(F.xxhash64("class", F.lit(5)), F.lit(blocks))
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    left = classes.select("class", "first", "vector", shard.cast("long").alias("shard"), every(blocks, "block"))
    right = wanted.select("class", "vector", every(shards, "shard"), block.cast("long").alias("block"))

    def meet(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(index) and len(queries):
            own = Shard(np.stack(index["vector"].to_numpy()), landmarks, longest, width)
            ids, names = index["first"].to_numpy(), index["class"].to_numpy()
            asked_for = np.stack(queries["vector"].to_numpy())
            unit = asked_for / np.sqrt((asked_for**2).sum(1))[:, None] * longest
            near = orders(np.column_stack([unit, np.zeros(len(unit))]), landmarks, width)
            for name, query, order in zip(queries["class"], asked_for, near, strict=True):
                found, scores = own.search(query, order, ids, k + 1, candidates)
                out += [(name, names[r], ids[r], s) for r, s in zip(found, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_class", "class", "first", "score"])

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInPandas(meet, "query_class string, class string, first long, score double")
    )
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "first")  # (k + 1) rows a shard
    top = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n", "first")
    # the k + 1 smallest ids of a class, first within salts so that a large class is no single task
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS))
    few = members.withColumn("_n", F.row_number().over(Window.partitionBy("class", salt).orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    few = few.withColumn("_n", F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    expanded = top.join(few.select("class", "vec_id"), "class")
    nearest = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")  # (k + 1) squared at most
    expanded = expanded.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= k + 1)
    answers = asked.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query_class")).join(
        expanded.select("query_class", "vec_id", "score"), "query_class"
    )
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def hash_order(name: str) -> tuple[str, str]:
    """An order of classes that does not follow their ids."""
    return name.partition(":")[2], name
