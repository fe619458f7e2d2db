"""Isolation forest: small trees grown in parallel, kept as a table of nodes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.config import ROW_ID
from fixtrail.functions.numeric import nan_to_null
from fixtrail.operators.hbos import contamination_labels

# Fixed values of the published algorithm.
SAMPLE_SIZE = 256
_SAME = 1e-7  # a feature whose spread is not above this is constant

_NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, path double, size int"
)


def average_path(size: int) -> float:
    """Expected path length of an unsuccessful search among ``size`` points."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1.0) + np.euler_gamma) - 2.0 * (size - 1.0) / size


def _grow(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, path, size); a leaf points at itself."""
    nodes: list[list] = [[0, 0.0, 0, 0, 0.0, len(points)]]
    pending = [(0, np.arange(len(points)), 0)]
    while pending:
        node, members, depth = pending.pop()
        block = points[members]
        low, high = block.min(axis=0), block.max(axis=0)
        usable = np.flatnonzero(high - low > _SAME)
        if depth >= max_depth or len(members) < 2 or usable.size == 0:
            nodes[node] = [0, math.inf, node, node, depth + average_path(len(members)), len(members)]
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        if cut >= high[feature]:
            cut = float(low[feature])
        goes_left = block[:, feature] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes[node] = [feature, cut, left, right, 0.0, len(members)]
        nodes += [[], []]
        pending.append((left, members[goes_left], depth + 1))
        pending.append((right, members[~goes_left], depth + 1))
    return [tuple(n) for n in nodes]


@dataclass(frozen=True)
class IsolationForest:
    features: tuple[str, ...]
    sample_size: int
    trees: int
    nodes: pd.DataFrame

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        train_rows: int,
        features: Sequence[str],
        trees: int = 100,
        seed: int = 42,
        row_id: str = ROW_ID,
    ) -> IsolationForest:
        """Grow ``trees`` trees over rows whose ``row_id`` runs 0..train_rows-1.

        The driver draws row positions only (trees x 256, whatever the data size); the rows
        reach the trees through a broadcast join, and each tree grows in its own group of at
        most 256 rows. A tree depends on the seed and its number, not on partitioning, and
        the first trees of a larger forest equal those of a smaller one.
        """
        if not features:
            raise ValueError("no features to grow trees from")
        if train_rows < 1:
            raise ValueError("cannot grow trees without training rows")
        size = min(SAMPLE_SIZE, train_rows)
        max_depth = math.ceil(math.log2(max(size, 2)))
        drawn = np.concatenate(
            [
                np.random.default_rng([seed, t]).choice(train_rows, size, replace=False, shuffle=False)
                for t in range(trees)
            ]
        )
        spark = train.sparkSession
        sample = spark.createDataFrame(
            pd.DataFrame({"tree": np.repeat(np.arange(trees, dtype=np.int32), size), row_id: drawn})
        )
        values = F.array(*[F.col(f"`{f}`").cast("float") for f in features]).alias("x")
        picked = train.join(F.broadcast(sample), row_id).select("tree", row_id, values)

        def grow(group: pd.DataFrame) -> pd.DataFrame:
            tree = int(group["tree"].iloc[0])
            points = np.stack(group.sort_values(row_id)["x"].to_numpy()).astype(np.float32)
            grown = _grow(points, np.random.default_rng([seed, tree, 1]), max_depth)
            out = pd.DataFrame(grown, columns=["feature", "threshold", "left", "right", "path", "size"])
            out.insert(0, "node", np.arange(len(out), dtype=np.int32))
            out.insert(0, "tree", tree)
            return out

        # a fixed partition number: the trees stay spread out although their rows are few
        spread = picked.repartition(min(trees, spark.sparkContext.defaultParallelism), "tree")
        # at most 2 x 256 nodes per tree
        nodes = spread.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        return cls(tuple(features), size, trees, nodes)

    @property
    def depth(self) -> int:
        return math.ceil(math.log2(max(self.sample_size, 2)))

    def _levels(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features and thresholds by level, and path lengths at the last level.

        Trees are spread to full depth (a leaf repeats itself), so that children follow
        from the position: node i of a level leads to nodes 2i and 2i + 1 of the next. A
        threshold is rounded down to single precision, which leaves the comparison with a
        single-precision value unchanged.
        """
        tree = self.nodes["tree"].to_numpy()
        starts = np.searchsorted(tree, np.arange(self.trees))
        links = self.nodes[["left", "right"]].to_numpy(np.intp) + starts[tree][:, None]
        feature = self.nodes["feature"].to_numpy(np.intp)
        exact = self.nodes["threshold"].to_numpy(np.float64)
        threshold = exact.astype(np.float32)
        too_high = threshold > exact
        threshold[too_high] = np.nextafter(threshold[too_high], np.float32(-np.inf))
        at = starts[:, None]
        features, thresholds = [], []
        for _ in range(self.depth):
            features.append(feature[at])
            thresholds.append(threshold[at])
            at = links[at].reshape(self.trees, -1)
        return np.hstack(features), np.hstack(thresholds), self.nodes["path"].to_numpy()[at]

    def score(self, prefixes: Sequence[int] | None = None):
        """Struct column with one score per forest size in ``prefixes``.

        Higher is more anomalous. Several sizes share one walk because a smaller forest is a
        prefix of a larger one. The nodes (a few MB at most) travel with the function.
        """
        sizes = sorted(prefixes or [self.trees])
        if sizes[-1] > self.trees or sizes[0] < 1:
            raise ValueError(f"forest has {self.trees} trees, asked for {sizes}")
        feature, threshold, path = self._levels()
        depth = self.depth
        expected = average_path(self.sample_size) or 1.0
        schema = ", ".join(f"n{s} double" for s in sizes)

        @F.pandas_udf(schema)
        def walk(*columns: pd.Series) -> pd.DataFrame:
            x = np.stack([c.to_numpy(np.float32) for c in columns])
            missing = np.isnan(x).any(axis=0)
            flat, count = x.ravel(), x.shape[1]
            row, column = np.arange(count), feature * count
            total = np.zeros(count)
            out = {}
            for tree in range(sizes[-1]):
                at = np.zeros(count, np.intp)
                for level in range(depth):
                    nodes = slice((1 << level) - 1, (2 << level) - 1)
                    place = column[tree, nodes].take(at)
                    place += row
                    goes_right = flat.take(place) > threshold[tree, nodes].take(at)
                    at *= 2
                    at += goes_right
                total += path[tree].take(at)
                if tree + 1 in sizes:
                    score = np.exp2(-total / ((tree + 1) * expected))
                    out[f"n{tree + 1}"] = np.where(missing, np.nan, score)
            return pd.DataFrame(out)

        return walk(*[F.col(f"`{f}`").cast("float") for f in self.features])

    def with_scores(self, df: DataFrame, outputs: dict[int, str]) -> DataFrame:
        """Add one score column per forest size; NULL where a feature is missing."""
        scored = df.withColumn("_iso", self.score(list(outputs)))
        return scored.withColumns(
            {name: nan_to_null(F.col(f"_iso.n{size}")) for size, name in outputs.items()}
        ).drop("_iso")

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, _NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = [(list(self.features), self.sample_size, self.trees)]
        spark.createDataFrame(facts, "features array<string>, sample_size int, trees int").write.mode(
            "overwrite"
        ).parquet(f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        facts = spark.read.parquet(f"{path}/forest").first()
        nodes = spark.read.schema(_NODE_SCHEMA).parquet(f"{path}/nodes").orderBy("tree", "node")
        return cls(
            tuple(facts["features"]), facts["sample_size"], facts["trees"], nodes.toPandas()
        )


def walk_forest(
    df: DataFrame,
    nodes: DataFrame,
    features: Sequence[str],
    sample_size: int = SAMPLE_SIZE,
    path: str = "path",
    score: str = "score",
) -> DataFrame:
    """Add the summed path lengths and the score of every row, from a table of nodes and inside the JVM.

    ``nodes`` has the columns of a saved forest (tree, node, feature, threshold, left, right, path; the root is node 0 and a leaf
    points at itself). It enters the plan as one packed value of bounded size. A row goes left where its value in single
    precision is at most the threshold. Both columns are NULL where a feature is missing.
    """
    node = F.struct("node", "feature", "threshold", "left", "right", "path")
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    packed = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))
    values = [nan_to_null(F.col(f"`{f}`").cast("float").cast("double")) for f in features]
    walking = df.withColumn("_forest", packed.scalar()).withColumn("_x", F.array(*values))
    levels = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(max(sample_size, 2))))))

    def length(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(tree["nodes"], at)
            return F.when(F.get(F.col("_x"), here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])

        return F.get(tree["nodes"], F.aggregate(levels, F.lit(0), step))["path"]

    total = F.aggregate(F.transform("_forest", length), F.lit(0.0), lambda a, b: a + b)
    whole = F.forall("_x", lambda v: v.isNotNull())
    scale = F.size("_forest") * F.lit(average_path(sample_size) or 1.0)
    return (
        walking.withColumn(path, F.when(whole, total))
        .withColumn(score, F.pow(F.lit(2.0), -F.col(f"`{path}`") / scale))
        .drop("_forest", "_x")
    )


def isolation_labels(
    df: DataFrame,
    score: str,
    contamination: float | str = "auto",
    train: DataFrame | None = None,
    output: str = "label",
) -> DataFrame:
    """1 for outliers: score above 0.5, or above the contamination percentile of ``train``."""
    if contamination != "auto":
        return contamination_labels(df, score, contamination, train, output)
    flag = F.coalesce(nan_to_null(F.col(score)) > F.lit(0.5), F.lit(False))
    return df.withColumn(output, flag.cast("int"))
