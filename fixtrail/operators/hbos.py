"""Histogram-based outlier scores with equal-width bins."""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.functions.numeric import nan_to_null
from fixtrail.functions.quantiles import exact_percentiles

# Smoothing added to a density, and how far (in bin widths) a value may lie
# outside the fitted range and still count as being in the outermost bin.
SMOOTHING = 0.1
EDGE_TOLERANCE = 0.5

_SCHEMA = (
    "bins int, position int, feature string, bin int, low double, high double, "
    "edge_low double, edge_high double, count long, density double, bin_score double"
)


def contamination_labels(
    df: DataFrame,
    score: str,
    contamination: float = 0.1,
    train: DataFrame | None = None,
    output: str = "label",
) -> DataFrame:
    """1 where the score is strictly above the contamination percentile of ``train``.

    Without ``train`` the scores of ``df`` itself set the percentile.
    """
    base = df if train is None else train
    cut = exact_percentiles(base, {score: F.col(score)}, [100 * (1 - contamination)])
    if score not in cut:
        raise ValueError("no scores to calibrate the labels on")
    (limit,) = cut[score].values()
    flag = F.coalesce(nan_to_null(F.col(score)) > F.lit(limit), F.lit(False))
    return df.withColumn(output, flag.cast("int"))


def value_ranges(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    parts = []
    for i, f in enumerate(features):
        value = F.col(f"`{f}`").cast("double")
        parts += [F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    row = df.agg(*parts).first()
    return {f: (row[f"low{i}"], row[f"high{i}"]) for i, f in enumerate(features)}


@dataclass(frozen=True)
class Histogram:
    """Equal-width bins of one feature; ``low``/``high`` are the fitted range."""

    feature: str
    bins: int
    low: float
    high: float
    counts: tuple[int, ...] = ()

    @property
    def first(self) -> float:
        return self.low - 0.5 if self.low == self.high else self.low

    @property
    def last(self) -> float:
        return self.high + 0.5 if self.low == self.high else self.high

    @property
    def step(self) -> float:
        return (self.last - self.first) / self.bins

    def edge(self, i: int) -> float:
        return self.last if i == self.bins else i * self.step + self.first

    @property
    def edges(self) -> list[float]:
        return [self.edge(i) for i in range(self.bins + 1)]

    @property
    def fit_splits(self) -> list[float]:
        """Bucket borders for counting: closed on the left, the last bin on both sides."""
        inner = self.edges[1:-1] or [math.nextafter(self.last, math.inf)]
        return [-math.inf, *inner, math.inf]

    @property
    def lookup_splits(self) -> list[float]:
        """Bucket borders of the negated value, which turns bins to closed on the right.

        The buckets run from far above the range over the bins in reverse to far below it.
        """
        edges = self.edges
        first_reach = (edges[1] - edges[0]) * EDGE_TOLERANCE
        last_reach = (edges[-1] - edges[-2]) * EDGE_TOLERANCE
        lowest = _outermost(edges[0], -first_reach, lambda x: edges[0] - x <= first_reach)
        highest = _outermost(edges[-1], last_reach, lambda x: x - edges[-1] <= last_reach)
        inner = [-e for e in reversed(edges)]
        return [-math.inf, -highest, *inner, math.nextafter(-lowest, math.inf), math.inf]

    @property
    def lookup_scores(self) -> list[float]:
        """Scores in the order of ``lookup_splits``; just outside, the outermost bin counts."""
        scores = self.bin_scores
        worst = min(scores)
        return [worst, scores[-1], *reversed(scores), scores[0], worst]

    @property
    def densities(self) -> list[float]:
        total = sum(self.counts)
        return [c / (self.edge(i + 1) - self.edge(i)) / total for i, c in enumerate(self.counts)]

    @property
    def bin_scores(self) -> list[float]:
        return [math.log2(d + SMOOTHING) for d in self.densities]


@dataclass(frozen=True)
class HbosModel:
    bins: int
    histograms: tuple[Histogram, ...]

    def rows(self) -> list[tuple]:
        return [
            (self.bins, p, h.feature, i, h.low, h.high, h.edge(i), h.edge(i + 1), c, d, s)
            for p, h in enumerate(self.histograms)
            for i, (c, d, s) in enumerate(zip(h.counts, h.densities, h.bin_scores, strict=True))
        ]


def _key(x: float) -> int:
    """Doubles in order as integers."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _double(key: int) -> float:
    x = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return x if key >= 0 else -x


def _outermost(edge: float, reach: float, near: Callable[[float], bool]) -> float:
    """The double furthest from ``edge``, in the direction of ``reach``, that is still ``near``.

    Bisection over the doubles in between: 64 steps at most, however dense they lie.
    """
    far = edge + 2 * reach
    while near(far):
        reach = 2 * reach or math.copysign(abs(edge) * 2**-52 + 5e-324, reach)
        far = edge + 2 * reach
    inside, outside = _key(edge), _key(far)
    while abs(outside - inside) > 1:
        middle = (inside + outside) // 2
        inside, outside = (middle, outside) if near(_double(middle)) else (inside, middle)
    return _double(inside)


def _with_buckets(
    df: DataFrame, histograms: Sequence[Histogram], splits: Sequence[list[float]], sign: int
) -> DataFrame:
    """Add the bucket number ``_b<i>`` of the (negated) feature of every histogram.

    A binary search per value inside the JVM. Chains of comparisons for a dozen histograms
    would exceed the method size the JVM compiles and cost ten times as much per row.
    """
    # adding 0.0 removes negative zeros, which the search would tell apart
    values = {
        f"_x{i}": F.col(f"`{h.feature}`").cast("double") * sign + F.lit(0.0)
        for i, h in enumerate(histograms)
    }
    bucketizer = Bucketizer(
        splitsArray=[[s + 0.0 for s in borders] for borders in splits],
        inputCols=list(values),
        outputCols=[f"_b{i}" for i in range(len(histograms))],
        handleInvalid="keep",
    )
    return bucketizer.transform(df.withColumns(values)).drop(*values)


def with_hbos_scores(
    df: DataFrame, models: Mapping[int, HbosModel], outputs: Mapping[int, str]
) -> DataFrame:
    """Add one score column per bin count: minus the summed log densities of a row.

    NULL where a feature is missing.
    """
    histograms = [h for b in outputs for h in models[b].histograms]
    placed = _with_buckets(df, histograms, [h.lookup_splits for h in histograms], -1)
    scores, at = {}, 0
    for b, name in outputs.items():
        total = None
        for h in models[b].histograms:
            # a NaN falls into one more bucket, which has no score
            table = F.array(*[F.lit(v) for v in h.lookup_scores], F.lit(None).cast("double"))
            part = F.get(table, F.col(f"_b{at}").cast("int"))
            total = part if total is None else total + part
            at += 1
        scores[name] = -total
    return placed.withColumns(scores).drop(*[f"_b{i}" for i in range(len(histograms))])


def fit_hbos(
    train: DataFrame,
    features: Sequence[str],
    bins: Sequence[int] = (10,),
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> dict[int, HbosModel]:
    """Fit one model per bin count in a single counting pass over ``train``.

    Each row turns into (histogram, bin) pairs that are counted map-side, so the shuffle
    carries at most one record per bin and task. ``ranges`` (for example from the scaler)
    saves the pass for minimum and maximum.
    """
    if not features:
        raise ValueError("no features to build histograms from")
    missing = [f for f in features if ranges is None or f not in ranges]
    known = dict(ranges or {}) | (value_ranges(train, missing) if missing else {})
    if any(known[f][0] is None for f in features):
        raise ValueError("cannot fit histograms without training rows")
    plain = [Histogram(f, b, *known[f]) for b in bins for f in features]
    binned = _with_buckets(train, plain, [h.fit_splits for h in plain], 1)
    places = F.array(*[F.col(f"_b{i}").cast("int") for i in range(len(plain))])
    counted = (
        binned.select(F.posexplode(places).alias("h", "bin"))
        .groupBy("h", "bin")
        .count()
        .collect()  # at most features x bins rows
    )
    counts = {(r["h"], r["bin"]): r["count"] for r in counted}
    fitted = [
        Histogram(
            h.feature, h.bins, h.low, h.high, tuple(counts.get((i, b), 0) for b in range(h.bins))
        )
        for i, h in enumerate(plain)
    ]
    return {b: HbosModel(b, tuple(h for h in fitted if h.bins == b)) for b in bins}


def models_to_df(spark: SparkSession, models: Mapping[int, HbosModel]) -> DataFrame:
    return spark.createDataFrame([r for m in models.values() for r in m.rows()], _SCHEMA)


def save_models(spark: SparkSession, models: Mapping[int, HbosModel], path: str) -> None:
    models_to_df(spark, models).write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> dict[int, HbosModel]:
    stored = spark.read.schema(_SCHEMA).parquet(path).orderBy("bins", "position", "bin").collect()
    grouped: dict[int, dict[str, list]] = {}
    for r in stored:
        grouped.setdefault(r["bins"], {}).setdefault(r["feature"], []).append(r)
    return {
        bins: HbosModel(
            bins,
            tuple(
                Histogram(f, bins, rs[0]["low"], rs[0]["high"], tuple(r["count"] for r in rs))
                for f, rs in features.items()
            ),
        )
        for bins, features in grouped.items()
    }
