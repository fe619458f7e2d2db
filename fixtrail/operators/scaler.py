"""Standardisation fitted on one part of the rows and applied to all."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_EPS = sys.float_info.epsilon
# updates of a running mean inside a task round like this many merges, as their errors have either sign
_DEPTH_IN_TASK = 64


@dataclass(frozen=True)
class FeatureStats:
    feature: str
    count: int
    mean: float
    std: float
    low: float
    high: float

    @property
    def scale(self) -> float:
        """Population deviation, or 1 when the spread is only rounding noise.

        Moments are running means merged in pairs, in which equal values leave no spread at all, so rounding
        grows with the depth of the merges and not with the number of rows.
        """
        depth = min(self.count, _DEPTH_IN_TASK + max(self.count, 1).bit_length())
        variance = self.std**2
        noise = depth * _EPS * variance + (depth * self.mean * _EPS) ** 2
        return 1.0 if self.low == self.high or variance <= noise else self.std

    def apply(self, value: float) -> float:
        return (value - self.mean) / self.scale


_SCHEMA = "position int, feature string, count long, mean double, std double, scale double, low double, high double"


@dataclass(frozen=True)
class StandardScaler:
    stats: tuple[FeatureStats, ...]

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str]) -> StandardScaler:
        """One aggregate over ``train`` for all features; also keeps each range."""
        features = [f for f in features if f in train.columns]
        if not features:
            raise ValueError("no features to scale; build the features first")
        parts = []
        for i, f in enumerate(features):
            value = F.col(f"`{f}`").cast("double")
            parts += [
                F.count(value).alias(f"n{i}"),
                F.avg(value).alias(f"mean{i}"),
                F.stddev_pop(value).alias(f"std{i}"),
                F.min(value).alias(f"low{i}"),
                F.max(value).alias(f"high{i}"),
            ]
        row = train.agg(*parts).first()
        if any(row[f"n{i}"] == 0 for i in range(len(features))):
            raise ValueError("cannot fit a scaler without training rows")
        return cls(
            tuple(
                FeatureStats(
                    f, row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"low{i}"], row[f"high{i}"]
                )
                for i, f in enumerate(features)
            )
        )

    def rounded(self, digits: int) -> StandardScaler:
        """Means and deviations cut to some decimals, for results that must not hang on the
        last bits of a floating-point sum."""
        return StandardScaler(
            tuple(
                replace(s, mean=round(s.mean, digits), std=round(s.std, digits)) for s in self.stats
            )
        )

    @property
    def features(self) -> list[str]:
        return [s.feature for s in self.stats]

    def column(self, stats: FeatureStats, value: Column | None = None) -> Column:
        value = F.col(f"`{stats.feature}`") if value is None else value
        return (value.cast("double") - F.lit(stats.mean)) / F.lit(stats.scale)

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each fitted feature that ``df`` has; other columns stay as they are."""
        return df.withColumns(
            {s.feature: self.column(s) for s in self.stats if s.feature in df.columns}
        )

    def ranges(self) -> dict[str, tuple[float, float]]:
        """Range of every feature after scaling."""
        return {s.feature: (s.apply(s.low), s.apply(s.high)) for s in self.stats}

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i, s.feature, s.count, s.mean, s.std, s.scale, s.low, s.high)
            for i, s in enumerate(self.stats)
        ]
        return spark.createDataFrame(rows, _SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StandardScaler:
        rows = spark.read.schema(_SCHEMA).parquet(path).orderBy("position").collect()
        return cls(
            tuple(
                FeatureStats(r["feature"], r["count"], r["mean"], r["std"], r["low"], r["high"])
                for r in rows
            )
        )
