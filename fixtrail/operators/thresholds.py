"""Percentile thresholds calibrated on some rows and applied to all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.config import check_percentiles, label_column
from fixtrail.functions.numeric import nan_to_null, round_even
from fixtrail.functions.quantiles import exact_percentiles

DEFAULT_PERCENTILES = (90, 95, 99)


@dataclass(frozen=True)
class Threshold:
    model: str
    percentile: float
    value: float
    calibrated_on: str

    @property
    def label(self) -> str:
        return label_column(self.model, self.percentile)


def calibrate(
    df: DataFrame,
    scores: Mapping[str, str],
    percentiles: Sequence[float] = DEFAULT_PERCENTILES,
    calibration: Mapping[str, Column] | None = None,
) -> list[Threshold]:
    """Thresholds of every model (model -> score column) in shared passes.

    ``calibration`` maps a model to the predicate of its calibration rows; a model without
    one is calibrated on all rows. A model without any calibration score gets none.
    """
    percentiles = check_percentiles(percentiles)
    missing = [c for c in scores.values() if c not in df.columns]
    if missing:
        raise ValueError(f"score columns {missing} do not exist")
    calibration = calibration or {}
    values = {
        model: F.when(calibration[model], F.col(column)) if model in calibration else F.col(column)
        for model, column in scores.items()
    }
    cuts = exact_percentiles(df, values, percentiles)
    return [
        Threshold(model, p, cuts[model][p], "train" if model in calibration else "full")
        for model in scores
        if model in cuts
        for p in percentiles
    ]


def with_labels(
    df: DataFrame, thresholds: Sequence[Threshold], scores: Mapping[str, str]
) -> DataFrame:
    """Label columns ``score >= threshold``; a missing score (NULL or NaN) gives 0."""
    return df.withColumns(
        {
            t.label: F.coalesce(
                nan_to_null(F.col(scores[t.model])) >= F.lit(t.value), F.lit(False)
            ).cast("int")
            for t in thresholds
        }
    )


def threshold_metrics(df: DataFrame, thresholds: Sequence[Threshold]) -> DataFrame:
    """One row per threshold, from a single aggregate over the labelled table."""
    flagged = [F.sum(f"`{t.label}`").alias(f"s{i}") for i, t in enumerate(thresholds)]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *flagged)
    whole = all(float(t.percentile).is_integer() for t in thresholds)
    rows = [
        F.struct(
            F.lit(i).alias("_order"),
            F.lit(t.model).alias("Model"),
            F.lit(t.percentile).cast("int" if whole else "double").alias("Percentile"),
            F.lit(float(np.round(t.value, 6))).alias("Threshold_Value"),
            F.col(f"s{i}").cast("long").alias("Anomalies_Detected"),
            round_even(F.col(f"s{i}") / F.col("total") * 100, 2).alias("Pct_Dataset"),
            F.lit(t.calibrated_on).alias("Calibrated_On"),
        )
        for i, t in enumerate(thresholds)
    ]
    if not rows:
        return df.sparkSession.createDataFrame([], METRICS_SCHEMA)
    return counted.select(F.inline(F.array(*rows))).drop("_order")


METRICS_SCHEMA = (
    "Model string, Percentile int, Threshold_Value double, Anomalies_Detected long, "
    "Pct_Dataset double, Calibrated_On string"
)


def score_ranges(
    df: DataFrame, scores: Mapping[str, str], calibration: Mapping[str, Column] | None = None
) -> DataFrame:
    """Lowest and highest score of each model, on its calibration rows and on all rows."""
    calibration = calibration or {}
    parts, rows = [], []
    for i, (model, column) in enumerate(scores.items()):
        value = nan_to_null(F.col(column))
        inside = F.when(calibration[model], value) if model in calibration else value
        parts += [
            F.min(inside).alias(f"cl{i}"),
            F.max(inside).alias(f"ch{i}"),
            F.min(value).alias(f"al{i}"),
            F.max(value).alias(f"ah{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(model).alias("model"),
                F.col(f"cl{i}").alias("calibration_min"),
                F.col(f"ch{i}").alias("calibration_max"),
                F.col(f"al{i}").alias("application_min"),
                F.col(f"ah{i}").alias("application_max"),
            )
        )
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def score_statistics(df: DataFrame, score: str) -> DataFrame:
    """Mean, median, population deviation, range, p95 and p99 of one score column."""
    value = nan_to_null(F.col(score))
    cuts = exact_percentiles(df, {score: value}, [50, 95, 99]).get(score, {})

    def cut(p: float) -> Column:
        return F.lit(cuts.get(p)).cast("double")

    return df.agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).select(
        "mean", cut(50).alias("median"), "std", "min", "max", cut(95).alias("p95"), cut(99).alias("p99")
    )


def strict_flags(
    df: DataFrame, score: str, percentile: float = 95, output: str = "anomaly"
) -> tuple[DataFrame, float]:
    """Flag scores strictly above their percentile; returns the table and the threshold."""
    (percentile,) = check_percentiles([percentile])
    cuts = exact_percentiles(df, {score: F.col(score)}, [percentile])
    if score not in cuts:
        raise ValueError("no scores to flag; train a model first")
    limit = cuts[score][percentile]
    flag = F.coalesce(nan_to_null(F.col(score)) > F.lit(limit), F.lit(False))
    return df.withColumn(output, flag), limit
