"""Agreement of label columns with a reference label."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.functions.numeric import ratio, round_even


def label_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.endswith("_label")]


def reference_label(labels: Sequence[str]) -> str | None:
    """Lexically last isolation label at the 95th percentile, if there is one."""
    return max((c for c in labels if c.startswith("ISO") and "p95" in c), default=None)


def _metric_columns(hits: Column, predicted: Column, actual: Column, total: Column) -> dict:
    correct = total - predicted - actual + hits * 2
    return {
        "Precision": round_even(ratio(hits, predicted), 4),
        "Recall": round_even(ratio(hits, actual), 4),
        "F1_Score": round_even(ratio(hits * 2, predicted + actual), 4),
        "Accuracy": round_even(ratio(correct, total), 4),
    }


def confusion_counts(df: DataFrame, truth: str, labels: Sequence[str]) -> DataFrame:
    """True/false positives and negatives of every label: one aggregate, one row per label.

    Three sums per label over the wide table; rows are never multiplied by the labels.
    """
    parts = [F.count(F.lit(1)).alias("total"), F.sum(f"`{truth}`").alias("actual")]
    for i, c in enumerate(labels):
        parts.append(F.sum(f"`{c}`").alias(f"p{i}"))
        parts.append(F.sum(F.col(f"`{c}`") * F.col(f"`{truth}`")).alias(f"h{i}"))
    rows = [
        F.struct(
            F.lit(c).alias("model"),
            F.col(f"h{i}").alias("tp"),
            (F.col(f"p{i}") - F.col(f"h{i}")).alias("fp"),
            (F.col("actual") - F.col(f"h{i}")).alias("fn"),
            (F.col("total") - F.col(f"p{i}") - F.col("actual") + F.col(f"h{i}")).alias("tn"),
        )
        for i, c in enumerate(labels)
    ]
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def compare_labels(df: DataFrame, truth: str, labels: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and accuracy per label, in input order; missing ones skipped."""
    present = [c for c in labels if c in df.columns]
    for c in labels:
        if c not in df.columns:
            warnings.warn(f"label column {c} does not exist and is skipped", stacklevel=2)
    if not present:
        return df.sparkSession.createDataFrame([], COMPARISON_SCHEMA)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    metrics = _metric_columns(tp, tp + fp, tp + fn, tp + fp + fn + tn)
    return confusion_counts(df, truth, present).select(
        F.col("model").alias("Model"), *[m.alias(n) for n, m in metrics.items()]
    )


COMPARISON_SCHEMA = (
    "Model string, Precision double, Recall double, F1_Score double, Accuracy double"
)


def compare_with_reference(df: DataFrame) -> DataFrame | None:
    """Every label against the reference label; None without a reference label."""
    labels = label_columns(df.columns)
    truth = reference_label(labels)
    if truth is None:
        return None
    return compare_labels(df, truth, [c for c in labels if c != truth])
