"""Sliding windows of consecutive fixes that are not broken by a time gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixtrail.config import ENTITY, TIME
from fixtrail.functions.calendar import seconds_between
from fixtrail.operators.kinematics import elapsed_seconds
from fixtrail.operators.lookback import EntityFrames

GAP = "gap"  # every consecutive gap within the limit
SPAN = "span"  # the whole window within the limit as well, and more rows than one window


def window_lookback(size: int) -> int:
    return max(size - 1, 0)


def with_window_flags(
    df: DataFrame,
    frames: EntityFrames,
    size: int,
    max_gap_seconds: float,
    rule: str = GAP,
    time: str = TIME,
    entity: str = ENTITY,
) -> DataFrame:
    """Add ``window_full`` and ``window_valid`` for the window that ends on each row.

    A window is full when ``size`` rows of the entity end here. It is valid when none of the
    gaps inside exceeds the limit; a gap equal to the limit passes.
    """
    if size < 1:
        raise ValueError("a window needs at least one row")
    w = frames.window
    full = F.row_number().over(w) >= size
    valid = full
    limit = F.lit(float(max_gap_seconds))
    if size > 1:
        df = df.withColumn("_gap", elapsed_seconds(w, time))
        widest = F.max("_gap").over(w.rowsBetween(2 - size, Window.currentRow))
        valid = valid & (widest <= limit)
    if rule == SPAN:
        valid = valid & (frames.fixes() > size)
        span = seconds_between(F.lag(time, size - 1).over(w), F.col(time))
        valid = valid & (span <= limit)
    elif rule != GAP:
        raise ValueError(f"unknown window rule {rule!r}")
    return df.withColumns(
        {"window_full": full, "window_valid": F.coalesce(valid, F.lit(False))}
    ).drop("_gap")


def window_values(
    frames: EntityFrames, size: int, features: Sequence[str], when: Column | None = None
) -> Column:
    """Array of ``size`` rows (oldest first), each an array of feature values.

    Offsets into the ordered partition instead of a sliding collect: nothing is gathered.
    """
    now = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    steps = [F.lag(now, back).over(frames.window) for back in range(size - 1, 0, -1)]
    payload = F.array(*steps, now)
    return payload if when is None else F.when(when, payload)


def window_counters(flagged: DataFrame, size: int, entity: str = ENTITY) -> DataFrame:
    """Windows kept, windows dropped for a gap, and entities too short for any window.

    The counts per entity are combined map-side before the small final aggregate.
    """
    per_entity = flagged.groupBy(entity).agg(
        F.count(F.lit(1)).alias("fixes"),
        F.count_if("window_valid").alias("kept"),
        F.count_if(F.col("window_full") & ~F.col("window_valid")).alias("dropped"),
    )
    return per_entity.agg(
        F.coalesce(F.sum("kept"), F.lit(0)).alias("sequences_generated"),
        F.coalesce(F.sum("dropped"), F.lit(0)).alias("sequences_rejected_gap"),
        F.count_if(F.col("fixes") < size).alias("vehicles_rejected_short"),
    )
