"""Exact interpolated percentiles without gathering the values in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here values are put into buckets
that follow their order, buckets are counted map-side for all columns in one pass, and only the
buckets that hold a wanted rank are cut again. The first pass cuts by sign and magnitude, later ones
cut the range of a bucket into equal steps, so a double is settled after four or five passes, whatever
the distribution and however many rows. Few values left in a bucket are selected directly.

Buckets stay a table: running sums of their counts, taken inside groups of buckets and over the groups, say
which ranks a bucket holds, and only the buckets with a wanted rank come to the driver, at most
two for each percentile and column.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fixtrail.functions.numeric import nan_to_null

# values that may meet in one aggregation buffer
DIRECT_LIMIT = 100_000
# accuracy at which the sketch keeps every value and so selects ranks exactly
_EXACT_ACCURACY = 2_147_483_647
# buckets per power of two, and what makes the number of the smallest double's bucket positive
_PER_OCTAVE, _OFFSET = 16, 1076 * 16
_BEYOND = 1_000_000
# steps of a bucket that is cut again; one more takes the largest value
_STEPS = 1 << 16
# buckets whose counts are summed up in one task
_TOGETHER = 1 << 10


@dataclass(frozen=True)
class _Interval:
    """Candidates of one column, from ``low`` to ``high``, both of them values of the column."""

    column: str
    size: int  # candidates
    below: int  # values less than ``low``
    low: float
    high: float

    def holds(self) -> Column:
        value = F.col(self.column)
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))

    def step(self) -> Column:
        share = (F.col(self.column) - F.lit(self.low)) / F.lit(self.high - self.low)
        return F.floor(share * _STEPS)


_Work = dict[_Interval, list[int]]  # interval -> ranks still wanted


def _magnitude(value: Column) -> Column:
    """A number of bounded range that never falls where the value rises."""
    octave = lambda x: F.floor(F.log2(x) * _PER_OCTAVE) + _OFFSET
    endless = F.lit(math.inf)
    return (
        F.when(value == 0, F.lit(0).cast("long"))
        .when(value == endless, F.lit(_BEYOND))
        .when(value == -endless, F.lit(-_BEYOND))
        .when(value > 0, octave(value))
        .otherwise(-octave(-value))
    )


def _positions(count: Column, percentiles: Sequence[float]) -> Column:
    """Ranks (from 0) of the two neighbours of each percentile among ``count`` values."""
    last = count - 1
    first = [F.floor(last * F.lit(p / 100)) for p in percentiles]
    return F.array(*first, *[F.least(r + 1, last) for r in first])


def _with_ranks_below(buckets: DataFrame) -> DataFrame:
    """Add ``below`` and ``total``: values of the group in earlier buckets, and in all of them.

    Sums run over at most ``_TOGETHER`` buckets of one group at a time.
    """
    group = F.floor(F.col("b") / _TOGETHER)
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before.partitionBy("i", "k", "_group")), F.lit(0))
    groups = buckets.groupBy("i", "k", group.alias("_group")).agg(F.sum("n").alias("_n"))
    earlier = Window.partitionBy("i", "k").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sums = groups.select(
        "i",
        "k",
        "_group",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_above"),
        F.sum("_n").over(Window.partitionBy("i", "k")).alias("total"),
    )
    placed = buckets.withColumn("_group", group).withColumn("_inside", inside)
    return placed.join(sums, ["i", "k", "_group"]).withColumn("below", F.col("_above") + F.col("_inside"))


def _holding(df: DataFrame, buckets: Mapping[str, tuple[Column, Column]], wanted: Column) -> list:
    """Rows (i, k, n, low, high, below, total) of the buckets that hold a wanted rank.

    ``buckets`` gives for each column the number of the interval that is cut and of the bucket in it; a null
    bucket leaves the value out. ``wanted`` is an array of ranks, and may depend on i, k and total.
    """
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("i"), k.alias("k"), b.cast("long").alias("b"), F.col(c).alias("v"))
            for i, (c, (k, b)) in enumerate(buckets.items())
        ]
    )
    counted = (
        df.select(F.inline(entries))
        .where("b IS NOT NULL AND v IS NOT NULL")
        .groupBy("i", "k", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    inside = F.exists(wanted, lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))
    rows = _with_ranks_below(counted).where(inside).select("i", "k", "n", "low", "high", "below", "total")
    return rows.collect()  # at most two for each percentile and column


def _settle(column: str, rows: Iterable, below: int, ranks: Iterable[int]) -> tuple[dict[tuple[str, int], float], _Work]:
    """Ranks whose bucket has one value only, and the buckets of the others; ``below``: values before all buckets."""
    found: dict[tuple[str, int], float] = {}
    rest: _Work = {}
    for row in rows:
        first = below + row["below"]
        inside = sorted(r for r in ranks if first <= r < first + row["n"])
        if inside and row["low"] == row["high"]:
            found.update({(column, r): row["low"] for r in inside})
        elif inside:
            rest[_Interval(column, row["n"], first, row["low"], row["high"])] = inside
    return found, rest


def _select_directly(df: DataFrame, work: _Work) -> dict[tuple[str, int], float]:
    parts = []
    for k, (interval, ranks) in enumerate(work.items()):
        at = F.array(*[F.lit((r - interval.below + 0.5) / interval.size) for r in ranks])
        values = F.when(interval.holds(), F.col(interval.column))
        parts.append(F.percentile_approx(values, at, F.lit(_EXACT_ACCURACY)).alias(f"a{k}"))
    found = {}
    for (interval, ranks), values in zip(work.items(), df.agg(*parts).first(), strict=True):
        found.update({(interval.column, r): v for r, v in zip(ranks, values, strict=True)})
    return found


def _cut(df: DataFrame, work: _Work) -> tuple[dict[tuple[str, int], float], _Work]:
    """One more pass over the intervals of all columns."""
    own: dict[str, list[_Interval]] = {}
    for interval in work:
        own.setdefault(interval.column, []).append(interval)
    cuts = {}
    for column, intervals in own.items():
        number, bucket = F.lit(None).cast("int"), F.lit(None).cast("long")
        for k, interval in enumerate(intervals):  # no value lies in two
            number = F.when(interval.holds(), F.lit(k)).otherwise(number)
            bucket = F.when(interval.holds(), interval.step()).otherwise(bucket)
        cuts[column] = (number, bucket)
    ranks = F.create_map(
        *[
            part
            for i, intervals in enumerate(own.values())
            for k, x in enumerate(intervals)
            for part in (F.lit(f"{i}:{k}"), F.array(*[F.lit(r - x.below).cast("long") for r in work[x]]))
        ]
    )
    rows = _holding(df, cuts, F.element_at(ranks, F.concat_ws(":", "i", "k")))
    found: dict[tuple[str, int], float] = {}
    rest: _Work = {}
    for i, (column, intervals) in enumerate(own.items()):
        for k, interval in enumerate(intervals):
            mine = [r for r in rows if (r["i"], r["k"]) == (i, k)]
            settled, more = _settle(column, mine, interval.below, work[interval])
            found |= settled
            rest |= more
    return found, rest


def interpolate(low: float, high: float, weight: float) -> float:
    """Linear interpolation between neighbours, anchored at the nearer one."""
    if weight >= 0.5:
        return high - (high - low) * (1 - weight)
    return low + (high - low) * weight


def exact_percentiles(
    df: DataFrame,
    values: Mapping[str, Column],
    percentiles: Sequence[float],
    direct_limit: int = DIRECT_LIMIT,
) -> dict[str, dict[float, float]]:
    """Percentiles (0..100) of each expression; NULL and NaN are left out.

    An expression without any value is absent from the result.
    """
    narrow = df.select(
        *[nan_to_null(v.cast("double")).alias(f"v{i}") for i, v in enumerate(values.values())]
    )

    def position(n: int, p: float) -> tuple[int, int, float]:
        at = (n - 1) * (p / 100)
        first = math.floor(at)
        return first, min(first + 1, n - 1), at - first

    sizes: dict[str, int] = {}
    found: dict[tuple[str, int], float] = {}
    work: _Work = {}
    first = {c: (F.lit(0), _magnitude(F.col(c))) for c in narrow.columns}
    rows = _holding(narrow, first, _positions(F.col("total"), percentiles)) if percentiles else []
    for i, column in enumerate(narrow.columns):
        mine = [r for r in rows if r["i"] == i]
        if mine:
            n = sizes[column] = mine[0]["total"]
            settled, more = _settle(column, mine, 0, {r for p in percentiles for r in position(n, p)[:2]})
            found |= settled
            work |= more
    while work:
        small = {i: r for i, r in work.items() if i.size <= direct_limit}
        large = {i: r for i, r in work.items() if i.size > direct_limit}
        if small:
            found |= _select_directly(narrow, small)
        work = {}
        if large:
            settled, work = _cut(narrow, large)
            found |= settled

    out: dict[str, dict[float, float]] = {}
    for column, name in zip(narrow.columns, values, strict=True):
        if column in sizes:
            out[name] = {}
            for p in percentiles:
                first, second, weight = position(sizes[column], p)
                out[name][p] = interpolate(found[column, first], found[column, second], weight)
    return out
