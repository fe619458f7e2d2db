"""Dense global row position and the positional out-of-time split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.config import ENTITY, ROW_ID, TIME
from fixtrail.operators.staging import stage

# monotonically_increasing_id keeps the partition in the upper bits and the position
# inside the partition in the lower 33 (documented Spark layout).
_POSITION_BITS = 33


@dataclass(frozen=True)
class IndexedTable:
    rows: DataFrame
    count: int


def with_row_id(
    df: DataFrame,
    order_by: Sequence[str] = (TIME, ENTITY),
    ties: Sequence[str] | None = None,
    row_id: str = ROW_ID,
) -> IndexedTable:
    """Number all rows 0..n-1 in the order of ``order_by`` and then ``ties``.

    A sampled range exchange spreads the order over many tasks, also when one timestamp or
    entity is hot, because every remaining column (``ties``) and finally a scan position
    take part in the key. Positions inside a range come from the sorted partition and are
    shifted by the row counts of the ranges before it, so no task ever sees all rows.
    ``df`` should be a scan plus narrow steps: the scan position must not change when a
    lost task is run again.
    """
    if ties is None:
        ties = [c for c, t in df.dtypes if c not in order_by and not t.startswith(("map", "struct"))]
    keys = [*order_by, *ties]
    order = [F.col(f"`{k}`") for k in keys] + [F.col("_copy")]
    ranged = (
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .drop("_copy")
    )
    staged = stage(ranged, "row_index")
    part = F.shiftright("_slot", _POSITION_BITS)
    # one row per range partition
    sizes = staged.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    parts, offsets, total = [], [], 0
    for size in sizes:
        parts.append(size["_part"])
        offsets.append(total)
        total += size["count"]
    # an Arrow table goes to the executors as it is; a list of rows would start Python workers there
    starts = df.sparkSession.createDataFrame(pa.table({"_part": pa.array(parts, pa.int64()), "_start": pa.array(offsets, pa.int64())}))
    rows = (
        staged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(row_id, F.col("_start") + F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("_part", "_start", "_slot")
    )
    return IndexedTable(rows, total)


@dataclass(frozen=True)
class TemporalSplit:
    """Rows below ``cutoff`` are training rows, the rest test rows."""

    table: IndexedTable
    cutoff: int
    train_ratio: float

    @property
    def train_size(self) -> int:
        return self.cutoff

    @property
    def test_size(self) -> int:
        return self.table.count - self.cutoff

    def cutoff_time(self, time: str = TIME) -> object:
        """Time of the first test row; rows of the same instant may lie on both sides."""
        return self.table.rows.where(F.col(ROW_ID) == self.cutoff).select(time).first()[0]


def train_size(count: int, ratio: float = 0.7) -> int:
    """Rows before the cut; the product is truncated in double precision."""
    return int(count * ratio)


def temporal_split(table: IndexedTable, ratio: float = 0.7) -> TemporalSplit:
    if table.count == 0:
        raise ValueError("cannot split an empty table")
    return TemporalSplit(table, train_size(table.count, ratio), ratio)


def is_train(cutoff: int, row_id: str = ROW_ID):
    return F.col(row_id) < F.lit(cutoff)
