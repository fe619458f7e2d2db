"""Per-entity windows that stay parallel when one entity owns much of the data.

A window partitioned by entity puts the whole entity into one task. Entities above a size limit are
cut into blocks of ``max_rows`` (at least ``lookback``) of their own consecutive rows, and the last
rows of a block are copied to the next one, so any window function that looks back at most
``lookback`` rows gives the same value as over the uncut entity. A row is copied at most once. The
copies are dropped afterwards.

A row's number within its hot entity needs no window over the entity: rows are put into cells of the
global row position, counted per entity and cell, and numbered inside their cell. A cell holds
at most ``max_rows`` rows of an entity. The counts, a few numbers per cell, are summed up over cells
of cells, so a sum over an entity never meets more than a fixed number of rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fixtrail.config import ENTITY, ROW_ID, TIME
from fixtrail.operators.rowindex import with_row_id
from fixtrail.operators.staging import stage

BLOCK = "_block"
_CORE = "_core"
_FIXES = "_fixes"

# up to this many hot entities are broadcast; beyond it the join shuffles
_BROADCAST_ENTITIES = 100_000
# counts of one entity that are summed up in one task
_COUNTS_TOGETHER = 10_000


@dataclass(frozen=True)
class EntityFrames:
    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def fixes(self) -> Column:
        """Rows of the whole entity."""
        seen = F.count(F.lit(1)).over(Window.partitionBy(*self.keys))
        return F.coalesce(F.col(_FIXES), seen) if self.split else seen

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop the copied rows and helper columns after the windows were applied."""
        return df.where(_CORE).drop(_CORE, BLOCK, _FIXES) if self.split else df


def _starts(counts: DataFrame, entity: str, cells: int) -> DataFrame:
    """entity, _cell, _start: how many rows the entity has in earlier cells."""
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda *keys: F.coalesce(F.sum("_n").over(before.partitionBy(*keys)), F.lit(0))
    if cells <= _COUNTS_TOGETHER:
        return counts.select(entity, "_cell", earlier(entity).alias("_start"))
    upper = F.floor(F.col("_cell") / _COUNTS_TOGETHER)
    inside = counts.withColumn("_upper", upper).select(entity, "_cell", "_upper", earlier(entity, "_upper").alias("_inside"))
    sums = counts.groupBy(entity, upper.alias("_cell")).agg(F.sum("_n").alias("_n"))
    above = _starts(sums, entity, cells // _COUNTS_TOGETHER + 1).select(entity, F.col("_cell").alias("_upper"), F.col("_start").alias("_above"))
    return inside.join(above, [entity, "_upper"]).select(entity, "_cell", (F.col("_above") + F.col("_inside")).alias("_start"))


def entity_frames(
    df: DataFrame,
    lookback: int,
    max_rows: int,
    entity: str = ENTITY,
    order: Sequence[str] = (ROW_ID,),
    total_rows: int | None = None,
) -> EntityFrames:
    """Prepare ``df`` for look-back windows; cut entities larger than ``max_rows``.

    ``total_rows``, when known and small enough, saves counting the entities. ``order`` has to be
    total within an entity, or rows that tie may stand in another order in a cut entity.
    """
    if total_rows is not None and total_rows <= max_rows:
        return EntityFrames(df, (entity,), tuple(order), split=False)
    hot = df.groupBy(entity).agg(F.count(F.lit(1)).alias(_FIXES)).where(F.col(_FIXES) > max_rows)
    if hot.isEmpty():
        return EntityFrames(df, (entity,), tuple(order), split=False)
    hot = stage(hot, "hot_entities")
    hot_count = hot.count()  # at most rows / max_rows entities

    if ROW_ID not in df.columns:
        df = with_row_id(df, order_by=(TIME, entity), ties=[c for c in order if c != TIME]).rows
    if hot_count <= _BROADCAST_ENTITIES:
        hot = F.broadcast(hot)
    cell = F.floor(F.col(ROW_ID) / F.lit(max_rows))
    columns = [F.col(f"`{c}`") for c in df.columns]
    marked = df.join(hot, entity, "left").withColumn("_cell", F.when(F.col(_FIXES).isNotNull(), cell))
    counts = stage(
        marked.where(F.col("_cell").isNotNull()).groupBy(entity, "_cell").agg(F.count(F.lit(1)).alias("_n")), "hot_counts"
    )
    cells = counts.agg(F.max("_cell")).first()[0] + 1
    starts = stage(_starts(counts, entity, cells), "hot_starts")

    width = F.lit(max(max_rows, lookback))
    in_cell = Window.partitionBy(entity, "_cell").orderBy(ROW_ID)
    numbered = (
        marked.where(F.col("_cell").isNotNull())
        .join(starts, [entity, "_cell"])
        .withColumn("_number", F.col("_start") + F.row_number().over(in_cell) - 1)
        .withColumn(BLOCK, F.floor(F.col("_number") / width))
    )
    later = F.when(
        (F.col("_number") % width >= width - F.lit(lookback)), F.array(F.col(BLOCK), F.col(BLOCK) + 1)
    ).otherwise(F.array(BLOCK))
    # what stands in a block after the first place is a copy of a row of the block before
    cut = numbered.select("*", F.posexplode(later).alias("_copy", "_into")).select(
        *columns, _FIXES, F.col("_into").alias(BLOCK), (F.col("_copy") == 0).alias(_CORE)
    )
    whole = marked.where(F.col("_cell").isNull()).select(
        *columns, _FIXES, F.lit(-1).cast("long").alias(BLOCK), F.lit(True).alias(_CORE)
    )
    return EntityFrames(whole.unionByName(cut), (entity, BLOCK), (ROW_ID,), split=True)
