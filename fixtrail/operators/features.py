"""The full feature table of a set of sightings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fixtrail.config import ENTITY, LAT, LON, ONE_HOT_PREFIX, REGION, ROW_ID, TIME
from fixtrail.functions.calendar import with_calendar_features, with_holiday_flag
from fixtrail.operators.kinematics import LOOKBACK, with_kinematics
from fixtrail.operators.lookback import EntityFrames, entity_frames
from fixtrail.operators.onehot import with_one_hot


def scaled_features(columns: Sequence[str]) -> list[str]:
    """Features that are standardised, in order; hour and coordinates stay raw."""
    wanted = ["hora_sin", "hora_cos", "dia_sem", "eh_feriado"]
    wanted += ["velocidade_kmh", "dist_m", "aceleracao"]
    wanted += [c for c in columns if c.startswith(f"{ONE_HOT_PREFIX}_")]
    present = set(columns)
    return [c for c in wanted if c in present]


def has_coordinates(df: DataFrame) -> bool:
    return {LAT, LON} <= set(df.columns)


def apply_features(
    frames: EntityFrames,
    region_values: Sequence = (),
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Features over prepared frames, before the copied rows are dropped.

    Coordinate features appear only with both coordinates, region columns only with a
    region column.
    """
    df = frames.rows
    if has_coordinates(df):
        df = with_kinematics(df, frames.window)
    df = with_calendar_features(df)
    df = with_holiday_flag(df, holidays)
    if REGION in df.columns:
        df = with_one_hot(df, region_values)
    return df


def build_features(
    df: DataFrame,
    region_values: Sequence = (),
    order: Sequence[str] = (TIME,),
    max_rows_per_task: int = 2_000_000,
    holidays: DataFrame | None = None,
    total_rows: int | None = None,
) -> DataFrame:
    """Feature table with one row per sighting; rows lacking a feature are dropped."""
    if ROW_ID in df.columns:
        order = (ROW_ID,)
    frames = entity_frames(df, LOOKBACK, max_rows_per_task, ENTITY, order, total_rows)
    out = frames.finish(apply_features(frames, region_values, holidays))
    return out.dropna(subset=[f"`{c}`" for c in scaled_features(out.columns)])
