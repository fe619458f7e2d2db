"""Distance, speed and acceleration between consecutive fixes of an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from fixtrail.config import LAT, LON, TIME
from fixtrail.functions.calendar import seconds_between
from fixtrail.functions.geo import haversine_m
from fixtrail.functions.numeric import nan_to_null

# rows before the current one that the features depend on: acceleration needs the previous
# speed, which needs the fix before that
LOOKBACK = 2


def elapsed_seconds(window: WindowSpec, time: str = TIME) -> Column:
    """Seconds since the previous fix, NULL on the first one."""
    return seconds_between(F.lag(time).over(window), F.col(time))


def with_kinematics(
    df: DataFrame,
    window: WindowSpec,
    time: str = TIME,
    lat: str = LAT,
    lon: str = LON,
) -> DataFrame:
    """Add ``dist_m``, ``velocidade_kmh`` and ``aceleracao``.

    The first fix has distance, speed and acceleration 0, and the second is measured
    against that 0. A missing previous latitude or longitude is replaced by the current one,
    each on its own. Two fixes at the same instant have speed and acceleration 0. All lags
    share one window, so there is one exchange and one sort.
    """
    lat_now, lon_now = F.col(lat), F.col(lon)
    distance = haversine_m(
        lat_now,
        lon_now,
        F.coalesce(F.lag(lat).over(window), lat_now),
        F.coalesce(F.lag(lon).over(window), lon_now),
    )
    moved = df.withColumns(
        {
            "_dt": F.coalesce(elapsed_seconds(window, time), F.lit(0.0)),
            "dist_m": F.coalesce(nan_to_null(distance), F.lit(0.0)),
        }
    )
    speed = F.try_divide(F.col("dist_m") / 1000, F.col("_dt") / 3600)
    moved = moved.withColumn("velocidade_kmh", F.coalesce(speed, F.lit(0.0)))
    change = (F.col("velocidade_kmh") - F.lag("velocidade_kmh").over(window)) * 1000 / 3600
    return moved.withColumn(
        "aceleracao", F.coalesce(F.try_divide(change, F.col("_dt")), F.lit(0.0))
    ).drop("_dt")
