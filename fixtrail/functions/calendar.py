"""Calendar columns and the holiday dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.config import TIME

# Years covered by the generated holiday table; it has a fixed size of a few thousand rows.
FIRST_YEAR, LAST_YEAR = 1900, 2100

# Public holidays on fixed dates as (month, day, first year of observance).
# National list, then the two dates of the federal district.
FIXED_HOLIDAYS = (
    (1, 1, 1900),
    (4, 21, 1933),
    (5, 1, 1925),
    (9, 7, 1900),
    (10, 12, 1980),
    (11, 2, 1900),
    (11, 15, 1900),
    (11, 20, 2024),
    (12, 25, 1922),
    (4, 21, 1960),
    (11, 30, 1996),
)


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def weekday_of(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def weekday_name(ts: Column) -> Column:
    return F.date_format(F.to_date(ts), "EEEE")


def hour_cycle(hour: Column) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * hour / F.lit(24)
    return F.sin(angle), F.cos(angle)


def with_calendar_features(df: DataFrame, time: str = TIME) -> DataFrame:
    hour = hour_of(F.col(time))
    sin, cos = hour_cycle(hour)
    return df.withColumns(
        {"hora": hour, "dia_sem": weekday_of(F.col(time)), "hora_sin": sin, "hora_cos": cos}
    )


def seconds_between(earlier: Column, later: Column) -> Column:
    """Elapsed seconds of two zone-less timestamps, to the microsecond.

    The difference is taken as an interval: ``timestampdiff`` would go through the session
    time zone and be an hour off around a clock change.
    """
    return (later - earlier).cast("interval second").cast("decimal(20,6)").cast("double")


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def moment_text(ts: Column) -> Column:
    """Zone-less timestamp as text; six digits of microseconds where there are any."""
    text = ts.cast("string")
    return F.when(F.length(text) == 19, text).otherwise(F.rpad(text, 26, "0"))


def _good_friday(year: Column) -> Column:
    """Two days before Easter Sunday of the Gregorian calendar (Gauss' rule as extended)."""
    golden = year % 19
    century = F.floor(year / 100)
    skipped_leaps = century - F.floor(century / 4)
    lunar = F.floor((century * 8 + 13) / 25)
    epact = (skipped_leaps - lunar + golden * 19 + 15) % 30
    # the latest possible full moon is pulled back by a day in two cases
    moon = epact - F.when((epact == 29) | ((epact == 28) & (golden >= 11)), 1).otherwise(0)
    march21 = F.make_date(year.cast("int"), F.lit(3), F.lit(21))
    full_moon = F.date_add(march21, moon.cast("int"))
    # first Sunday strictly after the full moon, minus two days
    return F.date_sub(F.next_day(full_moon, "Sunday"), 2)


def holiday_table(
    spark: SparkSession, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
) -> DataFrame:
    """One row per holiday date: fixed national and federal-district dates and Good Friday.

    Optional days off (carnival, Corpus Christi) are left out. Any DataFrame with a ``day``
    date column can be used in its place.
    """
    year = F.col("year").cast("int")
    fixed = [
        F.when(year >= since, F.make_date(year, F.lit(month), F.lit(day)))
        for month, day, since in FIXED_HOLIDAYS
    ]
    years = spark.range(first_year, last_year + 1, numPartitions=1).withColumnRenamed("id", "year")
    days = F.array_compact(F.array(*fixed, _good_friday(F.col("year"))))
    return years.select(F.explode(F.array_distinct(days)).alias("day"))


def is_holiday(day: Column) -> Column:
    """Whether a date of any year is one of the fixed dates or Good Friday."""
    year, month, number = F.year(day), F.month(day), F.dayofmonth(day)
    found = month.isin(3, 4) & (day == _good_friday(year))  # worked out in its two months only
    for m, d, since in FIXED_HOLIDAYS:
        same = (month == m) & (number == d)
        # dates listed from the first year of the table have no known beginning
        found |= same if since <= FIRST_YEAR else same & (year >= since)
    return found


def with_holiday_flag(
    df: DataFrame,
    holidays: DataFrame | None = None,
    time: str = TIME,
    output: str = "eh_feriado",
) -> DataFrame:
    """1 on a holiday, else 0: from the row's own date, or by a left join with ``holidays``."""
    if holidays is None:
        return df.withColumn(output, F.coalesce(is_holiday(F.to_date(F.col(time))), F.lit(False)).cast("int"))
    # a caller's table is left to Spark's own size check
    days = holidays.select("day").distinct()
    days = days.select(F.col("day").alias("_day"))
    return df.join(days, F.to_date(F.col(time)) == F.col("_day"), "left").withColumn(
        output, F.col("_day").isNotNull().cast("int")
    ).drop("_day")
