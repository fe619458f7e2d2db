"""Descriptive reports of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtrail.config import ENTITY, LAT, LON, REGION, TIME
from fixtrail.functions.calendar import moment_text, month_of
from fixtrail.functions.numeric import nan_to_null
from fixtrail.functions.quantiles import exact_percentiles


def dataset_profile(
    df: DataFrame,
    entity: str = ENTITY,
    time: str = TIME,
    lat: str = LAT,
    lon: str = LON,
    speed: str = "velocidade_kmh",
) -> DataFrame:
    """One row: entities, period, mean speed, days, months and the busiest location.

    The busiest location comes from a pre-aggregated count per coordinate pair as a scalar
    subquery; ties go to the smallest coordinates. Without any located row it is NULL.
    """
    located = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    per_place = located.groupBy(lat, lon).agg(F.count(entity).alias("n"))
    busiest = per_place.agg(F.min(F.struct(-F.col("n"), F.col(lat), F.col(lon))).alias("b"))
    mean_speed = F.avg(speed) if speed in df.columns else F.lit(0.0)
    return (
        df.agg(
            F.count_distinct(entity).cast("long").alias("total_veiculos"),
            F.min(time).alias("_first"),
            F.max(time).alias("_last"),
            mean_speed.alias("vel_media"),
            F.count_distinct(F.to_date(time)).cast("int").alias("dias_analise"),
            F.count_distinct(month_of(F.col(time))).cast("int").alias("meses_analise"),
        )
        .withColumn("_b", busiest.scalar())
        .select(
            "total_veiculos",
            F.concat_ws(" a ", moment_text(F.col("_first")), moment_text(F.col("_last"))).alias(
                "periodo"
            ),
            "vel_media",
            "dias_analise",
            "meses_analise",
            F.col(f"_b.{lat}").alias("local_mais_fluxo_latitude"),
            F.col(f"_b.{lon}").alias("local_mais_fluxo_longitude"),
            (-F.col("_b.col1")).cast("long").alias("fluxo_veiculos_local"),
        )
    )


def entities_per_region(df: DataFrame, region: str = REGION, entity: str = ENTITY) -> DataFrame:
    """Distinct entities per region; rows without a region are left out.

    Spark removes duplicates per (region, entity) first, so a large region is spread out.
    """
    missing = [c for c in (region, entity) if c not in df.columns]
    if missing:
        raise ValueError(f"cannot count entities per region without the columns {missing}")
    return (
        df.where(F.col(region).isNotNull())
        .groupBy(region)
        .agg(F.count_distinct(entity).alias("veiculos"))
    )


def entity_sketches(
    df: DataFrame, by: Sequence[str] = (REGION,), entity: str = ENTITY, precision: int = 12, sketch: str = "sketch"
) -> DataFrame:
    """A mergeable sketch of the entities of every group, as a table that can be kept and added to.

    Sketches are HyperLogLog of ``2**precision`` cells, built map-side, so a large group costs no more to shuffle
    than a small one. The standard error of a count is about ``1.04 / sqrt(2**precision)``, 1.6 % by default. Rows with a null among
    ``by`` are left out, as are null entities.
    """
    rows = df.dropna(subset=list(by)).withColumn("_entity", F.col(f"`{entity}`").cast("string"))
    return rows.groupBy(*by).agg(F.hll_sketch_agg("_entity", precision).alias(sketch))


def merged_sketches(sketches: DataFrame, by: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """Sketches of coarser groups, from those of finer ones or of several days."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(sketch).alias(sketch))


def approximate_entities(sketches: DataFrame, output: str = "veiculos", sketch: str = "sketch") -> DataFrame:
    """The estimated number of distinct entities in place of each sketch."""
    return sketches.withColumn(output, F.hll_sketch_estimate(sketch)).drop(sketch)


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type and number of nulls of each column, from one aggregate; NaN counts as null."""

    def missing(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        floating = isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType)
        return value.isNull() | F.isnan(value) if floating else value.isNull()

    parts = [F.count_if(missing(f)).alias(f"c{i}") for i, f in enumerate(df.schema)]
    rows = [
        F.struct(
            F.lit(i).alias("posicao"),
            F.lit(c).alias("Coluna"),
            F.lit(t).alias("Tipo"),
            F.col(f"c{i}").alias("Nulos"),
            F.col("total").alias("num_linhas"),
            F.lit(len(df.columns)).alias("num_colunas"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count(F.lit(1)).alias("total"), *parts).select(F.inline(F.array(*rows)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, range and exact quartiles, one row per column."""
    columns = list(columns or numeric_columns(df))
    if not columns:
        raise ValueError("the table has no numeric column")
    values = {c: nan_to_null(F.col(f"`{c}`").cast("double")) for c in columns}
    quartiles = exact_percentiles(df, values, [25, 50, 75])
    parts, rows = [], []
    for i, (c, v) in enumerate(values.items()):
        parts += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"m{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"l{i}"),
            F.max(v).alias(f"h{i}"),
        ]
        cut = quartiles.get(c, {})
        rows.append(
            F.struct(
                F.lit(c).alias("coluna"),
                F.col(f"n{i}").alias("count"),
                F.col(f"m{i}").alias("mean"),
                F.col(f"s{i}").alias("std"),
                F.col(f"l{i}").alias("min"),
                *[F.lit(cut.get(p)).cast("double").alias(f"p{p}") for p in (25, 50, 75)],
                F.col(f"h{i}").alias("max"),
            )
        )
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def categorical_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency, one row per column.

    All columns are counted per value in one pre-aggregated pass; among equally frequent
    values the smallest is reported.
    """
    columns = list(columns or categorical_columns(df))
    if not columns:
        raise ValueError("the table has no text column")
    pairs = F.array(
        *[F.struct(F.lit(c).alias("coluna"), F.col(f"`{c}`").alias("value")) for c in columns]
    )
    per_value = (
        df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("coluna", "value").count()
    )
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col("value").alias("value")))
    return (
        per_value.groupBy("coluna")
        .agg(F.sum("count").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("_best"))
        .select(
            "coluna",
            "count",
            "unique",
            F.col("_best.value").alias("top"),
            (-F.col("_best.n")).alias("freq"),
        )
    )
