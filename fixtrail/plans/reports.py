"""Initial reports of a raw table."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.config import ENTITY, REGION
from fixtrail.operators.profile import (
    categorical_columns,
    categorical_describe,
    column_profile,
    entities_per_region,
    numeric_columns,
    numeric_describe,
)
from fixtrail.operators.staging import stage
from fixtrail.sources.sinks import write_csv

# Names of the report files.
COLUMNS_FILE = "DescricaoInicial_BaseDados.csv"
TEXTS_FILE = "EstatisticasIniciais_Categoricas.csv"
NUMBERS_FILE = "EstatisticasIniciais_Numericas.csv"
REGION_FILE = "quantidade_carros_por_ra.json"


def write_base_report(df: DataFrame, folder: str) -> None:
    """Column profile, and numeric and text statistics where such columns exist."""
    write_csv(
        column_profile(df).select("Coluna", "Tipo", "Nulos"),
        f"{folder}/{COLUMNS_FILE}",
    )
    if categorical_columns(df):
        write_csv(categorical_describe(df), f"{folder}/{TEXTS_FILE}")
    if numeric_columns(df):
        write_csv(numeric_describe(df), f"{folder}/{NUMBERS_FILE}")


def region_records(df: DataFrame) -> DataFrame:
    """Lines that make one JSON object, region -> distinct entities, one after another in the order of the regions.

    The regions are sorted over ranges; the two ends of the order open and close the object, so no task holds
    all of it. Without any region it is the empty object.
    """
    counted = stage(entities_per_region(df), "regions")
    ends = counted.agg(F.min(REGION).alias("first"), F.max(REGION).alias("last")).first()
    if ends["first"] is None:
        return df.sparkSession.createDataFrame([("{}",)], "value string")
    # the key as a JSON string: an object of it alone, without its braces and value
    key = F.regexp_replace(F.to_json(F.create_map(F.col(REGION).cast("string"), F.lit(0))), r"^\{(.*):0\}$", "$1")
    opening = F.when(F.col(REGION) == F.lit(ends["first"]), F.lit("{")).otherwise(F.lit(","))
    closing = F.when(F.col(REGION) == F.lit(ends["last"]), F.lit("}")).otherwise(F.lit(""))
    line = F.concat(opening, key, F.lit(":"), F.col("veiculos").cast("string"), closing)
    return counted.orderBy(REGION).select(line.alias("value"))


def write_region_report(df: DataFrame, folder: str) -> None:
    """One JSON object, a line for each region; the part files follow one another in the order of their names."""
    if not {REGION, ENTITY} <= set(df.columns):
        warnings.warn(f"no report without the columns {REGION} and {ENTITY}", stacklevel=2)
        return
    region_records(df).write.mode("overwrite").text(f"{folder}/{REGION_FILE}")
