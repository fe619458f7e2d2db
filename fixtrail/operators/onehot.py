"""One-hot encoding of a categorical column: named 0/1 columns, or an index and a sparse vector.

Named columns need the values on the driver and so a limit. The index form has none: values are numbered in
their order by a sorted range exchange, rows get their number by a join, and the vector of a row
holds one entry however many values there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.config import ONE_HOT_PREFIX, REGION
from fixtrail.operators.rowindex import with_row_id
from fixtrail.operators.staging import stage


#: Names of the index and vector columns; without the prefix of named columns, so models don't take them for such.
INDEX, VECTOR = "regiao_indice", "regiao_vetor"


def category_index(df: DataFrame, column: str = REGION, index: str = INDEX) -> tuple[DataFrame, int]:
    """A table of the distinct values with their numbers 0, 1, ... in lexical order, and how many there are."""
    found = df.select(column).dropna().distinct()
    numbered = with_row_id(found, order_by=(column,), ties=(), row_id=index)
    return numbered.rows.select(column, index), numbered.count


def with_category_index(df: DataFrame, column: str = REGION, index: str = INDEX, vector: str | None = VECTOR) -> DataFrame:
    """``index`` and sparse one-hot ``vector`` in place of ``column``; NULL has no index and an all-zero vector.

    A value shared by many rows costs the join nothing: Spark splits its partition, and the table of
    values holds it once.
    """
    values, count = category_index(df, column, index)
    joined = df.join(stage(values, "category_index"), column, "left").drop(column)
    if vector is None:
        return joined
    # one more category, which the encoder drops, stands for NULL
    width = max(count, 1)
    facts = {"ml_attr": {"type": "nominal", "name": index, "num_vals": width + 1}}
    known = joined.withColumn("_category", F.coalesce(index, F.lit(width)).cast("double").alias("_category", metadata=facts))
    encoder = OneHotEncoder(inputCols=["_category"], outputCols=[vector], dropLast=True)
    return encoder.fit(known).transform(known).drop("_category")


def few_categories(df: DataFrame, column: str = REGION, limit: int = 1_000) -> list | None:
    """Sorted distinct values, or None for more than ``limit``: ``with_category_index`` has no limit."""
    found = [r[0] for r in df.select(column).dropna().distinct().limit(limit + 1).collect()]
    return sorted(found) if len(found) <= limit else None


def categories(df: DataFrame, column: str = REGION, limit: int = 1_000) -> list:
    """Sorted distinct values for named columns; more than ``limit`` is an error, not a truncation."""
    found = few_categories(df, column, limit)
    if found is None:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return found


def one_hot_name(value, prefix: str = ONE_HOT_PREFIX) -> str:
    return f"{prefix}_{value}"


def with_one_hot(
    df: DataFrame,
    values: Sequence,
    column: str = REGION,
    prefix: str = ONE_HOT_PREFIX,
) -> DataFrame:
    """A 0/1 double column per category in place of ``column``; NULL gives all zeros."""
    added = [
        F.coalesce((F.col(column) == F.lit(v)).cast("double"), F.lit(0.0)).alias(
            one_hot_name(v, prefix)
        )
        for v in values
    ]
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*kept, *added)
