"""Scans of sightings and of result files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtrail.config import ENTITY, LAT, LON, TIME
from fixtrail.functions.numeric import nan_to_null

# Texts that mean "missing" in a CSV cell.
CSV_MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


#: How cells are quoted, in reading and in writing: a quote inside a cell is doubled, white space belongs to the cell.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_RECORD = "_corrupt_record"


def _without_surplus(raw: DataFrame, columns: int) -> DataFrame:
    """An error for a record with more cells than the header; one with fewer has nulls at its end.

    A record of another length than the header comes with its text. Its cells are counted by the
    separators outside quotes.
    """
    outside = F.regexp_replace(_RECORD, r'"(?:[^"]|"")*"', "")
    separators = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    # with a cell in it, since Spark doesn't read the record's text alone
    cell = F.coalesce(F.col(f"`{raw.columns[0]}`").cast("string"), F.lit(""))
    message = F.concat(F.lit(f"CSV record with more than {columns} cells, beginning with "), cell, F.lit(": "), F.substring(_RECORD, 1, 200))
    ragged = F.when(separators >= columns, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return raw.where(F.col(_RECORD).isNull() | ragged).drop(_RECORD)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = False, multi_line: bool = True
) -> DataFrame:
    """CSV with a header; quoted cells may hold separators, quotes and line breaks.

    A file with line breaks in cells can't be cut at arbitrary lines, so each file is read by one task;
    ``multi_line=False`` cuts large files without such cells. The header is read first, so that a surplus cell is told from a
    missing one: records with surplus cells raise an error, records with fewer are filled with nulls.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    if schema is None:
        found = reader.option("inferSchema", infer).csv(path).schema
    else:
        found = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_record = T.StructType([*found.fields, T.StructField(_RECORD, T.StringType())])
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).schema(with_record).csv(path)
    return _without_surplus(raw, len(found)) if len(found) else raw.drop(_RECORD)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Parquet when the path ends in ``.parquet``, otherwise CSV with a header (see ``read_csv``).

    Without ``schema`` or ``infer`` the CSV columns stay text, so no inference pass reads
    the file; ``standardize`` gives the columns that matter their types.
    """
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raw = read_csv(spark, path, schema, infer, multi_line)
    return raw.select(
        *[
            F.when(~F.col(f"`{c}`").isin(*CSV_MISSING), F.col(f"`{c}`")).alias(c)
            if t == "string"
            else F.col(f"`{c}`")
            for c, t in raw.dtypes
        ]
    )


def read_first(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """The first of several candidate paths that exists."""
    for path in paths:
        try:
            return read_table(spark, path, **options)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
    raise FileNotFoundError(f"none of {list(paths)} exists")


def _row_text(df: DataFrame) -> Column:
    """The row as JSON, to name it in an error."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def _as_time(df: DataFrame, name: str, patterns: Sequence[str] = ()) -> Column:
    """ISO text first, then the patterns in order; text that none of them reads is an error that names the row."""
    kind = df.schema[name].dataType
    raw = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampNTZType):
        return raw
    if not isinstance(kind, T.StringType):
        return raw.cast("timestamp_ntz")
    text = F.trim(raw)
    # a pattern without a zone reads wall-clock time: through the session's zone and back
    by_pattern = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in patterns]
    parsed = F.coalesce(raw.try_cast("timestamp_ntz"), *by_pattern)
    bad = F.raise_error(F.concat(F.lit(f"cannot read {name} as a timestamp: "), raw, F.lit(" in "), _row_text(df)))
    return F.when(raw.isNotNull() & parsed.isNull(), bad.cast("timestamp_ntz")).otherwise(parsed)


def _as_double(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    raw = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        number = raw.try_cast("double")
        bad = F.raise_error(F.concat(F.lit(f"cannot read {name} as a number: "), raw))
        value = F.when(raw.isNotNull() & number.isNull(), bad.cast("double")).otherwise(number)
    else:
        value = raw.cast("double")
    return nan_to_null(value)


def standardize(
    df: DataFrame,
    column_map: Mapping[str, str],
    time: str = TIME,
    entity: str = ENTITY,
    coordinates: Sequence[str] = (LAT, LON),
    time_patterns: Sequence[str] = (),
) -> DataFrame:
    """Rename, type and drop rows without a time or an entity.

    Names missing from the input are ignored. A text that is no timestamp or number is an
    error. Times may be ISO text or follow one of ``time_patterns`` (such as ``dd/MM/yyyy HH:mm``). Coordinates may be null; NaN
    coordinates become null.
    """
    df = df.withColumnsRenamed(dict(column_map))
    missing = [c for c in (time, entity) if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing} after renaming")
    typed = {time: _as_time(df, time, time_patterns)}
    typed |= {c: _as_double(df, c) for c in coordinates if c in df.columns}
    # plain predicates, because those reach a Parquet scan
    return df.withColumns(typed).where(F.col(time).isNotNull() & F.col(entity).isNotNull())


# Family of a result file, told by a part of its name, in order of preference.
FAMILIES = ("ISO", "HBOS", "LSTM")


def family_of(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for family in reversed(FAMILIES):
        out = F.when(name.contains(family), F.lit(family)).otherwise(out)
    return out


def read_families(spark: SparkSession, glob: str) -> dict[str, DataFrame]:
    """Result CSVs matching ``glob``, stacked by column name per detector family.

    A result is one CSV file or one folder of part files, and there is one per model, so
    the list is short. Results of no known family are left out; a column that a result
    lacks is null there.
    """
    whole = F.regexp_replace("path", r"(\.csv)/[^/]*$", "$1")  # folder of a part file
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(glob)
        .select(whole.alias("path"))
        .distinct()
        .withColumn("family", family_of(F.element_at(F.split("path", "/"), -1)))
        .where("family IS NOT NULL")
        .orderBy("path")
    )
    out: dict[str, DataFrame] = {}
    for row in listing.collect():
        part = read_table(spark, row["path"])
        before = out.get(row["family"])
        out[row["family"]] = (
            part if before is None else before.unionByName(part, allowMissingColumns=True)
        )
    return out
