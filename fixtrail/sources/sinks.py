"""Writers of result tables, and runs that are published whole.

A run is written into a folder of its own, and only when all of its tables are there a small
manifest is put in place that names them. Readers start from the manifest, so they see the last whole run or the one
before it, never half of one; a run that fails leaves nothing that anyone reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtrail.config import ENTITY, LAT, LON, TIME
from fixtrail.functions.calendar import moment_text
from fixtrail.sources.tables import CSV_OPTIONS, read_families

# Name prefix of a family -> stem of its files.
FAMILY_FILES = (("ISO", "iso"), ("HBOS", "hbos"), ("LSTM", "lstm"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; times show microseconds only where there are any."""
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    text = df.withColumns({c: moment_text(F.col(f"`{c}`")) for c in times}) if times else df
    text.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def family_metrics(metrics: DataFrame, prefix: str) -> DataFrame:
    return metrics.where(F.col("Model").startswith(prefix))


def write_family_metrics(metrics: DataFrame, folder: str) -> list[str]:
    """One CSV per family; a family without rows writes nothing.

    The metrics table has one row per model and percentile.
    """
    present = {r[0] for r in metrics.select("Model").distinct().collect()}
    if not present:
        raise RuntimeError("no threshold metrics were produced")
    written = []
    for prefix, stem in FAMILY_FILES:
        if any(m.startswith(prefix) for m in present):
            path = f"{folder}/{stem}_metrics.csv"
            write_csv(family_metrics(metrics, prefix), path)
            written.append(path)
    return written


def family_results(
    df: DataFrame, prefix: str, ids: Sequence[str] = (ENTITY, TIME, LAT, LON)
) -> DataFrame:
    """Identifying columns that exist, then every column of the family."""
    columns = [c for c in ids if c in df.columns]
    columns += [c for c in df.columns if c.startswith(prefix)]
    return df.select(*[f"`{c}`" for c in columns])


def write_family_results(df: DataFrame, folder: str) -> None:
    for prefix, stem in FAMILY_FILES:
        write_csv(family_results(df, prefix), f"{folder}/{stem}_results.csv")


def write_compiled_families(spark: SparkSession, glob: str, folder: str) -> list[str]:
    """All result files of a family stacked into one CSV per family; a family without files writes nothing."""
    stems = dict(FAMILY_FILES)
    written = []
    for family, df in read_families(spark, glob).items():
        path = f"{folder}/{stems[family]}_compiled.csv"
        write_csv(df, path)
        written.append(path)
    return written


_MANIFEST = "published.json"


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def published_run(spark: SparkSession, folder: str) -> str:
    """Folder of the run that the manifest names; an error if none was published."""
    target, system = _folder(spark, f"{folder}/{_MANIFEST}")
    if not system.exists(target):
        raise FileNotFoundError(f"no run was published in {folder}")
    manifest = json.loads(spark.read.text(f"{folder}/{_MANIFEST}", wholetext=True).first()[0])
    return f"{folder}/{manifest['run']}"


def publish(spark: SparkSession, folder: str, write: Callable[[str], None], keep: int = 1) -> str:
    """Let ``write`` fill a new run folder, then make it the published one.

    The manifest is written beside and renamed, so it is there whole or not at all. Of the earlier runs the last
    ``keep`` stay for readers that still use them.
    """
    run = f"runs/{uuid.uuid4().hex}"
    write(f"{folder}/{run}")
    final, system = _folder(spark, f"{folder}/{_MANIFEST}")
    before: list[str] = []
    if system.exists(final):
        manifest = json.loads(spark.read.text(f"{folder}/{_MANIFEST}", wholetext=True).first()[0])
        before = [manifest["run"], *manifest["before"]]
    fresh, _ = _folder(spark, f"{folder}/{run}.json")
    out = system.create(fresh, True)
    out.write(bytearray(json.dumps({"run": run, "before": before[:keep]}), "utf-8"))
    out.close()
    modes = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(modes, 1)
    options[0] = modes.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, final, options)
    for old in before[keep:]:
        target, system = _folder(spark, f"{folder}/{old}")
        system.delete(target, True)
    return f"{folder}/{run}"
