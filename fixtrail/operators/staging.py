"""Write an intermediate result once to shared storage and read it back.

A staged table cuts lineage, survives the loss of executors, and gives later jobs column
pruning and filter pushdown. Tables go below ``spark.checkpoint.dir`` of the session, which the driver and the executors share. Only a local
session may do without it; it uses its warehouse folder then.
They are removed by the scope they were made in, or else at the end of the application.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def _hadoop(spark: SparkSession, path: str):
    """The folder as a Hadoop path, and the file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_folder(spark: SparkSession, name: str, outlives: bool = False) -> str:
    """A new folder name on shared storage, removed with its scope or the application.

    With ``outlives`` it belongs to the scope around the innermost one.
    """
    path = f"{scratch_root(spark)}/fixtrail/{uuid.uuid4().hex}/{name}"
    scopes = _scopes[:-1] if outlives else _scopes
    if scopes:
        scopes[-1].append(path)
    target, system = _hadoop(spark, path)
    system.deleteOnExit(target.getParent())
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_folder`` together with its own parent."""
    target, system = _hadoop(spark, path)
    system.delete(target.getParent(), True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove every table staged inside the block when it ends; results must be stored by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            remove_folder(spark, path)


def stage(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), outlives: bool = False, compression: str | None = None
) -> DataFrame:
    """Materialise ``df`` as Parquet and return a scan over the result; ``outlives`` as in ``scratch_folder``."""
    spark = df.sparkSession
    path = scratch_folder(spark, name, outlives)
    writer = df.write
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
