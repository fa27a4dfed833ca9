"""Named datasets that are built once and read afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import remove_folder, shared_folder


def _root(spark: SparkSession, root: str | None) -> str:
    return (root or f"{shared_folder(spark)}/gridloom/datasets").rstrip("/")


_MARKER = "name string, category string, folder string, at long"


def _finished(spark: SparkSession, marker: str) -> str | None:
    """The data folder that the newest marker of a dataset names."""
    try:
        rows = spark.read.schema(_MARKER).parquet(marker)
        newest = rows.agg(F.max(F.struct("at", "folder")).alias("last")).first().last
    except AnalysisException:
        return None
    return newest and newest.folder


def materialize_once(
    spark: SparkSession,
    name: str,
    builder: Callable[[], DataFrame],
    root: str | None = None,
    rebuild: bool = False,
    category: str = "default",
) -> DataFrame:
    """Read the stored dataset, or build and write it first.

    Every build writes to a folder of its own; a one-row marker that names it is added after the data. A
    build that dies leaves no marker, so the data before it stay in use, and of two builders at the same
    time the one that ends last counts, each with whole data.
    """
    base = _root(spark, root)
    marker = f"{base}/done/dataset={name}"
    folder = None if rebuild else _finished(spark, marker)
    if folder is None:
        folder = f"{base}/data/{name}/{uuid.uuid4().hex}"
        builder().write.parquet(folder)
        row = spark.range(1).select(F.lit(name).alias("name"), F.lit(category).alias("category"), F.lit(folder).alias("folder"), F.unix_micros(F.current_timestamp()).alias("at"))
        row.write.mode("append").parquet(marker)
    return spark.read.parquet(folder)


def remove_superseded(spark: SparkSession, name: str, root: str | None = None) -> int:
    """Remove the data of all builds of a dataset but the newest, unfinished ones too; how many there were.

    To be called when no reader of an older build and no builder is at work.
    """
    base = _root(spark, root)
    newest = _finished(spark, f"{base}/done/dataset={name}")
    if newest is None:
        return 0
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/data/{name}")
    builds = [status.getPath().getName() for status in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    old = [b for b in builds if b != newest.rsplit("/", 1)[1]]
    for build in old:
        remove_folder(spark, f"{base}/data/{name}/{build}")
    return len(old)


def dataset_catalog(spark: SparkSession, root: str | None = None) -> DataFrame:
    """(name, category) of the finished datasets, as their last build has it."""
    rows = spark.read.schema(_MARKER).parquet(f"{_root(spark, root)}/done/*")
    return rows.groupBy("name").agg(F.max_by("category", "at").alias("category"))
