"""Result store: long rows partitioned by problem, kind and entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.time import day_block, plus_seconds, stamp
from gridloom.operators.series import realized

PARTITIONS = ["problem", "kind", "entry"]


def write_result(
    result: DataFrame, path: str, mode: str = "overwrite", sort_by: str = "initial_time", file_days: int | None = None
) -> None:
    """Write partitioned by entry.

    By default rows stay where they are, so an entry with most rows is written by many tasks. With
    `file_days` the rows are first brought together by entry and block of days of `sort_by`: few
    files per folder on a large cluster, and a large entry is still spread over its blocks.
    """
    if file_days is not None:
        result = result.repartition(*PARTITIONS, day_block(sort_by, file_days))
    result.sortWithinPartitions(*PARTITIONS, sort_by).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def read_result(spark: SparkSession, path: str, problem: str, kind: str, entry: str) -> DataFrame:
    """One entry; the three equality filters select folders before anything is read."""
    return (
        spark.read.parquet(path)
        .filter((F.col("problem") == problem) & (F.col("kind") == kind) & (F.col("entry") == entry))
    )


def read_realized(
    spark: SparkSession, path: str, problem: str, kind: str, entry: str, interval_s: int, initial_time: str | None = None, count: int | None = None
) -> DataFrame:
    """Realised rows of one entry: of each execution its first interval, from `initial_time` on and of `count` executions.

    The window is a plain range of initial times, so it reaches the scan like the entry's folders do.
    """
    rows = read_result(spark, path, problem, kind, entry)
    if initial_time is not None:
        rows = rows.filter(F.col("initial_time") >= stamp(initial_time))
        if count is not None:
            rows = rows.filter(F.col("initial_time") < plus_seconds(stamp(initial_time), count * interval_s))
    return realized(rows, interval_s)
