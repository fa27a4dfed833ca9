"""What several operators share: intermediate tables and Arrow output."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import fresh_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def as_bytes(text: str | Column) -> Column:
    """The UTF-8 bytes of a text as they are stored; null becomes empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string").cast("binary"), F.lit(b""))


def sliced(batches: Iterator[pa.RecordBatch], column: int | str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in `slices`."""
    for batch in batches:
        at = batch.schema.get_field_index(column) if isinstance(column, str) else column
        yield from slices(batch, at, most or TEXT_AT_ONCE)


#: Bytes of text that a worker holds as Python objects at a time.
TEXT_AT_ONCE = 1 << 20


def slices(batch: pa.RecordBatch, column: int, most: int = TEXT_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, in order, with about `most` bytes in a text column each; a longer text is in a part with few others.

    Arrow batches are counted in rows. What a worker makes of their texts is many times their size, so it is made of
    one such part after the other.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    cuts = [0, *(np.flatnonzero(np.diff(begin // most)) + 1).tolist(), batch.num_rows]
    for at, until in zip(cuts, cuts[1:]):
        if until > at:
            yield batch.slice(at, until - at)
