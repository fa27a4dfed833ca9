"""Joins of rows with one-row-per-key tables when one key may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.time import day_block

BLOCK_DAYS = 7


def blocked_join(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], ts: str, first: str = "first_ts", last: str = "last_ts", days: int = BLOCK_DAYS
) -> DataFrame:
    """Inner join of series rows with a row per series, spread over the time of the series.

    For tables that are themselves grouped by the keys: Spark would join them where the grouping left
    them, and its adaptive skew handling cannot split such a join. Rows join by series and block of
    days; the table has a copy for each block between the series' own `first` and `last` stamp,
    so the number of tasks that share a series grows with it. Rows without a stamp are a block of
    their own. Where the table is small enough, Spark broadcasts it and the block plays no part.
    """
    keys, none = list(keys), F.lit(None).cast("long")
    row_block = F.coalesce(day_block(ts, days), F.lit(-1))
    whole = F.when(F.col(first).isNull() | F.col(last).isNull(), F.array(none)).otherwise(F.sequence(day_block(first, days), day_block(last, days)))
    blocks = F.array_append(F.filter(whole, lambda b: b.isNotNull() & (b != -1)), F.lit(-1).cast("long"))
    copies = per_key.select("*", F.explode(blocks).alias("__block"))
    return rows.withColumn("__block", row_block.cast("long")).join(copies, [*keys, "__block"]).drop("__block")
