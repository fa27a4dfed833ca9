"""Top-k look-ups and set operations on component tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_run(runs: DataFrame, name: str = "run_name", folder: str = "folder") -> DataFrame:
    """The newest run folder of each name: the largest numeric folder name."""
    number = F.col(folder).try_cast("long")
    return (
        runs.filter(number.isNotNull())
        .groupBy(name)
        .agg(F.max_by(F.col(folder), number).alias(folder))
    )


def first_match(df: DataFrame, condition: Column, order: Sequence[str]) -> DataFrame:
    return df.filter(condition).orderBy(*order).limit(1)


def concat_devices(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def remove_components(
    components: DataFrame, removed: DataFrame, attached: DataFrame | None = None,
    keys: Sequence[str] = ("comp_type", "name"),
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Drop named devices, and the rows of `attached` that hang on them."""
    keys = list(keys)
    gone = removed.select(*keys)
    kept = components.join(gone, keys, "left_anti")
    return kept if attached is None else (kept, attached.join(gone, keys, "left_anti"))


def convert_to_dynamic_branch(
    line: DataFrame, dynamic: DataFrame, names: DataFrame, key: str = "name"
) -> tuple[DataFrame, DataFrame]:
    """Move named lines from the static to the dynamic table."""
    moved = names.select(key)
    return (
        line.join(moved, key, "left_anti"),
        dynamic.unionByName(line.join(moved, key, "left_semi"), allowMissingColumns=True),
    )
