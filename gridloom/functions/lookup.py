"""Look-ups in tables of codes, as map literals or as joins.

A table that the program writes out is a map literal: no join and no shuffle. A table that is data is
a DataFrame and is joined; how is Spark's choice by its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_map(table: Mapping[Any, Any]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, table.keys())), F.array(*map(F.lit, table.values())))


def look_up(key: Column, table: Mapping[Any, Any], default: Any = None) -> Column:
    if not table:
        return F.lit(default)
    found = F.try_element_at(literal_map(table), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def join_look_up(df: DataFrame, keys: Sequence[Column], table: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Add the columns `values` ({column: default}) of `table`, whose first columns are the keys, one row per key."""
    names = table.columns[: len(keys)]
    renamed = table.select(*(F.col(n).alias(f"__key{i}") for i, n in enumerate(names)), *(F.col(v).alias(f"__value{i}") for i, v in enumerate(values)))
    met = F.lit(True)
    for i, key in enumerate(keys):
        met = met & (key == F.col(f"__key{i}"))
    found = df.join(renamed, met, "left").drop(*(f"__key{i}" for i in range(len(keys))))
    filled = {name: F.col(f"__value{i}") if default is None else F.coalesce(F.col(f"__value{i}"), F.lit(default)) for i, (name, default) in enumerate(values.items())}
    return found.withColumns(filled).drop(*(f"__value{i}" for i in range(len(values))))
