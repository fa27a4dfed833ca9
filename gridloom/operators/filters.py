"""Filters and look-ups. Apart from the semi join of `components_of_type` and the small
top-k of `read_window` they are plain predicates that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.time import stamp


def filter_interconnect(df: DataFrame, value: str | None = None, column: str = "interconnect") -> DataFrame:
    """Rows of one interconnect; None keeps all."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def drop_isolated(bus: DataFrame, column: str = "bustype") -> DataFrame:
    """All buses but the isolated ones; a bus of unknown type (null) stays, see `unknown_codes`."""
    return bus.filter(~F.col(column).eqNullSafe("ISOLATED"))


def type_closure(spark: SparkSession, hierarchy: DataFrame) -> DataFrame:
    """(ancestor, descendant) pairs of a `(sub_type, super_type)` tree, each type with itself.

    The tree is metadata: one row per type, not per component.
    """
    return spark.sql(
        """
        with recursive walk(ancestor, descendant) as (
            select super_type, sub_type from {hierarchy}
            union all
            select h.super_type, w.descendant from walk w join {hierarchy} h on h.sub_type = w.ancestor
        )
        select distinct inline(array(
            struct(ancestor, descendant),
            struct(ancestor as ancestor, ancestor as descendant),
            struct(descendant as ancestor, descendant as descendant)))
        from walk
        """,
        hierarchy=hierarchy,
    )


def components_of_type(components: DataFrame, closure: DataFrame, type_name: str) -> DataFrame:
    """All components of a concrete or abstract type."""
    wanted = closure.filter(F.col("ancestor") == F.lit(type_name)).select(F.col("descendant").alias("comp_type"))
    return components.join(wanted, "comp_type", "left_semi")


def component_by_name(components: DataFrame, type_name: str, name: str) -> DataFrame:
    return components.filter((F.col("comp_type") == F.lit(type_name)) & (F.col("name") == F.lit(name)))


def from_initial_time(df: DataFrame, ts: str, start: str) -> DataFrame:
    return df.filter(F.col(ts) >= stamp(start))


def read_window(result: DataFrame, initial_time: str, count: int, column: str = "initial_time") -> DataFrame:
    """The first `count` executions at or after `initial_time`, each kept separate.

    The distinct starts are pre-aggregated and cut to the requested count before they meet the
    rows, so the semi join side has at most `count` rows.
    """
    later = result.filter(F.col(column) >= stamp(initial_time))
    starts = later.select(column).distinct().orderBy(column).limit(count)
    return later.join(starts, column, "left_semi")


def filter_entry_type(result: DataFrame, entries: Sequence[str], column: str = "entry") -> DataFrame:
    return result.filter(F.col(column).isin(list(entries)))


def zoom_range(traj: DataFrame, low: float, high: float, t: str = "t") -> DataFrame:
    """Open interval low < t < high."""
    return traj.filter((F.col(t) > F.lit(low)) & (F.col(t) < F.lit(high)))


def filter_resolution(series: DataFrame, seconds: int, column: str = "resolution_s") -> DataFrame:
    return series.filter(F.col(column) == F.lit(seconds))
