"""Joins between component tables and series.

No side carries a broadcast hint: Spark's size statistics (and adaptive execution at run
time) decide whether a side is small enough, and fall back to a shuffled join with skew
handling when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.time import epoch_micros, floor_time
from gridloom.operators.ordered import carry_forward


def join_gencost(gen: DataFrame, cost: DataFrame, key: str = "plant_id", suffix: str = "_1") -> DataFrame:
    """Inner join; right columns that exist on the left get the suffix."""
    taken = set(gen.columns) - {key}
    right = cost.select(*[F.col(c).alias(c + suffix if c in taken else c) for c in cost.columns])
    return gen.join(right, key, "inner")


def join_zone(bus: DataFrame, zone: DataFrame, key: str = "zone_id") -> DataFrame:
    return bus.join(zone, key, "left")


def join_branch_ends(
    branch: DataFrame, bus: DataFrame, bus_id: str = "bus_id", base_kv: str = "base_kv"
) -> DataFrame:
    """Add the base voltage of both ends; ends without a bus stay null."""

    def end(role: str) -> DataFrame:
        return bus.select(F.col(bus_id).alias(f"{role}_bus_id"), F.col(base_kv).alias(f"{role}_{base_kv}"))

    return branch.join(end("from"), "from_bus_id", "left").join(end("to"), "to_bus_id", "left")


def dcline_semi(dcline: DataFrame, bus: DataFrame, bus_id: str = "bus_id") -> DataFrame:
    """Links with both ends in the bus table."""
    ids = bus.select(bus_id)
    return dcline.join(ids.withColumnRenamed(bus_id, "from_bus_id"), "from_bus_id", "left_semi").join(
        ids.withColumnRenamed(bus_id, "to_bus_id"), "to_bus_id", "left_semi"
    )


def resolve_arcs(line: DataFrame, arc: DataFrame, bus: DataFrame) -> DataFrame:
    """Line to arc to the name and number of both buses, by identifier.

    Expects `line.arc_id`, `arc(arc_id, from_id, to_id)` and `bus(bus_uuid, number, bus_name)`.
    """

    def end(role: str) -> DataFrame:
        return bus.select(
            F.col("bus_uuid").alias(f"{role}_id"),
            F.col("number").alias(f"{role}_number"),
            F.col("bus_name").alias(f"{role}_name"),
        )

    return (
        line.join(arc, "arc_id")
        .join(end("from"), "from_id")
        .join(end("to"), "to_id")
        .select(*line.columns, "from_number", "from_name", "to_number", "to_name")
    )


def attach_dynamics(
    device: DataFrame, dyn: DataFrame, keys: Sequence[str] = ("bus", "machine_id")
) -> DataFrame:
    """One row per device and dynamic model; devices without a model keep one row with nulls."""
    return device.join(dyn, list(keys), "left")


def commitment_asof(
    on: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    ts: str,
    block: Column | None = None,
    status: str = "on",
    limits: tuple[str, str] | None = ("pmin", "pmax"),
) -> DataFrame:
    """Put the latest status at or before each stamp onto the finer grid.

    Works for irregular schedules. `limits` are grid columns to be multiplied by the status;
    they come back as `lower` and `upper`.
    """
    extra = [c for c in grid.columns if c not in (*keys, ts)]
    fine = grid.withColumn("__kind", F.lit(1)).withColumn(status, F.lit(None).cast(on.schema[status].dataType))
    coarse = on.select(*keys, ts, status).withColumn("__kind", F.lit(0))
    order = (epoch_micros(ts) * 2 + F.col("__kind")).alias("__order")
    both = coarse.unionByName(fine, allowMissingColumns=True).select("*", order)
    filled = carry_forward(both, keys, ["__order"], status, block, "__status").filter(F.col("__kind") == 1)
    flag = F.col("__status").cast("int")
    out = [F.col("__status").alias(status)]
    if limits:
        out += [(flag * F.col(limits[0])).alias("lower"), (flag * F.col(limits[1])).alias("upper")]
    return filled.select(*keys, ts, *extra, *out)


def commitment_on_grid(
    on: DataFrame, grid: DataFrame, keys: Sequence[str], ts: str, unit: str = "hour", status: str = "on"
) -> DataFrame:
    """The same for a regular schedule: one equi-join on the truncated stamp, no sort."""
    coarse = on.select(*keys, F.col(ts).alias("__start"), status)
    return grid.withColumn("__start", floor_time(ts, unit)).join(coarse, [*keys, "__start"], "left").drop("__start")


def flow_dual_long(duals: dict[str, DataFrame], ts: str = "ts", value: str = "value") -> DataFrame:
    """Long form of N dual frames: `(ts, line, value)`."""
    parts = [df.select(F.col(ts), F.lit(name).alias("line"), F.col(value).alias("value")) for name, df in duals.items()]
    return reduce(DataFrame.unionByName, parts)


def flow_dual_outer(duals: dict[str, DataFrame], ts: str = "ts", value: str = "value") -> DataFrame:
    """Full outer join of N dual frames on the stamp, one column per frame.

    Each frame has one row per stamp, so the outer join equals one aggregation of the union:
    one shuffle for any N in place of N - 1 joins.
    """
    long = flow_dual_long(duals, ts, value)
    return long.groupBy(ts).agg(
        *[F.max(F.when(F.col("line") == F.lit(name), F.col("value"))).alias(name) for name in duals]
    )


def rename_series_columns(long: DataFrame, names: DataFrame, series_id: str = "series_id") -> DataFrame:
    """Series ids to component names (`names(series_id, component_name)`); unknown ids keep theirs."""
    return (
        long.join(names, series_id, "left")
        .withColumn("component", F.coalesce(F.col("component_name"), F.col(series_id).cast("string")))
        .drop("component_name", series_id)
    )


def bus_name_to_number(rows: DataFrame, bus: DataFrame, name: str = "bus_name", number: str = "number") -> DataFrame:
    """Add the bus number to rows that carry a bus name."""
    return rows.join(bus.select(name, number), name, "inner")

