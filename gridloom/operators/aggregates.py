"""Grouped totals of component tables, series and results.

All of them are one partial-then-final aggregation; look-up tables are joined to each other
first so that the large side is joined once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zone_demand_total(bus: DataFrame, zone: str = "zone_id", demand: str = "pd") -> DataFrame:
    """Total demand per zone: the normalisation factor of the zone's demand series."""
    return bus.groupBy(zone).agg(F.sum(demand).alias("total_pd"))


def series_max_factor(series: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Per series the factor text `1.0` where its maximum is zero, else `Max`."""
    return (
        series.groupBy(*keys)
        .agg(F.max(value).alias("__max"))
        .select(*keys, F.when(F.col("__max") == 0, F.lit("1.0")).otherwise(F.lit("Max")).alias("factor"))
    )


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def component_counts(components: DataFrame, by: str = "comp_type") -> DataFrame:
    return components.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def peak_by_zone(load: DataFrame, bus: DataFrame, zone: str = "load_zone", key: str = "bus_id") -> DataFrame:
    """Sum of the maximum active and reactive load of each load zone."""
    return (
        load.join(bus.select(key, zone), key)
        .groupBy(zone)
        .agg(
            F.sum("max_active_power").alias("peak_active_power"),
            F.sum("max_reactive_power").alias("peak_reactive_power"),
        )
    )


def demand_by_area(
    series: DataFrame, load: DataFrame, bus: DataFrame, level: str = "area", ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Demand per stamp and topology level: `load(component, bus_id)`, `bus(bus_id, level)`."""
    place = load.select("component", "bus_id").join(bus.select("bus_id", level), "bus_id").drop("bus_id")
    return series.join(place, "component").groupBy(ts, level).agg(F.sum(value).alias("demand"))


def demand_total(series: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    return series.groupBy(ts).agg(F.sum(value).alias("demand"))


def generation_by_variable(result: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    return result.groupBy(ts, "entry", "comp_type").agg(F.sum(value).alias("total"))


def service_by_product(result: DataFrame, services: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """Reserve provision per stamp and service: `services(component, service)`."""
    return result.join(services, "component").groupBy(ts, "service").agg(F.sum(value).alias("total"))


def generation_by_fuel(
    result: DataFrame,
    generator: DataFrame,
    key: str = "plant_id",
    fuel: str = "fuel",
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Output per stamp and fuel; needs the generator table for the fuel."""
    return result.join(generator.select(key, fuel), key).groupBy(ts, fuel).agg(F.sum(value).alias("total"))


def fuel_pivot(
    by_fuel: DataFrame, fuels: Sequence[str], ts: str = "ts", fuel: str = "fuel", value: str = "total"
) -> DataFrame:
    """Wide form with one column per listed fuel, so no pass is spent on finding the fuels."""
    return by_fuel.groupBy(ts).pivot(fuel, list(fuels)).agg(F.sum(value))


def bar_totals(result: DataFrame, hours: float, category: str = "component", value: str = "value") -> DataFrame:
    """One bar per category: energy over the horizon, with `hours` per step."""
    return result.groupBy(category).agg((F.sum(value) * F.lit(hours)).alias("energy"))


def energy_limit(
    upstream: DataFrame, n_periods: int, keys: Sequence[str] = ("component", "initial_time"), value: str = "value"
) -> DataFrame:
    """Upstream power summed over runs of `n_periods` steps: the cap of the downstream window."""
    period = F.floor(F.col("step") / F.lit(n_periods)).cast("long").alias("period")
    return upstream.groupBy(*keys, period).agg(F.sum(value).alias("energy_cap"))


def energy_limit_breach(
    downstream: DataFrame,
    limit: DataFrame,
    n_periods: int,
    keys: Sequence[str] = ("component", "initial_time"),
    value: str = "value",
) -> DataFrame:
    """Downstream energy per period against the cap, with the excess (0 where it holds)."""
    used = energy_limit(downstream, n_periods, keys, value).withColumnRenamed("energy_cap", "energy")
    excess = F.greatest(F.col("energy") - F.col("energy_cap"), F.lit(0).cast("decimal(1,0)"))
    return used.join(limit, [*keys, "period"]).withColumn("excess", excess)


def objective_value(
    dispatch: DataFrame, unserved: DataFrame, penalty: float, price: str = "price", power: str = "power", hours: float = 1.0
) -> DataFrame:
    """Total cost: price x power x hours of all dispatch rows plus the penalty on unserved demand.

    A dispatch row carries the price of its own interval, so prices may change from interval to interval and
    no join is needed. Power without a price costs nothing.
    """
    cost = dispatch.select((F.col(price) * F.col(power)).alias("__cost")).agg(F.sum("__cost").alias("__part"))
    short = unserved.agg((F.sum("unserved") * F.lit(penalty)).alias("__part"))
    parts = cost.select(F.col("__part").cast("double")).unionByName(short.select(F.col("__part").cast("double")))
    return parts.agg((F.sum("__part") * F.lit(hours)).alias("objective"))


def net_injection_by_bus(gen: DataFrame, load: DataFrame, bus: str = "bus_id", value: str = "value") -> DataFrame:
    """Generation minus load per bus (level `bus`), and one row for the whole balance (level `balance`).

    The balance is rolled up from the per-bus totals, so raw rows are not doubled; the level tells it from a
    bus that is null.
    """
    signed = gen.select(bus, F.col(value).alias("__v")).unionByName(load.select(bus, (-F.col(value)).alias("__v")))
    per_bus = signed.groupBy(bus).agg(F.sum("__v").alias("__v"))
    level = F.when(F.grouping(bus) == 1, F.lit("balance")).otherwise(F.lit("bus"))
    return per_bus.rollup(bus).agg(F.sum("__v").alias("injection"), level.alias("level"))


def net_load(load: DataFrame, fixed: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """Load minus fixed-output generation per stamp."""
    rows = load.select(ts, F.col(value).alias("__v")).unionByName(fixed.select(ts, (-F.col(value)).alias("__v")))
    return rows.groupBy(ts).agg(F.sum("__v").alias("net_load"))
