"""Projections and derived columns of the component tables. None of them shuffles except
`reclassify_lines`, which joins line ends to buses, and look-ups in tables that are given as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.electrical import device_to_system_base, sampled_cost, to_per_unit
from gridloom.functions.lookup import join_look_up, look_up
from gridloom.functions.time import iso_local, stamp, utc_text_to_local


def apply_descriptor(df: DataFrame, mapping: Sequence[tuple]) -> DataFrame:
    """Select and rename by `(source, canonical, ...)` rows; a source may feed several outputs."""
    return df.select(*[F.col(row[0]).alias(row[1]) for row in mapping])


def convert_units(
    df: DataFrame, units: Mapping[str, str], base_power: float, device_base: str | None = None
) -> DataFrame:
    """Bring columns to system per-unit and radians.

    `natural_units` divides by the system base, `device_base` rescales from the device base
    column (and leaves the value alone where the table has none), `degree` becomes radians.
    """
    rules = {
        "natural_units": lambda c: to_per_unit(c, base_power),
        "device_base": lambda c: device_to_system_base(c, F.col(device_base), base_power) if device_base else c,
        "degree": F.radians,
    }
    unknown = set(units.values()) - set(rules)
    if unknown:
        raise ValueError(f"unknown units: {sorted(unknown)}")
    return df.withColumns({name: rules[unit](F.col(name)) for name, unit in units.items()})


def map_generator_class(
    df: DataFrame,
    mapping: Sequence[tuple[str, str, str | None]] | DataFrame,
    fuel: str = "fuel",
    unit_type: str = "unit_type",
    out: str = "generator_class",
) -> DataFrame:
    """Class by (fuel, unit type); an exact pair wins over the fuel's row for any unit type.

    The mapping is a list of (class, fuel, unit type) or a table with the columns fuel, unit_type and class.
    """
    if isinstance(mapping, DataFrame):
        pairs = mapping.where(F.col("unit_type").isNotNull()).select("fuel", "unit_type", F.col("class").alias("__exact"))
        any_type = mapping.where(F.col("unit_type").isNull()).select("fuel", F.col("class").alias("__any"))
        both = join_look_up(df, [F.upper(fuel), F.upper(unit_type)], pairs, {"__exact": None})
        both = join_look_up(both, [F.upper(fuel)], any_type, {"__any": None})
        return both.withColumn(out, F.coalesce("__exact", "__any")).drop("__exact", "__any")
    exact = {f"{f}|{t}": cls for cls, f, t in mapping if t is not None}
    by_fuel = {f: cls for cls, f, t in mapping if t is None}
    pair = F.upper(F.concat_ws("|", fuel, unit_type))
    return df.withColumn(out, F.coalesce(look_up(pair, exact), look_up(F.upper(fuel), by_fuel)))


def const_columns(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def case_by_category(
    df: DataFrame, key: str, rules: Mapping[str, Mapping[str, Any]] | DataFrame, defaults: Mapping[str, Any]
) -> DataFrame:
    """One column per default, its value by category, the default elsewhere.

    Rules are nested mappings or a table with the category first and a column per default.
    """
    if isinstance(rules, DataFrame):
        return join_look_up(df, [F.col(key)], rules, defaults)
    added = {
        name: look_up(F.col(key), {cat: row[name] for cat, row in rules.items() if name in row}, default)
        for name, default in defaults.items()
    }
    return df.withColumns(added)


def repair_zero_pmin(
    df: DataFrame, fuels: Sequence[str], share: float, fuel: str = "type", pmin: str = "pmin", pmax: str = "pmax"
) -> DataFrame:
    """Give dispatchable units without a minimum a share of their maximum."""
    needs = F.col(fuel).isin(list(fuels)) & (F.col(pmin) <= 0)
    return df.withColumn(pmin, F.when(needs, F.col(pmax) * F.lit(share)).otherwise(F.col(pmin)))


def pwl_cost(
    df: DataFrame, pmin: str = "pmin", pmax: str = "pmax", c0: str = "c0", c1: str = "c1", c2: str = "c2", n: int = 2
) -> DataFrame:
    """Sample the cost curve at n + 1 points.

    Adds `output_point_0..n`, `heat_rate_avg_0` and `heat_rate_incr_1..n`; every increment is
    the cost minus the previous list element (not minus the previous cost). Pmax = 0 gives null.
    """
    low = F.try_divide(F.col(pmin), F.col(pmax))
    points = {f"output_point_{i}": low + F.lit(i) * ((F.lit(1.0) - low) / F.lit(n)) for i in range(n + 1)}
    out = df.withColumns(points)

    def cost(i: int) -> Column:
        return sampled_cost(F.col(f"output_point_{i}"), F.col(pmax), F.col(c0), F.col(c1), F.col(c2))

    out, before = out.withColumn("heat_rate_avg_0", cost(0)), "heat_rate_avg_0"
    for i in range(1, n + 1):  # each element from the column before it, so expressions stay short
        out = out.withColumn(f"heat_rate_incr_{i}", cost(i) - F.col(before))
        before = f"heat_rate_incr_{i}"
    return out


def prefix_name(df: DataFrame, prefix: str, id_col: str, out: str = "name") -> DataFrame:
    return df.withColumn(out, F.concat(F.lit(prefix), F.col(id_col).cast("string")))


def code_to_label(df: DataFrame, code: str, mapping: Mapping[int, str] | DataFrame, out: str) -> DataFrame:
    """Label of each code, null where it is unknown; a table has the code first and then the label."""
    if isinstance(mapping, DataFrame):
        return join_look_up(df, [F.col(code)], mapping.select(mapping.columns[0], F.col(mapping.columns[1]).alias(out)), {out: None})
    return df.withColumn(out, look_up(F.col(code), mapping))


def ratio_columns(df: DataFrame, num: str, den: str | float, out: str) -> DataFrame:
    """Quotient of two columns, or of a column and a number; null where the divisor is zero."""
    divisor = F.col(den) if isinstance(den, str) else F.lit(float(den))
    return df.withColumn(out, F.try_divide(F.col(num), divisor))


def scale_branch(
    df: DataFrame, name: str, factor: float, name_col: str = "name", r: str = "r", x: str = "x", b: str = "b"
) -> DataFrame:
    """On one named branch multiply r and x by `factor` and divide both halves of b by it."""
    here = F.col(name_col) == F.lit(name)
    k = F.lit(float(factor))
    shunt = F.struct((F.col(f"{b}.from") / k).alias("from"), (F.col(f"{b}.to") / k).alias("to"))
    return df.withColumns(
        {
            r: F.when(here, F.col(r) * k).otherwise(F.col(r)),
            x: F.when(here, F.col(x) * k).otherwise(F.col(x)),
            b: F.when(here, shunt).otherwise(F.struct(F.col(f"{b}.from").alias("from"), F.col(f"{b}.to").alias("to"))),
        }
    )


def reclassify_lines(
    line: DataFrame,
    bus: DataFrame,
    min_kv: float = 230.0,
    by_area: bool = False,
    bus_id: str = "bus_id",
    base_kv: str = "base_kv",
    area: str = "area",
    out: str = "line_class",
) -> DataFrame:
    """`MonitoredLine` where both ends reach `min_kv` (or, by area, where the ends differ)."""
    field = area if by_area else base_kv
    ends = bus.select(bus_id, F.col(field).alias("__end"))
    joined = line.join(
        ends.select(F.col(bus_id).alias("from_bus_id"), F.col("__end").alias("__from")), "from_bus_id", "left"
    ).join(ends.select(F.col(bus_id).alias("to_bus_id"), F.col("__end").alias("__to")), "to_bus_id", "left")
    if by_area:
        monitored = F.col("__from") != F.col("__to")
    else:
        monitored = (F.col("__from") >= F.lit(min_kv)) & (F.col("__to") >= F.lit(min_kv))
    return joined.withColumn(out, F.when(monitored, F.lit("MonitoredLine")).otherwise(F.lit("Line"))).select(
        *line.columns, out
    )


def field_accessors(components: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Named fields of typed components; a dotted name reads a nested field."""
    return components.select(*[F.col(f).alias(f.replace(".", "_")) for f in fields])


def append_components(components: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Append device rows; fields one side lacks become null."""
    return components.unionByName(new_rows, allowMissingColumns=True)


def utc_to_fixed_offset(
    df: DataFrame,
    text: str,
    fmt: str = "yyyy-MM-dd HH:mm:ss",
    offset: str = "-06:00",
    out: str = "datetime",
    initial_time: str | None = None,
) -> DataFrame:
    """UTC text to ISO local text at a fixed offset, dropping rows before the local initial time."""
    local = df.withColumn("__local", utc_text_to_local(text, fmt, offset))
    if initial_time is not None:
        local = local.filter(F.col("__local") >= stamp(initial_time))
    kept = [c for c in df.columns if c not in (text, out)]
    return local.select(iso_local("__local").alias(out), *kept)


def utc_column(columns: Sequence[str]) -> str:
    """The time column of a series table: the first header that contains `UTC`."""
    return next(c for c in columns if "UTC" in c)
