"""Queries for projections, filters and joins of component tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import fixed
from gridloom.checks.fixtures import HIERARCHY, Tables
from gridloom.checks.registry import doubles, query, rounded
from gridloom.functions.time import day_block
from gridloom.session import fresh_path
from gridloom.operators import columns as C
from gridloom.operators import filters as P
from gridloom.operators import joins as J

_EDGES = ", ".join(f"('{sub}', '{sup}')" for sub, sup in HIERARCHY)
_CLASSES = ", ".join(
    f"('{cls}', '{fuel}', {'null' if unit is None else repr(unit)})" for cls, fuel, unit in fixed.GENERATOR_CLASSES
)
_UNIT_CASES = """
    case type when 'wind' then 'Wind' when 'solar' then 'PV' when 'hydro' then 'HY' else 'OT' end as unit_type,
    cast(case type when 'ng' then 4.5 when 'coal' then 24 when 'nuclear' then 72 else 0 end as double) as min_up_time,
    cast(case type when 'ng' then 8 when 'coal' then 48 when 'nuclear' then 72 else 0 end as double) as min_down_time"""


def with_unit_rules(plant: DataFrame) -> DataFrame:
    return C.case_by_category(plant, "type", fixed.UNIT_RULES, fixed.UNIT_DEFAULTS)


# ---- projections ----


@query(
    "apply_descriptor",
    """select bus_id, bus_name as name, interconnect as zone, base_kv as base_voltage,
         cast(pd as double) as max_active_power, cast(qd as double) as max_reactive_power,
         cast(pd as double) as active_power, cast(qd as double) as reactive_power from v_bus""",
)
def _(t: Tables) -> DataFrame:
    source = doubles(t.v_bus, "pd", "qd").withColumnsRenamed(
        {"bus_name": "name", "base_kv": "baseKV", "pd": "Pd", "qd": "Qd"}
    )
    known = [row for row in fixed.DESCRIPTORS["bus"] if row[0] in source.columns]
    return C.apply_descriptor(source, known)


@query(
    "convert_units",
    """select bus_id, cast(pd as double) / 100 as pd, cast(qd as double) / 100 as qd,
         base_kv * cast(50 as double) / 100 as base_kv, round(radians(va), 9) as va from v_bus""",
)
def _(t: Tables) -> DataFrame:
    bus = doubles(t.v_bus, "pd", "qd").select("bus_id", "pd", "qd", "base_kv", "va", F.lit(50.0).alias("m_base"))
    units = {"pd": "natural_units", "qd": "natural_units", "base_kv": "device_base", "va": "degree"}
    return rounded(C.convert_units(bus, units, 100.0, "m_base").drop("m_base"), 9, "va")


@query(
    "map_generator_class",
    f"""with m(class, fuel, unit) as (values {_CLASSES}),
    p as (select plant_id, type as fuel, {_UNIT_CASES} from v_plant)
    select p.plant_id, p.fuel, p.unit_type, coalesce(e.class, a.class) as generator_class
    from p left join m e on e.fuel = upper(p.fuel) and e.unit = upper(p.unit_type)
    left join m a on a.fuel = upper(p.fuel) and a.unit is null""",
)
def _(t: Tables) -> DataFrame:
    plant = with_unit_rules(t.v_plant).select("plant_id", F.col("type").alias("fuel"), "unit_type")
    return C.map_generator_class(plant, fixed.GENERATOR_CLASSES)


@query("const_columns", "select dcline_id, pmax, cast(1000 as double) as fuel_price, 'Power' as control_mode from v_dcline")
def _(t: Tables) -> DataFrame:
    values = {"fuel_price": fixed.FUEL_PRICE, "control_mode": fixed.CONTROL_MODE}
    return C.const_columns(t.v_dcline.select("dcline_id", "pmax"), values)


@query("case_by_category", f"select plant_id, type, {_UNIT_CASES} from v_plant")
def _(t: Tables) -> DataFrame:
    return with_unit_rules(t.v_plant.select("plant_id", "type"))


@query(
    "repair_zero_pmin",
    """select plant_id, type, pmax,
         case when type in ('ng', 'coal', 'hydro', 'nuclear') and pmin <= 0 then pmax * cast(0.05 as double) else pmin end as pmin
       from v_plant""",
)
def _(t: Tables) -> DataFrame:
    plant = t.v_plant.select("plant_id", "type", "pmax", "pmin")
    return C.repair_zero_pmin(plant, fixed.DISPATCHABLE_FUELS, fixed.MIN_OUTPUT_SHARE)


@query(
    "pwl_cost",
    """with g as (select p.plant_id, pmin / nullif(pmax, 0) as low, pmax, c0, c1, c2 from v_plant p join v_gencost c on c.plant_id = p.plant_id),
    s as (select *, low as p0, low + (1 - low) / 2 as p1, low + 2 * ((1 - low) / 2) as p2 from g),
    k as (select *, p0 * pmax * (c1 + c2 * c2) + c0 as k0, p1 * pmax * (c1 + c2 * c2) + c0 as k1, p2 * pmax * (c1 + c2 * c2) + c0 as k2 from s)
    select plant_id, round(p0, 9) as output_point_0, round(p1, 9) as output_point_1, round(p2, 9) as output_point_2,
      round(k0, 6) as heat_rate_avg_0, round(k1 - k0, 6) as heat_rate_incr_1, round(k2 - (k1 - k0), 6) as heat_rate_incr_2 from k""",
)
def _(t: Tables) -> DataFrame:
    gen = J.join_gencost(t.v_plant.select("plant_id", "pmin", "pmax"), t.v_gencost.select("plant_id", "c0", "c1", "c2"))
    points = [f"output_point_{i}" for i in range(3)]
    rates = ["heat_rate_avg_0", "heat_rate_incr_1", "heat_rate_incr_2"]
    out = C.pwl_cost(gen).select("plant_id", *points, *rates)
    return rounded(rounded(out, 9, *points), 6, *rates)


@query("prefix_name", "select plant_id, 'gen' || cast(plant_id as varchar) as name from v_plant")
def _(t: Tables) -> DataFrame:
    return C.prefix_name(t.v_plant.select("plant_id"), "gen", "plant_id")


@query(
    "code_to_label",
    "select bus_id, type, case type when 1 then 'PV' when 2 then 'PQ' when 3 then 'REF' else 'ISOLATED' end as bustype from v_bus",
)
def _(t: Tables) -> DataFrame:
    return C.code_to_label(t.v_bus.select("bus_id", "type"), "type", fixed.BUS_TYPES, "bustype")


@query(
    "ratio_columns",
    """select b.branch_id, f.base_kv / nullif(o.base_kv, 0) as tr_ratio, b.rate / 30 as rate_per_min
       from v_branch b left join v_bus f on f.bus_id = b.from_bus_id left join v_bus o on o.bus_id = b.to_bus_id""",
)
def _(t: Tables) -> DataFrame:
    ends = J.join_branch_ends(t.v_branch.select("branch_id", "from_bus_id", "to_bus_id", "rate"), t.v_bus)
    both = C.ratio_columns(C.ratio_columns(ends, "from_base_kv", "to_base_kv", "tr_ratio"), "rate", 30, "rate_per_min")
    return both.select("branch_id", "tr_ratio", "rate_per_min")


@query(
    "scale_branch",
    """select 'branch' || cast(branch_id as varchar) as name, case when branch_id = 7 then r * 3 else r end as r,
         case when branch_id = 7 then x * 3 else x end as x,
         case when branch_id = 7 then b / 2 / 3 else b / 2 end as b_from, case when branch_id = 7 then b / 2 / 3 else b / 2 end as b_to
       from v_branch""",
)
def _(t: Tables) -> DataFrame:
    halves = F.struct((F.col("b") / 2).alias("from"), (F.col("b") / 2).alias("to")).alias("b")
    branch = C.prefix_name(t.v_branch, "branch", "branch_id").select("name", "r", "x", halves)
    return C.field_accessors(C.scale_branch(branch, "branch7", 3), ["name", "r", "x", "b.from", "b.to"])


@query(
    "reclassify_lines",
    """select b.branch_id, case when f.base_kv >= 230 and o.base_kv >= 230 then 'MonitoredLine' else 'Line' end as line_class
       from v_branch b left join v_bus f on f.bus_id = b.from_bus_id left join v_bus o on o.bus_id = b.to_bus_id""",
)
def _(t: Tables) -> DataFrame:
    line = t.v_branch.select("branch_id", "from_bus_id", "to_bus_id")
    return C.reclassify_lines(line, t.v_bus).select("branch_id", "line_class")


@query(
    "reclassify_lines_by_area",
    """select b.branch_id, case when f.area <> o.area then 'MonitoredLine' else 'Line' end as line_class
       from v_branch b left join v_bus f on f.bus_id = b.from_bus_id left join v_bus o on o.bus_id = b.to_bus_id""",
)
def _(t: Tables) -> DataFrame:
    line = t.v_branch.select("branch_id", "from_bus_id", "to_bus_id")
    return C.reclassify_lines(line, t.v_bus, by_area=True).select("branch_id", "line_class")


@query("field_accessors", "select bus_name, base_kv, cast(pd as double) as load_pd, cast(qd as double) as load_qd from v_bus")
def _(t: Tables) -> DataFrame:
    bus = doubles(t.v_bus, "pd", "qd").withColumn("load", F.struct("pd", "qd"))
    return C.field_accessors(bus, ["bus_name", "base_kv", "load.pd", "load.qd"])


@query(
    "append_components",
    """select plant_id, type, pmax, cast(null as double) as efficiency_in, cast(null as double) as efficiency_out from v_plant
       union all select s_suppkey, 'storage', s_acctbal, cast(0.9 as double), cast(0.8 as double) from supplier""",
)
def _(t: Tables) -> DataFrame:
    storage = t.supplier.select(
        F.col("s_suppkey").alias("plant_id"), F.lit("storage").alias("type"), F.col("s_acctbal").alias("pmax"),
        F.struct(F.lit(0.9).alias("in"), F.lit(0.8).alias("out")).alias("efficiency"),
    )
    both = C.append_components(t.v_plant.select("plant_id", "type", "pmax"), storage)
    return C.field_accessors(both, ["plant_id", "type", "pmax", "efficiency.in", "efficiency.out"])


@query(
    "utc_to_fixed_offset",
    """select event_id, strftime(date_trunc('second', ts) - interval 6 hours, '%Y-%m-%dT%H:%M:%S') as datetime
       from events where date_trunc('second', ts) - interval 6 hours >= timestamp '2024-01-01 00:00:00'""",
)
def _(t: Tables) -> DataFrame:
    text = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("UTC"))
    return C.utc_to_fixed_offset(text, C.utc_column(text.columns), initial_time="2024-01-01 00:00:00")


# ---- filters and look-ups ----


@query("filter_interconnect", "select bus_id, interconnect from v_bus where interconnect = 'ASIA'")
def _(t: Tables) -> DataFrame:
    return P.filter_interconnect(t.v_bus, "ASIA").select("bus_id", "interconnect")


@query("drop_isolated", "select bus_id, case type when 1 then 'PV' when 2 then 'PQ' else 'REF' end as bustype from v_bus where type <> 4")
def _(t: Tables) -> DataFrame:
    labelled = C.code_to_label(t.v_bus, "type", fixed.BUS_TYPES, "bustype")
    return P.drop_isolated(labelled).select("bus_id", "bustype")


@query(
    "type_closure",
    f"""with recursive h(sub_type, super_type) as (values {_EDGES}),
    walk(ancestor, descendant) as (
      select name, name from (select sub_type as name from h union select super_type from h) n
      union all select h.super_type, w.descendant from walk w join h on h.sub_type = w.ancestor),
    c as (select comp_type, count(*) as n from v_component group by comp_type)
    select ancestor, descendant, coalesce(n, 0) as n from (select distinct ancestor, descendant from walk) w left join c on c.comp_type = w.descendant""",
)
def _(t: Tables) -> DataFrame:
    closure = P.type_closure(t.spark, t.hierarchy)
    counts = t.v_component.groupBy(F.col("comp_type").alias("descendant")).agg(F.count(F.lit(1)).alias("n"))
    return closure.join(counts, "descendant", "left").select("ancestor", "descendant", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("components_of_type", "select comp_type, name from v_component where comp_type in ('ThermalStandard', 'Source')")
def _(t: Tables) -> DataFrame:
    closure = P.type_closure(t.spark, t.hierarchy)
    # the type as a stored column, as components have it; as a constant of each table it would turn the join into a loop
    path = fresh_path(t.spark, "components")
    t.v_component.write.parquet(path)
    return P.components_of_type(t.spark.read.parquet(path), closure, "Device").select("comp_type", "name")


@query("component_by_name", "select comp_type, name from v_component where comp_type = 'Bus' and name = 'Customer#000000042'")
def _(t: Tables) -> DataFrame:
    return P.component_by_name(t.v_component, "Bus", "Customer#000000042")


@query("from_initial_time", "select event_id, ts from events where ts >= timestamp '2024-01-10 06:00:00'")
def _(t: Tables) -> DataFrame:
    return P.from_initial_time(t.events.select("event_id", "ts"), "ts", "2024-01-10 06:00:00")


@query(
    "read_window",
    """select component, initial_time, step, ts, cast(value as double) as value
       from (select *, dense_rank() over (order by initial_time) as rk from v_result where initial_time >= timestamp '2024-01-03 12:00:00') q
       where rk <= 5""",
)
def _(t: Tables) -> DataFrame:
    rows = P.read_window(t.v_result, "2024-01-03 12:00:00", 5)
    return doubles(rows.select("component", "initial_time", "step", "ts", "value"), "value")


@query(
    "filter_entry_type",
    "select entry, component, initial_time, ts, cast(value as double) as value from v_result where entry in ('SystemBalanceSlackUp', 'SystemBalanceSlackDown')",
)
def _(t: Tables) -> DataFrame:
    rows = P.filter_entry_type(t.v_result, ["SystemBalanceSlackUp", "SystemBalanceSlackDown"])
    return doubles(rows.select("entry", "component", "initial_time", "ts", "value"), "value")


@query(
    "zoom_range",
    "select run, entity, state, t, cast(value as double) as value from v_trajectory where t > 86400 and t < 260000",
)
def _(t: Tables) -> DataFrame:
    return doubles(P.zoom_range(t.v_trajectory, 86400.0, 260000.0), "value")


@query("filter_resolution", "select component, ts, cast(value as double) as value from v_series")
def _(t: Tables) -> DataFrame:
    from gridloom.operators.series import infer_resolution, series_bounds
    from gridloom.operators.skew import blocked_join

    both = t.v_series.withColumn("kind", F.lit("hourly")).unionByName(
        t.v_series5.select("component", "ts", "value").withColumn("kind", F.lit("five minutes"))
    )
    steps = infer_resolution(both, ["kind", "component"], "ts", day_block("ts", 7))
    per_series = steps.select("kind", "component", "resolution_s").join(series_bounds(both, ["kind", "component"]), ["kind", "component"])
    tagged = blocked_join(both, per_series, ["kind", "component"], "ts")
    return doubles(P.filter_resolution(tagged, 3600).select("component", "ts", "value"), "value")


# ---- joins ----


@query(
    "join_gencost",
    """select p.plant_id, p.bus_id, p.interconnect, p.pmax, c.interconnect as interconnect_1, c.c0, c.c1, c.c2
       from v_plant p join v_gencost c on c.plant_id = p.plant_id""",
)
def _(t: Tables) -> DataFrame:
    return J.join_gencost(t.v_plant.select("plant_id", "bus_id", "interconnect", "pmax"), t.v_gencost)


@query(
    "join_zone",
    """select c_custkey as bus_id, c_nationkey as zone_id, zone_name from customer
       left join (select * from v_zone where interconnect <> 'ASIA') z on z.zone_id = c_nationkey""",
)
def _(t: Tables) -> DataFrame:
    bus = t.customer.select(F.col("c_custkey").alias("bus_id"), F.col("c_nationkey").alias("zone_id"))
    zone = t.v_zone.filter(F.col("interconnect") != "ASIA").select("zone_id", "zone_name")
    return J.join_zone(bus, zone).select("bus_id", "zone_id", "zone_name")


@query(
    "join_branch_ends",
    """select b.branch_id, b.from_bus_id, b.to_bus_id, f.base_kv as from_base_kv, o.base_kv as to_base_kv
       from v_branch b left join v_bus f on f.bus_id = b.from_bus_id left join v_bus o on o.bus_id = b.to_bus_id""",
)
def _(t: Tables) -> DataFrame:
    out = J.join_branch_ends(t.v_branch.select("branch_id", "from_bus_id", "to_bus_id"), t.v_bus)
    return out.select("branch_id", "from_bus_id", "to_bus_id", "from_base_kv", "to_base_kv")


@query(
    "dcline_semi",
    """select dcline_id, from_bus_id, to_bus_id, pmax from v_dcline
       where from_bus_id in (select bus_id from v_bus where interconnect = 'ASIA')
         and to_bus_id in (select bus_id from v_bus where interconnect = 'ASIA')""",
)
def _(t: Tables) -> DataFrame:
    out = J.dcline_semi(t.v_dcline, P.filter_interconnect(t.v_bus, "ASIA"))
    return out.select("dcline_id", "from_bus_id", "to_bus_id", "pmax")


@query(
    "resolve_arcs",
    """select 'branch' || cast(b.branch_id as varchar) as name, f.bus_id as from_number, f.bus_name as from_name,
         o.bus_id as to_number, o.bus_name as to_name
       from v_branch b join v_bus f on f.bus_id = b.from_bus_id join v_bus o on o.bus_id = b.to_bus_id""",
)
def _(t: Tables) -> DataFrame:
    def uuid(kind: str, c: str) -> F.Column:
        return F.md5(F.concat(F.lit(kind), F.col(c).cast("string")))

    bus = t.v_bus.select(uuid("bus", "bus_id").alias("bus_uuid"), F.col("bus_id").alias("number"), "bus_name")
    arc = t.v_branch.select(
        uuid("arc", "branch_id").alias("arc_id"), uuid("bus", "from_bus_id").alias("from_id"), uuid("bus", "to_bus_id").alias("to_id")
    )
    line = C.prefix_name(t.v_branch, "branch", "branch_id").select("name", uuid("arc", "branch_id").alias("arc_id"))
    return J.resolve_arcs(line, arc, bus).drop("arc_id")


@query(
    "attach_dynamics",
    """select p.plant_id, p.bus_id as bus, 1 as machine_id, d.model, d.inertia
       from v_plant p left join (select s_suppkey as bus, 'GENROU' as model, s_acctbal as inertia from supplier
         union all select s_suppkey, 'ESAC1A', s_acctbal / 2 from supplier) d on d.bus = p.bus_id""",
)
def _(t: Tables) -> DataFrame:
    device = t.v_plant.select("plant_id", F.col("bus_id").alias("bus"), F.lit(1).alias("machine_id"))
    machine = t.supplier.select(F.col("s_suppkey").alias("bus"), F.lit(1).alias("machine_id"), F.lit("GENROU").alias("model"), F.col("s_acctbal").alias("inertia"))
    exciter = machine.withColumns({"model": F.lit("ESAC1A"), "inertia": F.col("inertia") / 2})
    return J.attach_dynamics(device, machine.unionByName(exciter)).select("plant_id", "bus", "machine_id", "model", "inertia")


@query(
    "commitment_asof",
    """with k as (select component, ts, "on" from (select *, lag("on") over (partition by component order by ts) as before from v_commit) q
      where before is null or before <> "on")
    select g.component, g.ts, k."on", cast(k."on" * g.pmin as double) as lower, cast(k."on" * g.pmax as double) as upper
    from v_series5 g asof left join k on k.component = g.component and g.ts >= k.ts""",
)
def _(t: Tables) -> DataFrame:
    from gridloom.operators.ordered import previous_values

    moves = previous_values(t.v_commit, ["component"], ["ts"], {"before": "on"})
    changes = moves.filter(F.col("before").isNull() | (F.col("before") != F.col("on")))
    out = J.commitment_asof(changes, t.v_series5.drop("value"), ["component"], "ts")
    return doubles(out.select("component", "ts", "on", "lower", "upper"), "lower", "upper")


@query(
    "commitment_on_grid",
    """select g.component, g.ts, k."on" from v_series5 g left join v_commit k on k.component = g.component and k.ts = date_trunc('hour', g.ts)""",
)
def _(t: Tables) -> DataFrame:
    return J.commitment_on_grid(t.v_commit, t.v_series5, ["component"], "ts").select("component", "ts", "on")


@query(
    "flow_dual_outer",
    """select ts, cast(max(case when event_type = 'error' then value end) as double) as line_a,
         cast(max(case when event_type = 'purchase' then value end) as double) as line_b,
         cast(max(case when event_type = 'click' then value end) as double) as line_c,
         cast(max(case when event_type = 'signup' then value end) as double) as line_d,
         cast(max(case when event_type = 'view' then value end) as double) as line_e
       from events group by ts""",
)
def _(t: Tables) -> DataFrame:
    kinds = ["error", "purchase", "click", "signup", "view"]
    duals = {f"line_{'abcde'[i]}": t.events.filter(F.col("event_type") == kind).select("ts", "value") for i, kind in enumerate(kinds)}
    return J.flow_dual_outer(duals)


@query(
    "rename_series_columns",
    """select coalesce(s_name, cast(l_suppkey as varchar)) as component, l_shipdate as ts, l_quantity as value
       from lineitem left join (select s_suppkey, s_name from supplier where s_acctbal > 1000) s on s_suppkey = l_suppkey""",
)
def _(t: Tables) -> DataFrame:
    long = t.lineitem.select(F.col("l_suppkey").alias("series_id"), F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value"))
    names = t.supplier.filter("s_acctbal > 1000").select(F.col("s_suppkey").alias("series_id"), F.col("s_name").alias("component_name"))
    return J.rename_series_columns(long, names).select("component", "ts", "value")


@query("bus_name_to_number", "select branch_id, bus_id as number, bus_name from v_branch join v_bus on bus_id = from_bus_id")
def _(t: Tables) -> DataFrame:
    bus = t.v_bus.select("bus_name", F.col("bus_id").alias("number"))
    ends = t.v_branch.select("branch_id", F.concat(F.lit("Customer#"), F.lpad(F.col("from_bus_id").cast("string"), 9, "0")).alias("bus_name"))
    return J.bus_name_to_number(ends, bus).select("branch_id", "number", "bus_name")


