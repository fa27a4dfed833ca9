"""Queries for aggregations, windows and market tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom import fixed
from gridloom.checks.columns import with_unit_rules
from gridloom.checks.fixtures import Tables
from gridloom.checks.registry import doubles, query, rounded, without_name
from gridloom.functions.time import day_block
from gridloom.operators import aggregates as A
from gridloom.operators import market as M
from gridloom.operators import series as S

WEEK = 7
FUELS = ["wind", "solar", "hydro", "ng", "coal", "nuclear"]


def generator_table(t: Tables) -> DataFrame:
    return t.v_fuel


# ---- aggregations ----


@query("zone_demand_total", "select zone_id, cast(sum(pd) as double) as total_pd from v_bus group by zone_id")
def _(t: Tables) -> DataFrame:
    return doubles(A.zone_demand_total(t.v_bus), "total_pd")


@query(
    "series_max_factor",
    """select l_partkey as plant_id, case when max(l_discount) = 0 then '1.0' else 'Max' end as factor
       from lineitem group by l_partkey""",
)
def _(t: Tables) -> DataFrame:
    return A.series_max_factor(t.lineitem.withColumnRenamed("l_partkey", "plant_id"), ["plant_id"], "l_discount")


@query("distinct_names", "select distinct p_name from part")
def _(t: Tables) -> DataFrame:
    return A.distinct_names(t.part, "p_name")


@query("component_counts", "select comp_type, count(*) as n from v_component group by comp_type")
def _(t: Tables) -> DataFrame:
    return A.component_counts(t.v_component)


@query(
    "peak_by_zone",
    """select zone_name as load_zone, cast(sum(cast(o_totalprice as decimal(18,4))) as double) as peak_active_power,
         cast(sum(cast(o_totalprice / 4 as decimal(18,4))) as double) as peak_reactive_power
       from orders join customer on c_custkey = o_custkey join v_zone on zone_id = c_nationkey group by zone_name""",
)
def _(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    load = t.orders.select(
        F.col("o_custkey").alias("bus_id"),
        price.cast("decimal(18,4)").alias("max_active_power"),
        (price / 4).cast("decimal(18,4)").alias("max_reactive_power"),
    )
    bus = t.customer.join(t.v_zone, F.col("zone_id") == F.col("c_nationkey")).select(
        F.col("c_custkey").alias("bus_id"), F.col("zone_name").alias("load_zone")
    )
    return doubles(A.peak_by_zone(load, bus), "peak_active_power", "peak_reactive_power")


@query(
    "demand_by_area",
    """select date_trunc('hour', ts) as ts, area, cast(sum(cast(value as decimal(18,4))) as double) as demand
       from events join v_bus on bus_id = user_id group by date_trunc('hour', ts), area""",
)
def _(t: Tables) -> DataFrame:
    series = t.events.select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("load"), F.col("user_id").cast("string")).alias("component"),
        F.col("value").cast("decimal(18,4)").alias("value"),
    )
    load = t.v_bus.select(F.concat(F.lit("load"), F.col("bus_id").cast("string")).alias("component"), "bus_id")
    return doubles(A.demand_by_area(series, load, t.v_bus), "demand")


@query("demand_total", "select ts, cast(sum(value) as double) as demand from v_series5 group by ts")
def _(t: Tables) -> DataFrame:
    return doubles(A.demand_total(t.v_series5), "demand")


@query(
    "generation_by_variable",
    "select ts, entry, comp_type, cast(sum(value) as double) as total from v_result group by ts, entry, comp_type",
)
def _(t: Tables) -> DataFrame:
    return doubles(A.generation_by_variable(t.v_result), "total")


@query(
    "service_by_product",
    """select ts, s_nationkey as service, cast(sum(value) as double) as total
       from v_reserve join supplier on s_suppkey = component group by ts, s_nationkey""",
)
def _(t: Tables) -> DataFrame:
    services = t.supplier.select(F.col("s_suppkey").alias("component"), F.col("s_nationkey").alias("service"))
    return doubles(A.service_by_product(t.v_reserve, services), "total")


@query(
    "generation_by_fuel",
    "select ts, fuel, cast(sum(value) as double) as total from v_result_gen r join v_fuel p on p.plant_id = r.plant_id group by ts, fuel",
)
def _(t: Tables) -> DataFrame:
    return doubles(A.generation_by_fuel(t.v_result_gen, generator_table(t)), "total")


@query(
    "fuel_pivot",
    "select ts, "
    + ", ".join(f"cast(sum(case when fuel = '{f}' then value end) as double) as {f}" for f in FUELS)
    + " from v_result_gen r join v_fuel p on p.plant_id = r.plant_id group by ts",
)
def _(t: Tables) -> DataFrame:
    return doubles(A.fuel_pivot(A.generation_by_fuel(t.v_result_gen, generator_table(t)), FUELS), *FUELS)


@query("bar_totals", "select plant_id, cast(sum(value) * 24 as double) as energy from v_result_gen group by plant_id")
def _(t: Tables) -> DataFrame:
    return doubles(A.bar_totals(t.v_result_gen, 24, "plant_id"), "energy")


@query(
    "energy_limit",
    """select component, initial_time, cast(step // 6 as bigint) as period, cast(sum(value) as double) as energy_cap
       from v_window_two_day group by component, initial_time, step // 6""",
)
def _(t: Tables) -> DataFrame:
    return doubles(A.energy_limit(t.v_window_two_day, 6), "energy_cap")


@query(
    "energy_limit_breach",
    """with c as (select component, initial_time, step // 6 as period, sum(value) as energy_cap from v_window_two_day group by all),
    d as (select component, initial_time, step // 6 as period, sum(cast(value * 1.1 - 2 as decimal(18,4))) as energy from v_window_two_day group by all)
    select component, initial_time, cast(period as bigint) as period, cast(energy as double) as energy, cast(energy_cap as double) as energy_cap,
      cast(greatest(energy - energy_cap, 0) as double) as excess
    from d join c using (component, initial_time, period)""",
)
def _(t: Tables) -> DataFrame:
    used = t.v_window_two_day.withColumn("value", F.expr("cast(value * 1.1 - 2 as decimal(18,4))"))
    out = A.energy_limit_breach(used, A.energy_limit(t.v_window_two_day, 6), 6)
    return doubles(out, "energy", "energy_cap", "excess")


@query(
    "net_injection_by_bus",
    """with r as (select bus_id, value as v from v_result_gen r join v_plant p on p.plant_id = r.plant_id union all select bus_id, -cast(pd as double) from v_bus)
       select bus_id, round(sum(v), 4) as injection, 'bus' as level from r group by bus_id
       union all select null, round(sum(v), 4), 'balance' from r""",
)
def _(t: Tables) -> DataFrame:
    gen = t.v_result_gen.join(t.v_plant.select("plant_id", "bus_id"), "plant_id").select("bus_id", "value")
    load = t.v_bus.select("bus_id", F.col("pd").cast("double").alias("value"))
    return rounded(A.net_injection_by_bus(gen, load), 4, "injection")


@query(
    "net_load",
    """select ts, round(sum(v), 6) as net_load from (
         select ts, demand as v from v_market_demand
         union all select ts, -value from v_result_gen r join v_fuel p on p.plant_id = r.plant_id where fuel in ('hydro', 'wind', 'solar')) q
       group by ts""",
)
def _(t: Tables) -> DataFrame:
    renewable = generator_table(t).filter(F.col("fuel").isin("hydro", "wind", "solar"))
    fixed_output = t.v_result_gen.join(renewable.select("plant_id"), "plant_id").select("ts", "value")
    load = t.v_market_demand.select("ts", F.col("demand").alias("value"))
    return rounded(A.net_load(load, fixed_output), 6, "net_load")


# ---- ordered operations ----


@query(
    "stack_offsets",
    """select ts, fuel, cast(value as double) as value, cast(sum(value) over (partition by ts order by fuel) as double) as top
       from (select ts, fuel, sum(value) as value from v_result_gen r join v_fuel p on p.plant_id = r.plant_id group by ts, fuel) q""",
)
def _(t: Tables) -> DataFrame:
    by_fuel = A.generation_by_fuel(t.v_result_gen, generator_table(t))
    return doubles(M.stack_offsets(by_fuel.withColumnRenamed("total", "value"), category="fuel"), "value", "top")


@query(
    "initial_conditions",
    """select component, initial_time, cast(last_value as double) as last_value,
         cast(lag(last_value) over (partition by component order by initial_time) as double) as initial_value
       from (select nullif(component, 'view') as component, initial_time, arg_max(value, ts) as last_value from v_window_two_day
             where ts < initial_time + interval 24 hours group by component, initial_time) q""",
)
def _(t: Tables) -> DataFrame:
    rows = S.realized(without_name(t.v_window_two_day), 24 * 3600)
    out = M.initial_conditions(rows, ["component"])
    return doubles(out, "last_value", "initial_value")


@query(
    "commitment_transitions",
    """select component, ts, "on", case when "on" = 1 and before = 0 then 1 else 0 end as start,
         case when "on" = 0 and before = 1 then 1 else 0 end as stop
       from (select nullif(component, 'view') as component, ts, "on", lag("on") over (partition by component order by ts) as before from v_commit) q""",
)
def _(t: Tables) -> DataFrame:
    on = without_name(t.v_commit).select("component", "ts", "on")
    return M.commitment_transitions(on, ["component"], "ts")


@query(
    "commitment_runs",
    """with c as (select *, case when lag("on") over (partition by component order by ts) <> "on" then 1 else 0 end as changed from v_commit),
    n as (select *, sum(changed) over (partition by component order by ts) as run from c),
    r as (select component, cast(run as bigint) as run, "on", min(ts) as run_start, max(ts) as run_end, count(*) as steps from n group by component, run, "on"),
    l as (select component, max(run) as last_run from r group by component)
    select r.*, cast(steps as double) as hours,
      case when run > 0 and run < last_run and steps < case when "on" = 1 then 3.0 else 2.0 end then 1 else 0 end as violates
    from r join l on l.component = r.component""",
)
def _(t: Tables) -> DataFrame:
    on = t.v_commit.select("component", "ts", "on")
    limits = on.select("component").distinct().withColumns({"min_up_time": F.lit(3.0), "min_down_time": F.lit(2.0)})
    return M.commitment_runs(on, ["component"], "ts", day_block("ts", WEEK), 1.0, limits)


@query(
    "ramp_check",
    """with v as (select nullif(component, 'view') as component, ts, value from v_series),
    s as (select component, ts, value, lag(value) over (partition by component order by ts) as v0, lag(ts) over (partition by component order by ts) as t0 from v),
    l as (select component, cast(max(value) as double) / 300 as ramp_limit from v group by component)
    select s.component, ts, cast(abs(value - v0) as double) as step, date_diff('second', t0, ts) / cast(60 as double) as minutes, ramp_limit,
      case when cast(abs(value - v0) as double) > ramp_limit * (date_diff('second', t0, ts) / cast(60 as double)) then 1 else 0 end as violates
    from s join l on l.component = s.component where t0 is not null""",
)
def _(t: Tables) -> DataFrame:
    series = without_name(t.v_series)
    limits = series.groupBy("component").agg((F.max("value").cast("double") / 300).alias("ramp_limit"))
    values = doubles(series, "value")
    return rounded(M.ramp_check(doubles(values, "value"), limits, ["component"], "ts", day_block("ts", WEEK)), 4, "step")




_CUM = "sum(pmax) over (partition by ts order by price, plant_id rows unbounded preceding)"


@query(
    "merit_order_dispatch",
    f"""select o.ts, plant_id, cast(price as double) as price, cast(pmax as double) as pmax,
          cast(greatest(0, least(pmax, demand - (cum - pmax))) as double) as power
        from (select *, {_CUM} as cum from v_offer) o join v_market_demand d on d.ts = o.ts""",
)
def _(t: Tables) -> DataFrame:
    out = M.merit_order_dispatch(t.v_offer, t.v_market_demand, ["ts"], "plant_id")
    return doubles(out, "price", "pmax", "power")


@query(
    "unserved_demand",
    """select d.ts, cast(demand as double) as demand, cast(greatest(0, demand - coalesce(total, 0)) as double) as unserved
       from v_market_demand d left join (select ts, sum(pmax) as total from v_offer group by ts) o on o.ts = d.ts""",
)
def _(t: Tables) -> DataFrame:
    return doubles(M.unserved_demand(t.v_offer, t.v_market_demand, ["ts"]), "demand", "unserved")


@query(
    "clearing_price",
    f"""select d.ts, cast(demand as double) as demand, coalesce(cast(min(price) as double), 100000) as clearing_price
        from v_market_demand d left join (select *, {_CUM} as cum from v_offer) o on o.ts = d.ts and cum >= demand group by d.ts, demand""",
)
def _(t: Tables) -> DataFrame:
    out = M.clearing_price(t.v_offer, t.v_market_demand, ["ts"], "plant_id", fixed.UNSERVED_PENALTY)
    return doubles(out, "demand")


@query(
    "objective_value",
    """with d as (select o.ts, price, greatest(0, least(pmax, demand - (cum - pmax))) as power
         from (select *, sum(pmax) over (partition by ts order by price, plant_id, step rows unbounded preceding) as cum from v_bid_step) o
         join v_demand_units d on d.ts = o.ts),
       u as (select greatest(0, demand - coalesce(total, 0)) as unserved
         from v_demand_units d left join (select ts, sum(pmax) as total from v_bid_step group by ts) o on o.ts = d.ts)
       select cast((select sum(price * power) from d) as double) + cast(100000 * (select sum(unserved) from u) as double) as objective""",
)
def _(t: Tables) -> DataFrame:
    # whole numbers, as decimals: sums are exact in any order
    offer = t.v_bid_step.withColumn("unit", F.struct("plant_id", "step"))
    dispatch = M.merit_order_dispatch(offer, t.v_demand_units, ["ts"], "unit")
    unserved = M.unserved_demand(offer, t.v_demand_units, ["ts"])
    return A.objective_value(dispatch, unserved, int(fixed.UNSERVED_PENALTY))


@query(
    "bid_steps",
    """select ts, plant_id, 0 as step, cast(c1 as double) / nullif(p1, 0) as price, cast(p1 as double) as pmax from v_bid where p1 > 0
       union all select ts, plant_id, 1, cast(c2 - c1 as double) / nullif(p2 - p1, 0), cast(p2 - p1 as double) from v_bid where p2 > p1""",
)
def _(t: Tables) -> DataFrame:
    point = lambda cost, power: F.struct(F.col(cost).cast("double").alias("cost"), F.col(power).cast("double").alias("power"))
    bids = t.v_bid.select("ts", "plant_id", F.array(point("c1", "p1"), point("c2", "p2")).alias("points"))
    return M.bid_steps(bids, ["ts", "plant_id"])


@query(
    "min_up_time_rules",
    """select type, min(case type when 'ng' then 4.5 when 'coal' then 24 when 'nuclear' then 72 else 0 end)::double as min_up_time, count(*) as n from v_plant group by type""",
)
def _(t: Tables) -> DataFrame:
    return with_unit_rules(t.v_plant).groupBy("type").agg(F.min("min_up_time").alias("min_up_time"), F.count(F.lit(1)).alias("n"))
