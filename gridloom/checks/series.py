"""Queries for time series, trajectories, sets, networks and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.checks.fixtures import Tables
from gridloom.checks.registry import doubles, query, rounded, without_name
from gridloom.functions.time import day_block
from gridloom.operators import aggregates as A
from gridloom.operators import network as N
from gridloom.operators import quality as Q
from gridloom.operators import series as S
from gridloom.operators import sets as X

KINDS = ["click", "error", "purchase", "signup", "view"]
HOUR, DAY, WEEK = 3600, 86400, 7


# ---- shape and grids ----


@query(
    "melt_series",
    " union all ".join(
        f"select l_shipdate as ts, '{c}' as component, {c} as value from lineitem" for c in ["l_quantity", "l_discount", "l_tax"]
    ),
)
def _(t: Tables) -> DataFrame:
    wide = t.lineitem.withColumnRenamed("l_shipdate", "ts")
    return S.melt_series(wide, "ts", ["l_quantity", "l_discount", "l_tax"])


@query(
    "pivot_series",
    "select ts, " + ", ".join(f"cast(sum(case when component = '{k}' then value end) as double) as {k}" for k in KINDS)
    + " from v_series group by ts",
)
def _(t: Tables) -> DataFrame:
    return doubles(S.pivot_series(t.v_series, KINDS), *KINDS)


@query(
    "regular_grid",
    """select ts, count(event_id) as n from (select unnest(generate_series((select date_trunc('hour', min(ts)) from events), (select date_trunc('hour', max(ts)) from events), interval 1 hour)) as ts) g
       left join (select event_id, date_trunc('hour', ts) as h from events) e on e.h = g.ts group by ts""",
)
def _(t: Tables) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    first, last = t.events.agg(F.min(hour), F.max(hour)).first()
    grid = S.regular_grid(t.spark, str(first), str(last), HOUR)
    events = t.events.groupBy(hour.alias("ts")).agg(F.count(F.lit(1)).alias("__n"))
    return grid.join(events, "ts", "left").select("ts", F.coalesce("__n", F.lit(0).cast("long")).alias("n"))


@query(
    "grid_per_series",
    """select component, unnest(generate_series(first_ts, last_ts, interval 15 minutes)) as ts
       from (select event_type as component, date_trunc('hour', min(ts)) as first_ts, date_trunc('hour', max(ts)) as last_ts from events group by event_type) b""",
)
def _(t: Tables) -> DataFrame:
    hourly = t.events.select(F.col("event_type").alias("component"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return S.grid_per_series(S.series_bounds(hourly, ["component"]), ["component"], "first_ts", "last_ts", 900)


@query(
    "constant_series",
    """select plant_id, unnest(generate_series(timestamp '2020-01-01 00:00:00', timestamp '2020-01-01 23:00:00', interval 1 hour)) as ts, c1 as value
       from v_gencost""",
)
def _(t: Tables) -> DataFrame:
    return S.constant_series(t.v_gencost, "2020-01-01 00:00:00", "2020-01-01 23:00:00", HOUR, "c1", ["plant_id"])


@query(
    "constant_cost_curve",
    """select plant_id, unnest(generate_series(timestamp '2020-01-01 00:00:00', timestamp '2020-01-01 05:00:00', interval 1 hour)) as ts,
         2 as points, pmin as first_mw, pmax as last_mw, pmax * 2 as last_cost from v_plant""",
)
def _(t: Tables) -> DataFrame:
    point = [
        F.struct(F.col("pmin").alias("mw"), (F.col("pmin") * 2).alias("cost")),
        F.struct(F.col("pmax").alias("mw"), (F.col("pmax") * 2).alias("cost")),
    ]
    units = t.v_plant.select("plant_id", F.array(*point).alias("curve"))
    out = S.constant_series(units, "2020-01-01 00:00:00", "2020-01-01 05:00:00", HOUR, "curve", ["plant_id"])
    first, last = F.col("value")[0], F.element_at("value", -1)
    return out.select(
        "plant_id", "ts", F.size("value").alias("points"), first["mw"].alias("first_mw"),
        last["mw"].alias("last_mw"), last["cost"].alias("last_cost"),
    )


# ---- scaling ----


@query(
    "normalize_series",
    """with f as (select component, case when component = 'error' then '250.0' when max(value) = 0 then '1.0' else 'Max' end as factor, max(value) as top from v_series group by component)
    select s.component, ts, cast(value as double) / nullif(case when factor = 'Max' then cast(top as double) else cast(factor as double) end, 0) as normalized
    from v_series s join f on f.component = s.component""",
)
def _(t: Tables) -> DataFrame:
    factors = A.series_max_factor(t.v_series, ["component"]).withColumn(
        "factor", F.when(F.col("component") == "error", F.lit("250.0")).otherwise(F.col("factor"))
    )
    return S.normalize_series(t.v_series, factors, ["component"]).select("component", "ts", "normalized")


@query(
    "scale_series",
    "select r.plant_id, ts, cast(value as double) * pmax as scaled from v_result_gen r join v_plant p on p.plant_id = r.plant_id",
)
def _(t: Tables) -> DataFrame:
    series = doubles(t.v_result_gen, "value")
    return S.scale_series(series, t.v_plant, "pmax", ["plant_id"]).select("plant_id", "ts", "scaled")


# ---- forecast windows ----


def windows(t: Tables, horizon: int, interval_s: int) -> DataFrame:
    return S.forecast_windows(t.v_series, ["component"], "ts", horizon, interval_s, HOUR)


_WINDOW_COLUMNS = "component, initial_time, step, ts, cast(value as double) as value"


@query("forecast_windows", f"select {_WINDOW_COLUMNS} from v_window_hour")
def _(t: Tables) -> DataFrame:
    return doubles(windows(t, 24, HOUR), "value")


@query("forecast_windows_daily", f"select {_WINDOW_COLUMNS} from v_window_day")
def _(t: Tables) -> DataFrame:
    return doubles(windows(t, 24, DAY), "value")


@query(
    "forecast_windows_from",
    f"""select {_WINDOW_COLUMNS} from v_window_hour
        where initial_time >= timestamp '2024-01-11 06:00:00' and initial_time <= timestamp '2024-01-20 00:00:00'""",
)
def _(t: Tables) -> DataFrame:
    out = S.forecast_windows(
        t.v_series, ["component"], "ts", 24, HOUR, HOUR, t.v_bounds, "2024-01-11 06:00:00", "2024-01-20 00:00:00"
    )
    return doubles(out, "value")


@query("forecast_initial_times", "select distinct initial_time from v_window_two_day")
def _(t: Tables) -> DataFrame:
    return S.forecast_initial_times(windows(t, 48, DAY))


@query("series_names", "select distinct user_id as component, event_type as name from events")
def _(t: Tables) -> DataFrame:
    store = t.events.select(F.col("user_id").alias("component"), F.col("event_type").alias("name"))
    return S.series_names(store)


@query(
    "series_array",
    "select step, ts, cast(value as double) as value from v_window_two_day where component = 'click' and initial_time = timestamp '2024-01-05 00:00:00'",
)
def _(t: Tables) -> DataFrame:
    return doubles(S.series_array(windows(t, 48, DAY), "click", "2024-01-05 00:00:00"), "value")


@query(
    "forecast_params",
    """with w as (select nullif(component, 'view') as component, initial_time, max(step) + 1 as points, min(ts) as a, max(ts) as b from v_window_two_day group by component, initial_time),
    g as (select *, date_diff('second', lag(initial_time) over (partition by component order by initial_time), initial_time) as gap from w)
    select component, min(initial_time) as initial_timestamp, cast(max(points) as bigint) as horizon, min(gap) as interval_s, count(*) as window_count,
      cast(min(date_diff('second', a, b) / (points - 1)) as bigint) as resolution_s from g group by component""",
)
def _(t: Tables) -> DataFrame:
    return S.forecast_params(without_name(windows(t, 48, DAY)), ["component"])


@query(
    "infer_resolution",
    """with s as (select 'hourly' as kind, nullif(component, 'view') as component, ts from v_series union all select 'five minutes', component, ts from v_series5
         union all select 'events', event_type, date_trunc('second', ts) from events),
    g as (select kind, component, date_diff('second', lag(ts) over (partition by kind, component order by ts), ts) as gap from s)
    select kind, component, min(gap) as resolution_s, count(distinct gap) as different_steps from g where gap is not null group by kind, component""",
)
def _(t: Tables) -> DataFrame:
    parts = {
        "hourly": without_name(t.v_series).select("component", "ts"),
        "five minutes": t.v_series5.select("component", "ts"),
        "events": t.events.select(F.col("event_type").alias("component"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts")),
    }
    return S.infer_resolution(S.overlay_series(parts, "kind"), ["kind", "component"], "ts", day_block("ts", WEEK))


@query(
    "attach_series",
    """select component, ts, cast(value as double) as value, 'static' as kind from v_series
       union all select component, ts, cast(value as double), 'static' from v_series5 where component in ('click', 'error')""",
)
def _(t: Tables) -> DataFrame:
    known = t.events.filter("event_type in ('click', 'error')").select(F.col("event_type").alias("component"))
    both = S.attach_series(t.v_series, t.v_series5.select("component", "ts", "value"), known)
    return doubles(both, "value").withColumn("kind", F.lit("static"))


@query(
    "remove_series",
    """select kind, entry, component, ts, initial_time, value from (
         select case when component <> 'view' then kind end as kind, entry, component, ts, initial_time, cast(value as double) as value from v_result) r
       where kind is null or kind <> 'dual'""",
)
def _(t: Tables) -> DataFrame:
    rows = S.remove_series(t.v_result.withColumn("kind", F.when(F.col("component") != "view", F.col("kind"))), "dual")
    return doubles(rows.select("kind", "entry", "component", "ts", "initial_time", "value"), "value")


_REALIZED = "ts >= initial_time and ts < initial_time + interval 24 hours"


@query("realized", f"select problem, entry, component, initial_time, ts, cast(value as double) as value from v_result where {_REALIZED}")
def _(t: Tables) -> DataFrame:
    rows = S.realized(t.v_result, DAY)
    return doubles(rows.select("problem", "entry", "component", "initial_time", "ts", "value"), "value")


@query("realized_timestamps", f"select distinct ts from v_result where {_REALIZED}")
def _(t: Tables) -> DataFrame:
    return S.realized_timestamps(t.v_result, DAY)


# ---- trajectories ----


@query("state_series", "select run, t, cast(value as double) as value from v_trajectory where entity = 3 and state = 'click'")
def _(t: Tables) -> DataFrame:
    return doubles(S.state_series(t.v_trajectory, 3, "click").select("run", "t", "value"), "value")


@query(
    "voltage_series",
    "select run, bus_id, bus_name, t, cast(value as double) as value from v_trajectory join v_bus on bus_id = entity where state = 'view'",
)
def _(t: Tables) -> DataFrame:
    rows = S.voltage_series(t.v_trajectory, t.v_bus.select("bus_id", "bus_name"), "view")
    return doubles(rows.select("run", "bus_id", "bus_name", "t", "value"), "value")


@query("overlay_series", "select 'run ' || run as label, entity, state, t, cast(value as double) as value from v_trajectory")
def _(t: Tables) -> DataFrame:
    runs = {f"run {r}": t.v_trajectory.filter(F.col("run") == r).drop("run") for r in ("A", "B")}
    return doubles(S.overlay_series(runs, "label").select("label", "entity", "state", "t", "value"), "value")


@query(
    "compare_runs",
    """with b as (select state, cast(floor(t / 600) as bigint) as bucket,
         cast(sum(value) filter (where run = 'A') as double) as sa, count(*) filter (where run = 'A') as na,
         cast(sum(value) filter (where run = 'B') as double) as sb, count(*) filter (where run = 'B') as nb
       from v_trajectory group by state, floor(t / 600))
    select state, max(abs(sa / na - sb / nb)) as max_abs_diff, count(*) as buckets from b where na > 0 and nb > 0 group by state""",
)
def _(t: Tables) -> DataFrame:
    a, b = (t.v_trajectory.filter(F.col("run") == r) for r in ("A", "B"))
    return S.compare_runs(a, b, 600.0, ["state"])


# ---- top-k and sets ----


@query(
    "latest_run",
    """select o_orderpriority as run_name, cast(max(o_orderkey) as varchar) as folder from orders group by o_orderpriority""",
)
def _(t: Tables) -> DataFrame:
    runs = t.orders.select(F.col("o_orderpriority").alias("run_name"), F.col("o_orderkey").cast("string").alias("folder"))
    return X.latest_run(runs)


@query("first_match", "select bus_id, bus_name, base_kv from v_bus where type = 3 order by bus_id limit 1")
def _(t: Tables) -> DataFrame:
    return X.first_match(t.v_bus, F.col("type") == 3, ["bus_id"]).select("bus_id", "bus_name", "base_kv")


@query(
    "concat_devices",
    """select p_name as name, p_size as size, cast(null as double) as balance from part
       union all select s_name, null, s_acctbal from supplier""",
)
def _(t: Tables) -> DataFrame:
    thermal = t.part.select(F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    renewable = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return X.concat_devices(thermal, renewable)


_GONE = "select o_custkey from orders where o_totalprice > 480000"


@query(
    "remove_components",
    f"""select 'Bus' as comp_type, c_name as name, cast(null as bigint) as attached from customer where c_custkey not in ({_GONE})
        union all select 'Bus', c_name, o_orderkey from orders join customer on c_custkey = o_custkey where c_custkey not in ({_GONE})""",
)
def _(t: Tables) -> DataFrame:
    named = t.customer.select("c_custkey", F.lit("Bus").alias("comp_type"), F.col("c_name").alias("name"))
    attached = t.orders.join(named, F.col("c_custkey") == F.col("o_custkey")).select("comp_type", "name", F.col("o_orderkey").alias("attached"))
    removed = named.join(t.orders.filter("o_totalprice > 480000"), F.col("c_custkey") == F.col("o_custkey")).select("comp_type", "name")
    kept, rest = X.remove_components(named.select("comp_type", "name"), removed, attached)
    return kept.unionByName(rest, allowMissingColumns=True)


@query(
    "convert_to_dynamic_branch",
    """select case when priority = '1-URGENT' then 'dynamic' else 'static' end as side, branch_id, r, x from v_branch""",
)
def _(t: Tables) -> DataFrame:
    line = t.v_branch.select("branch_id", "r", "x")
    names = t.v_branch.filter("priority = '1-URGENT'").select("branch_id")
    static, dynamic = X.convert_to_dynamic_branch(line, line.limit(0), names, "branch_id")
    return S.overlay_series({"static": static, "dynamic": dynamic}, "side")


# ---- network tables ----

_SHUNT = "select bus_id as i, bus_id as j, cast(0.0 as double) as re, base_kv / 1000 as im from v_bus"
_ENTRIES = """
    select {f} as i, {f} as j, g as re, y + b / 2 as im from n union all select {t}, {t}, g, y + b / 2 from n
    union all select {f}, {t}, -g, -y from n union all select {t}, {f}, -g, -y from n""".format(f="from_bus_id", t="to_bus_id")


def _admittance(where: str = "v_branch") -> str:
    return f"select *, r / nullif(r * r + x * x, 0) as g, -x / nullif(r * r + x * x, 0) as y from {where}"


def _two_sided(branch: DataFrame) -> DataFrame:
    return branch.withColumns({"b_from": F.col("b") / 2, "b_to": F.col("b") / 2})


@query(
    "ybus",
    f"""with n as ({_admittance()}) select i, j, round(sum(re), 6) as re, round(sum(im), 6) as im from ({_ENTRIES} union all {_SHUNT}) q group by i, j""",
)
def _(t: Tables) -> DataFrame:
    shunt = t.v_bus.select("bus_id", F.lit(0.0).alias("g"), (F.col("base_kv") / 1000).alias("b"))
    return rounded(N.ybus(_two_sided(t.v_branch), shunt), 6, "re", "im")


_FAULT = "(select * replace (case when priority = '1-URGENT' then r * 3 else r end as r, case when priority = '1-URGENT' then x * 3 else x end as x) from v_branch)"


@query(
    "ybus_fault_delta",
    f"""with n as ({_admittance()}), a as (select i, j, -re as re, -im as im from ({_ENTRIES}) q),
    m as ({_admittance(_FAULT)} f), b as ({_ENTRIES.replace('from n', 'from m')}),
    d as (select i, j, sum(re) as d_re, sum(im) as d_im from (select * from a union all select * from b) q group by i, j)
    select i, j, round(d_re, 6) as d_re, round(d_im, 6) as d_im from d where abs(d_re) > 1e-9 or abs(d_im) > 1e-9""",
)
def _(t: Tables) -> DataFrame:
    here = F.col("priority") == "1-URGENT"
    fault = t.v_branch.withColumns({c: F.when(here, F.col(c) * 3).otherwise(F.col(c)) for c in ("r", "x")})
    delta = N.ybus_fault_delta(N.ybus(_two_sided(t.v_branch)), N.ybus(_two_sided(fault)))
    return rounded(delta, 6, "d_re", "d_im")


@query(
    "ybus_lookup",
    f"""with n as ({_admittance()}) select i, j, round(sum(re), 6) as re, round(sum(im), 6) as im from ({_ENTRIES}) q where i = 42 and j = 42 group by i, j""",
)
def _(t: Tables) -> DataFrame:
    return rounded(N.ybus_lookup(N.ybus(_two_sided(t.v_branch)), 42, 42), 6, "re", "im")


@query("ptdf_lookup", "select line, bus_id, cast(factor as double) as factor from v_ptdf where line = 7 and bus_id in (select max(p_partkey) from part group by p_size)")
def _(t: Tables) -> DataFrame:
    buses = t.part.groupBy("p_size").agg(F.max("p_partkey").alias("number")).select(F.lit("largest").alias("bus_name"), "number")
    return doubles(N.ptdf_lookup(t.v_ptdf, 7, "largest", buses).select("line", "bus_id", "factor"), "factor")


_FLOW = """select ts, line, sum(factor * injection) as flow from v_injection i join v_ptdf p on p.bus_id = i.bus_id
           where factor <> 0 and injection <> 0 group by ts, line"""


def line_flow(t: Tables) -> DataFrame:
    return rounded(N.ptdf_flow(doubles(t.v_ptdf, "factor"), doubles(t.v_injection, "injection")), 6, "flow")


@query("ptdf_flow", f"select ts, line, round(cast(flow as double), 6) as flow from ({_FLOW}) q")
def _(t: Tables) -> DataFrame:
    return line_flow(t)


_DENSE = """(select ts, bus_id % 120 as bus_id, sum(injection) as injection from v_injection group by ts, bus_id % 120)"""


@query(
    "dense_flow",
    f"""select ts, line, round(cast(sum(factor * injection) as double), 6) as flow from {_DENSE} i join v_dense_ptdf p on p.bus_id = i.bus_id
        where factor <> 0 and injection <> 0 group by ts, line""",
)
def _(t: Tables) -> DataFrame:
    injection = t.v_injection.withColumn("bus_id", F.col("bus_id") % 120)
    return rounded(N.ptdf_flow(t.v_dense_ptdf, injection, tile=32), 6, "flow")


@query(
    "dense_congestion",
    """select ts, bus_id, round(cast(sum(mu * factor) as double), 6) as congestion
       from (select ts, line % 40 as line, sum(mu) as mu from v_flow_dual group by ts, line % 40) d join v_dense_ptdf p on p.line = d.line
       where mu <> 0 and factor <> 0 group by ts, bus_id""",
)
def _(t: Tables) -> DataFrame:
    dual = t.v_flow_dual.withColumn("line", F.col("line") % 40)
    return rounded(N.congestion_component(dual, t.v_dense_ptdf, tile=16), 6, "congestion")


@query(
    "lodf_from_ptdf",
    """with br as (select s_suppkey as line, s_suppkey as f, s_suppkey * 7 % (select max(p_partkey) from part) + 1 as t from supplier where s_nationkey = 3),
    e as (select line as outage, f as bus_id, 1 as sign from br union all select line, t, -1 from br),
    a as (select p.line, e.outage, cast(sum(e.sign * p.factor) as double) as h from e join v_ptdf p on p.bus_id = e.bus_id where factor <> 0 group by p.line, e.outage),
    h as (select * from a where h <> 0 or line = outage)
    select h.line, h.outage, case when h.line = h.outage then -1 else h.h / nullif(1 - coalesce(o.h, 0), 0) end as lodf
    from h left join h o on o.line = h.outage and o.outage = h.outage""",
)
def _(t: Tables) -> DataFrame:
    buses = t.part.agg(F.max("p_partkey")).scalar()
    named = t.supplier.filter("s_nationkey = 3").select(F.col("s_suppkey").alias("line"))
    ends = named.select("line", F.col("line").alias("from_bus_id"), (F.col("line") * 7 % buses + 1).alias("to_bus_id"))
    return N.lodf_from_ptdf(t.v_ptdf, ends)


_CONGESTION = """select ts, bus_id, round(cast(sum(mu * factor) as double), 6) as congestion from v_flow_dual d join v_ptdf p on p.line = d.line
                 where mu <> 0 and factor <> 0 group by ts, bus_id"""


@query("congestion_component", _CONGESTION)
def _(t: Tables) -> DataFrame:
    return rounded(N.congestion_component(doubles(t.v_flow_dual, "mu"), doubles(t.v_ptdf, "factor")), 6, "congestion")


@query(
    "lmp",
    f"""select p.ts, p.bus_id, cast(price as double) as price, coalesce(congestion, 0) as congestion, round(cast(price as double) + coalesce(congestion, 0), 6) as lmp
        from v_injection p left join v_energy_price e on e.ts = p.ts left join ({_CONGESTION}) c on c.ts = p.ts and c.bus_id = p.bus_id""",
)
def _(t: Tables) -> DataFrame:
    out = N.lmp(t.v_injection, doubles(t.v_energy_price, "price"), doubles(t.v_flow_dual, "mu"), doubles(t.v_ptdf, "factor"))
    return rounded(out, 6, "congestion", "lmp")


@query(
    "list_dual_names",
    "select distinct kind, entry, comp_type, entry || '__' || comp_type as name from v_result where kind = 'dual'",
)
def _(t: Tables) -> DataFrame:
    return N.list_names(t.v_result, "dual")


@query(
    "selective_flow_limits",
    f"""with l as (select s_suppkey as line, s_acctbal / 100 as rate from supplier where s_nationkey > 12)
        select f.ts, f.line, cast(flow as double) as flow, abs(cast(flow as double)) / nullif(rate, 0) as loading,
          case when abs(cast(flow as double)) > rate then 1 else 0 end as violates from ({_FLOW}) f join l on l.line = f.line""",
)
def _(t: Tables) -> DataFrame:
    lines = t.supplier.select(
        F.col("s_suppkey").alias("line"), (F.col("s_acctbal") / 100).alias("rate"),
        F.when(F.col("s_nationkey") > 12, F.lit("MonitoredLine")).otherwise(F.lit("Line")).alias("line_class"),
    )
    return N.selective_flow_limits(line_flow(t), lines).select("ts", "line", "flow", "loading", "violates")


# ---- checks and catalogue ----


@query("duplicate_names", "select comp_type, name, count(*) as n from v_component group by comp_type, name having count(*) > 1")
def _(t: Tables) -> DataFrame:
    return Q.duplicate_names(t.v_component)


@query(
    "range_violations",
    """select branch_id, field, value, min_value, max_value from (
         select branch_id, 'r' as field, r as value, cast(0.002 as double) as min_value, cast(0.049 as double) as max_value from v_branch
         union all select branch_id, 'rate', rate, null, cast(400 as double) from v_branch) q
       where value < min_value or value > max_value""",
)
def _(t: Tables) -> DataFrame:
    return Q.range_violations(t.v_branch, "branch_id", {"r": (0.002, 0.049), "rate": (None, 400.0)})


@query(
    "dangling_ends",
    """select branch_id, 'from' as "end", from_bus_id as bus_id from v_branch where from_bus_id not in (select bus_id from v_bus where type <> 4)
       union all select branch_id, 'to', to_bus_id from v_branch where to_bus_id not in (select bus_id from v_bus where type <> 4)""",
)
def _(t: Tables) -> DataFrame:
    return Q.dangling_ends(t.v_branch, t.v_bus.filter("type <> 4"))


@query(
    "approx_equal",
    """select a.plant_id, a.ts, cast(a.value as double) as a_value, cast(b.value as double) * (1 + cast(a.plant_id % 3 as double) / 1000) as b_value,
         coalesce(abs(cast(a.value as double) - cast(b.value as double) * (1 + cast(a.plant_id % 3 as double) / 1000)) <=
           0.0015 * greatest(abs(cast(a.value as double)), abs(cast(b.value as double) * (1 + cast(a.plant_id % 3 as double) / 1000))), false) as equal
       from v_result_gen a join v_result_gen b on a.plant_id = b.plant_id and a.ts = b.ts""",
)
def _(t: Tables) -> DataFrame:
    a = doubles(t.v_result_gen, "value")
    b = a.withColumn("value", F.col("value") * (1 + (F.col("plant_id") % 3).cast("double") / 1000))
    return Q.approx_equal(a, b, ["plant_id", "ts"], rtol=0.0015)


@query(
    "list_datasets",
    "select distinct 'source' as category, source as name from documents union all select distinct 'language', lang from documents",
)
def _(t: Tables) -> DataFrame:
    kinds = {"source": "source", "language": "lang"}
    parts = [t.documents.select(F.lit(kind).alias("category"), F.col(column).alias("name")).distinct() for kind, column in kinds.items()]
    return Q.list_datasets(parts[0].unionByName(parts[1]))


@query("dataset_counts", "select source as category, count(*) as n from documents group by source")
def _(t: Tables) -> DataFrame:
    return Q.dataset_counts(t.documents.select(F.col("doc_id").alias("name"), F.col("source").alias("category")))


@query("unknown_codes", "select type, count(*) as n from v_bus where type > 2 group by type")
def _(t: Tables) -> DataFrame:
    return Q.unknown_codes(t.v_bus, "type", [1, 2])


@query("list_names", "select distinct kind, entry, comp_type, entry || '__' || comp_type as name from v_result")
def _(t: Tables) -> DataFrame:
    return N.list_names(t.v_result)
