"""Grid-shaped views over the test tables, as SQL text for Spark and for the oracle.

Every view is an aggregation, join or projection of whole tables. Views that need a grid of
stamps differ in the grid expression only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

PORTABLE = {
    "v_zone": """
        select n_nationkey as zone_id, n_name as zone_name, r_name as interconnect
        from nation join region on n_regionkey = r_regionkey""",
    "v_bus": """
        select c_custkey as bus_id, c_name as bus_name, zone_id, interconnect, cast(c_custkey % 4 + 1 as int) as type,
          cast(case c_custkey % 5 when 0 then 69 when 1 then 115 when 2 then 138 when 3 then 230 else 345 end as double) as base_kv,
          cast(abs(c_acctbal) as decimal(18,4)) as pd, cast(abs(c_acctbal) * cast(0.2 as double) as decimal(18,4)) as qd,
          cast(c_custkey % 360 as double) as va, c_mktsegment as area
        from customer join v_zone on c_nationkey = zone_id""",
    "v_plant0": """
        select *, p_partkey % (select count(*) from customer) as bus_key from part""",
    "v_plant": """
        select p_partkey as plant_id, b.bus_id, b.interconnect,
          case p_type when 'ECONOMY' then 'wind' when 'LARGE' then 'solar' when 'MEDIUM' then 'hydro'
            when 'PROMO' then 'ng' when 'SMALL' then 'coal' else 'nuclear' end as type,
          cast(case when p_partkey % 97 = 0 then 0 else p_size * 10 end as double) as pmax,
          cast(case when p_partkey % 7 = 0 then 0 else p_size * 2 end as double) as pmin, p_retailprice as ramp_30
        from v_plant0 p join v_bus b on b.bus_id = p.bus_key""",
    "v_fuel": """
        select p_partkey as plant_id,
          case p_type when 'ECONOMY' then 'wind' when 'LARGE' then 'solar' when 'MEDIUM' then 'hydro'
            when 'PROMO' then 'ng' when 'SMALL' then 'coal' else 'nuclear' end as fuel
        from part""",
    "v_gencost": """
        select p_partkey as plant_id, p_brand as interconnect, p_retailprice as c0,
          cast(case when p_partkey % 97 = 0 then 0 else p_size * 10 end as double) / cast(100 as double) as c1,
          cast(p_partkey % 10 as double) / cast(100 as double) as c2
        from part""",
    "v_branch0": """
        select o_orderkey as branch_id, o_custkey as from_bus_id, o_orderpriority as priority, o_totalprice,
          (o_custkey * 7 + o_orderkey % 11 + 1) % (select count(*) + 3 from customer) as to_bus_id
        from orders""",
    "v_branch": """
        select branch_id, from_bus_id, to_bus_id, interconnect,
          cast(branch_id % 50 + 1 as double) / cast(1000 as double) as r,
          cast(branch_id % 90 + 1 as double) / cast(100 as double) as x,
          cast(branch_id % 20 as double) / cast(1000 as double) as b,
          o_totalprice / cast(1000 as double) as rate, priority
        from v_branch0 join v_bus on from_bus_id = bus_id
        where from_bus_id <> to_bus_id""",
    "v_dcline": """
        select branch_id as dcline_id, from_bus_id, to_bus_id, rate as pmax from v_branch where priority = '1-URGENT'""",
    "v_ptdf": """
        select l_suppkey as line, l_partkey as bus_id,
          cast(sum(cast(l_discount as decimal(6,4)) - cast(0.05 as decimal(6,4))) as decimal(18,4)) as factor
        from lineitem group by l_suppkey, l_partkey""",
    "v_dense_ptdf": """
        select l_suppkey % 40 as line, l_partkey % 120 as bus_id, cast(sum(cast(l_discount as decimal(6,4)) - cast(0.05 as decimal(6,4))) as decimal(18,4)) as factor
        from lineitem group by l_suppkey % 40, l_partkey % 120""",
    "v_flow_dual": """
        select cast(date_trunc('hour', ts) as {ts}) as ts, user_id % (select max(s_suppkey) from supplier) + 1 as line,
          cast(sum(cast(value as decimal(8,4))) as decimal(18,4)) as mu
        from events group by cast(date_trunc('hour', ts) as {ts}), user_id % (select max(s_suppkey) from supplier) + 1""",
    "v_injection": """
        select cast(date_trunc('hour', ts) as {ts}) as ts, user_id % (select max(p_partkey) from part) + 1 as bus_id,
          cast(sum(cast(case when event_type = 'error' then -value else value end as decimal(8,4))) as decimal(18,4)) as injection
        from events group by cast(date_trunc('hour', ts) as {ts}), user_id % (select max(p_partkey) from part) + 1""",
    "v_energy_price": """
        select ts, cast(sum(mu) * cast(0.1 as decimal(5,4)) as decimal(18,4)) as price from v_flow_dual group by ts""",
    "v_result_gen": """
        select cast(date_trunc('day', l_shipdate) as {ts}) as ts, l_partkey as plant_id,
          sum(l_quantity) as value
        from lineitem group by cast(date_trunc('day', l_shipdate) as {ts}), l_partkey""",
    "v_offer": """
        select r.ts, r.plant_id, g.c1 * 10 + g.c2 as price, r.value as pmax
        from v_result_gen r join v_gencost g on g.plant_id = r.plant_id""",
    "v_market_demand": """
        select cast(date_trunc('day', o_orderdate) as {ts}) as ts,
          cast(cast(sum(cast(o_totalprice as decimal(18,4))) * cast(0.0005 as decimal(5,4)) as decimal(18,4)) as double) as demand
        from orders group by cast(date_trunc('day', o_orderdate) as {ts})""",
    "v_bid": """
        select ts, plant_id, cast(value as bigint) as p1, 2 * cast(value as bigint) + plant_id % 2 as p2,
          cast(value as bigint) * (10 + (plant_id + day(ts)) % 7) as c1,
          cast(value as bigint) * (10 + (plant_id + day(ts)) % 7) + (cast(value as bigint) + plant_id % 2) * (20 + plant_id % 5) as c2
        from v_result_gen""",
    "v_bid_step": """
        select ts, plant_id, 0 as step, cast(10 + (plant_id + day(ts)) % 7 as decimal(10,0)) as price, cast(p1 as decimal(12,0)) as pmax from v_bid
        union all select ts, plant_id, 1, cast(20 + plant_id % 5 as decimal(10,0)), cast(p2 - p1 as decimal(12,0)) from v_bid""",
    "v_demand_units": """
        select ts, cast(floor(demand) as decimal(18,0)) as demand from v_market_demand""",
    "v_component": """
        select 'Bus' as comp_type, c_name as name from customer
        union all select 'Source', s_name from supplier
        union all select 'ThermalStandard', p_name from part""",
    "v_typed": """
        select case p_type when 'ECONOMY' then 'Bus' when 'LARGE' then 'Source' when 'MEDIUM' then 'Area' else 'ThermalStandard' end as comp_type, p_name as name
        from part""",
    "v_reserve": """
        select cast(date_trunc('day', l_shipdate) as {ts}) as ts, l_suppkey as component, l_returnflag as product,
          cast(sum(cast(l_quantity as decimal(6,2)) * cast(l_tax as decimal(4,2))) as decimal(18,4)) as value
        from lineitem group by cast(date_trunc('day', l_shipdate) as {ts}), l_suppkey, l_returnflag""",
    "v_trajectory": """
        select case when user_id % 2 = 0 then 'A' else 'B' end as run, user_id % 10 as entity, event_type as state,
          {seconds} as t, cast(value as decimal(18,4)) as value
        from events""",
}

SPARK_ONLY = {
    "v_series": """
        select g.component, g.ts, coalesce(v.value, cast(0 as decimal(18,4))) as value
        from (select component, explode(sequence(lo, hi, interval 1 hour)) as ts
              from (select event_type as component, cast(date_trunc('day', min(ts)) as timestamp_ntz) as lo,
                      cast(date_trunc('hour', max(ts)) as timestamp_ntz) as hi from events group by event_type)) g
        left join (select event_type as component, cast(date_trunc('hour', ts) as timestamp_ntz) as ts,
                     cast(sum(cast(value as decimal(8,4))) as decimal(18,4)) as value
                   from events group by event_type, cast(date_trunc('hour', ts) as timestamp_ntz)) v
          on g.component = v.component and g.ts = v.ts""",
    "v_series5": """
        select component, ts, value, cast(value * 2 as decimal(18,4)) as pmax, cast(value * cast(0.25 as decimal(5,4)) as decimal(18,4)) as pmin
        from (select component, explode(sequence(ts, ts + interval 55 minutes, interval 5 minutes)) as ts, value from v_series)""",
}
DUCKDB_ONLY = {
    "v_series": """
        select g.component, g.ts, coalesce(v.value, cast(0 as decimal(18,4))) as value
        from (select component, unnest(generate_series(lo, hi, interval 1 hour)) as ts
              from (select event_type as component, cast(date_trunc('day', min(ts)) as timestamp) as lo,
                      date_trunc('hour', max(ts)) as hi from events group by event_type)) g
        left join (select event_type as component, date_trunc('hour', ts) as ts,
                     cast(sum(cast(value as decimal(8,4))) as decimal(18,4)) as value
                   from events group by event_type, date_trunc('hour', ts)) v
          on g.component = v.component and g.ts = v.ts""",
    "v_series5": """
        select component, ts, value, cast(value * 2 as decimal(18,4)) as pmax, cast(value * cast(0.25 as decimal(5,4)) as decimal(18,4)) as pmin
        from (select component, unnest(generate_series(ts, ts + interval 55 minutes, interval 5 minutes)) as ts, value from v_series)""",
}

# Views on top of the series, same text for both.
PORTABLE |= {
    "v_commit": """
        select component, ts, value, case when value >= avg_value then 1 else 0 end as "on"
        from (select s.component, s.ts, s.value, a.avg_value
              from v_series s join (select component, cast(sum(value) as double) / count(*) as avg_value
                                    from v_series group by component) a on a.component = s.component) q""",
    "v_bounds": """
        select component, min(ts) as first_ts, max(ts) as last_ts from v_series group by component""",
}
_SPARK_WINDOW = """
        select s.component, s.ts, s.value, w.initial_time, w.step
        from (select component, initial_time, explode(sequence(0, {h} - 1)) as step
              from (select component, explode(sequence(first_ts, last_ts - interval {span} hours, interval {i} hours)) as initial_time from v_bounds)) w
        join v_series s on s.component = w.component and s.ts = w.initial_time + make_dt_interval(0, w.step)"""
_DUCKDB_WINDOW = """
        select s.component, s.ts, s.value, w.initial_time, w.step
        from (select component, initial_time, cast(unnest(generate_series(0, {h} - 1)) as int) as step
              from (select component, unnest(generate_series(first_ts, last_ts - interval {span} hours, interval {i} hours)) as initial_time from v_bounds)) w
        join v_series s on s.component = w.component and s.ts = w.initial_time + to_hours(cast(w.step as int))"""
for _name, _h, _i in [("v_window_day", 24, 24), ("v_window_hour", 24, 1), ("v_window_two_day", 48, 24)]:
    SPARK_ONLY[_name] = _SPARK_WINDOW.format(h=_h, span=_h - 1, i=_i)
    DUCKDB_ONLY[_name] = _DUCKDB_WINDOW.format(h=_h, span=_h - 1, i=_i)
PORTABLE["v_result"] = """
        select case when component in ('click', 'view') then 'UC' else 'ED' end as problem,
          case when component = 'error' then 'dual' else 'variable' end as kind,
          case component when 'error' then 'CopperPlateBalanceConstraint' when 'click' then 'ActivePowerVariable'
            when 'view' then 'StopVariable' when 'signup' then 'SystemBalanceSlackDown' else 'SystemBalanceSlackUp' end as entry,
          case component when 'click' then 'ThermalStandard' when 'view' then 'HydroDispatch'
            when 'error' then 'System' else 'Bus' end as comp_type,
          component, initial_time, step, ts, value
        from v_window_two_day"""

# Constant and abstract component types used with `v_component` (links are domain knowledge).
HIERARCHY = [
    ("Topology", "Component"), ("Bus", "Topology"), ("Device", "Component"), ("Branch", "Device"),
    ("Line", "Branch"), ("Generator", "Device"), ("ThermalGen", "Generator"), ("ThermalStandard", "ThermalGen"),
    ("HydroGen", "Generator"), ("HydroDispatch", "HydroGen"), ("RenewableGen", "Generator"),
    ("RenewableDispatch", "RenewableGen"), ("StaticInjection", "Device"), ("Source", "StaticInjection"),
]

_DIALECT = {
    "spark": {
        "ts": "timestamp_ntz",
        "seconds": "(unix_date(cast(ts as date)) - 19723) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + cast(extract(second from ts) as double)",
    },
    "duckdb": {
        "ts": "timestamp",
        "seconds": "cast((cast(ts as date) - date '2024-01-01') * 86400 + hour(ts) * 3600 + minute(ts) * 60 as double) + cast(extract(microsecond from ts) as double) / 1000000",
    },
}
_NAME = re.compile(r"\bv_\w+\b")


def _text(name: str, dialect: str) -> str:
    own = SPARK_ONLY if dialect == "spark" else DUCKDB_ONLY
    text = own.get(name) or PORTABLE[name]
    text = text.replace("{ts}", _DIALECT[dialect]["ts"]).replace("{seconds}", _DIALECT[dialect]["seconds"])
    return text.replace('"on"', "`on`") if dialect == "spark" else text


def needed_views(text: str, dialect: str) -> list[str]:
    """Views a statement uses, dependencies first."""
    found: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(_NAME.findall(body)):
            if name not in found and (name in PORTABLE or name in SPARK_ONLY or name in DUCKDB_ONLY):
                visit(_text(name, dialect))
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def oracle_statement(body: str) -> str:
    """An oracle query with the views it uses as common table expressions in front."""
    views = needed_views(body, "duckdb")
    if not views:
        return body.strip()
    ctes = ",\n".join(f"{name} as ({_text(name, 'duckdb').strip()})" for name in views)
    body = body.strip()
    if body.lower().startswith("with recursive"):
        return f"with recursive {ctes},\n{body[len('with recursive'):].strip()}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:].strip()}"
    return f"with {ctes}\n{body}"


class Tables:
    """Test tables and views of one scale folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            if name in BASE_TABLES:
                self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in PORTABLE or name in SPARK_ONLY:
                self._known[name] = self._view(name)
            elif name == "hierarchy":
                rows = ", ".join(f"('{sub}', '{sup}')" for sub, sup in HIERARCHY)
                self._known[name] = self.spark.sql(f"select * from values {rows} as h(sub_type, super_type)")
            else:
                raise AttributeError(name)
        return self._known[name]

    def _view(self, name: str) -> DataFrame:
        text = _text(name, "spark")
        for used in [*needed_views(text, "spark"), *[t for t in BASE_TABLES if re.search(rf"\b{t}\b", text)]]:
            if used != name:
                getattr(self, used).createOrReplaceTempView(used)
        return self.spark.sql(text)
