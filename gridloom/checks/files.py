"""Queries for readers, writers and end-to-end plans.

Files are written by Spark under the shared folder, in a new folder per run, and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.checks.fixtures import Tables
from gridloom.checks.registry import doubles, query, rounded
from gridloom.operators import aggregates as A
from gridloom.operators import series as S
from gridloom.plans.case_assembly import assemble_case, canonical_generators
from gridloom.plans.results import nodal_prices, realized_by_fuel
from gridloom.session import fresh_path, shuffle_width
from gridloom.sources import pointers as PT
from gridloom.sources import raw_cases as R
from gridloom.sources import system_json as SJ
from gridloom.sources.split_lines import stored
from gridloom.operators.quality import list_datasets
from gridloom.sources.results import read_realized, read_result, write_result
from gridloom.sources.store import dataset_catalog, materialize_once
from gridloom.sources.tables import scan_csv, sink_csv

DAY = 86400
KINDS = ["click", "error", "purchase", "signup", "view"]


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---- tables, pointers, results ----


@query("scan_csv", "select plant_id, bus_id, interconnect, type, pmax, pmin, ramp_30 from v_plant")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "plant")
    sink_csv(t.v_plant, path)
    schema = "plant_id long, bus_id long, interconnect string, type string, pmax double, pmin double, ramp_30 double"
    return scan_csv(t.spark, path, schema)


@query("sink_csv", "select branch_id, from_bus_id, to_bus_id, r, x, rate from v_branch")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "branch")
    sink_csv(t.v_branch.select("branch_id", "from_bus_id", "to_bus_id", "r", "x", "rate"), path, "errorifexists")
    return scan_csv(t.spark, path, "branch_id long, from_bus_id long, to_bus_id long, r double, x double, rate double")


@query(
    "build_ts_pointers",
    """select 'DA' as simulation, 'Generator' as category, 'case_store' as module, 'SingleTimeSeries' as type, 'gen' || cast(plant_id as varchar) as component_name,
         'max_active_power' as name, 3600 as resolution, 'get_max_active_power' as scaling_factor_multiplier, 'case_model' as scaling_factor_multiplier_module,
         case when max(value) = 0 then '1.0' else 'Max' end as normalization_factor, 'wind.csv' as data_file
       from v_result_gen where plant_id in (select plant_id from v_plant) group by plant_id
       union all select 'DA', 'Area', 'case_store', 'SingleTimeSeries', zone_name, 'max_active_power', 3600, 'get_max_active_power', 'case_model',
         cast(cast(sum(pd) as decimal(18,4)) as varchar), 'demand.csv'
       from v_bus b join v_zone z on z.zone_id = b.zone_id group by zone_name""",
)
def _(t: Tables) -> DataFrame:
    ids = t.v_result_gen.select(F.col("plant_id").alias("series_id"))
    names = t.v_plant.select(F.col("plant_id").alias("series_id"), F.concat(F.lit("gen"), text("plant_id")).alias("component_name"))
    factors = A.series_max_factor(t.v_result_gen, ["plant_id"]).withColumnRenamed("plant_id", "series_id")
    units = PT.build_ts_pointers(ids, names, factors, "Generator", "wind.csv", "case_store", "case_model")
    demand = A.zone_demand_total(t.v_bus).select(F.col("zone_id").alias("series_id"), F.col("total_pd").cast("decimal(18,4)").alias("factor"))
    zones = t.v_zone.select(F.col("zone_id").alias("series_id"), F.col("zone_name").alias("component_name"))
    areas = PT.build_ts_pointers(demand, zones, demand, "Area", "demand.csv", "case_store", "case_model")
    return units.unionByName(areas)


@query(
    "read_ts_pointers",
    """with f as (select component, case when max(value) = 0 then '1.0' else 'Max' end as factor from v_series group by component)
    select 'Generator' as category, s.component as component_name, 'max_active_power' as name, 3600 as resolution,
      factor as normalization_factor, 'DA' as simulation, 'SingleTimeSeries' as type, 'get_max_active_power' as scaling_factor_multiplier,
      ts, cast(value as double) as value from v_series s join f on f.component = s.component""",
)
def _(t: Tables) -> DataFrame:
    folder = pointer_files(t)
    # Series end at different stamps, so the wide file has empty cells; they come back as nulls.
    return PT.read_ts_pointers(t.spark, f"{folder}/pointers", f"{folder}/data").filter(F.col("value").isNotNull())


def pointer_files(t: Tables) -> str:
    folder = fresh_path(t.spark, "series")
    wide = S.pivot_series(t.v_series, KINDS).withColumnRenamed("ts", "DateTime")
    sink_csv(wide, f"{folder}/data/wind.csv")
    names = t.v_series.select(F.col("component").alias("series_id"), F.col("component").alias("component_name")).distinct()
    factors = A.series_max_factor(t.v_series, ["component"]).withColumnRenamed("component", "series_id")
    rows = PT.build_ts_pointers(names, names, factors, "Generator", f"{folder}/data/wind.csv", "case_store", "case_model")
    PT.write_ts_pointers(rows, f"{folder}/pointers")
    return folder


@query(
    "attach_pointer_series",
    """with f as (select component, cast(max(value) as double) as top from v_series group by component)
    select s.component as component_name, ts, cast(value as double) / nullif(case when top = 0 then 1.0 else top end, 0) * (20 + length(s.component)) as scaled
    from v_series s join f on f.component = s.component""",
)
def _(t: Tables) -> DataFrame:
    folder = pointer_files(t)
    series = PT.read_ts_pointers(t.spark, f"{folder}/pointers", f"{folder}/data").filter(F.col("value").isNotNull())
    fields = t.v_series.select(F.col("component").alias("component_name")).distinct()
    fields = fields.select("component_name", F.lit("max_active_power").alias("field"), (F.lit(20.0) + F.length("component_name")).alias("amount"))
    return PT.attach_pointer_series(series, fields).select("component_name", "ts", "scaled")


@query(
    "read_result",
    """select comp_type, component, initial_time, step, ts, cast(value as double) as value from v_result
       where problem = 'UC' and kind = 'variable' and entry = 'ActivePowerVariable'""",
)
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "result")
    write_result(t.v_result, path)
    rows = read_result(t.spark, path, "UC", "variable", "ActivePowerVariable")
    return doubles(rows.select("comp_type", "component", "initial_time", "step", "ts", "value"), "value")


@query(
    "read_realized",
    """select component, ts, cast(value as double) as value from v_result
       where problem = 'UC' and kind = 'variable' and entry = 'ActivePowerVariable' and step < 24
         and initial_time >= timestamp '2024-01-05 00:00:00' and initial_time < timestamp '2024-01-12 00:00:00'""",
)
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "result")
    write_result(t.v_result, path)
    rows = read_realized(t.spark, path, "UC", "variable", "ActivePowerVariable", DAY, "2024-01-05 00:00:00", 7)
    return doubles(rows.select("component", "ts", "value"), "value")


@query(
    "dataset_catalog",
    "select 'zones' as name, 'grid' as category union all select 'plants', 'grid' union all select 'events', 'series'",
)
def _(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "datasets")
    for name, category, df in (("zones", "grid", t.v_zone), ("plants", "grid", t.v_plant), ("events", "series", t.events.select("event_id"))):
        materialize_once(t.spark, name, lambda df=df: df, root, category=category)
    catalog = dataset_catalog(t.spark, root)
    return list_datasets(catalog, "grid").unionByName(list_datasets(catalog, "series")).select("name", "category")


@query(
    "materialize_once",
    """select 'demand' as dataset, zone_id, cast(sum(pd) as double) as total_pd from v_bus group by zone_id""",
)
def _(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "datasets")

    def build() -> DataFrame:
        return doubles(A.zone_demand_total(t.v_bus), "total_pd")

    materialize_once(t.spark, "demand", build, root, category="tests")
    again = materialize_once(t.spark, "demand", build, root, category="tests")
    return again.withColumn("dataset", F.lit("demand"))


# ---- serialised systems ----

# Fixed value: documents of small cases repeat their field names, so plain text takes more disk than all else that is kept.
_CODEC = "lz4"


def spread_branches(t: Tables) -> DataFrame:
    """Branch rows in as many partitions as a shuffle has, by case: each row grows to a whole document."""
    return t.v_branch.withColumn("case_id", text("branch_id")).repartition(shuffle_width(t.spark), "case_id")


def system_documents(t: Tables) -> DataFrame:
    """One small serialised system per branch: two buses, an arc, a line and a load."""

    def ref(kind: str, key: str) -> Column:
        return F.struct(F.concat(F.lit(kind), text(key)).alias("value"))

    def component(kind: str, uuid: Column, **fields: Column) -> Column:
        meta = F.struct(F.struct(F.lit(kind).alias("type")).alias("__metadata__"), F.struct(F.struct(uuid.alias("value")).alias("uuid")).alias("internal"))
        own = [value.alias(name) for name, value in fields.items()]
        return F.to_json(F.struct(meta["__metadata__"].alias("__metadata__"), meta["internal"].alias("internal"), *own))

    def bus(role: str) -> Column:
        key = f"{role}_bus_id"
        return component("Bus", F.concat(F.lit("bus"), text(key)), name=F.concat(F.lit("bus"), text(key)), number=F.col(key))

    arc = component("Arc", F.concat(F.lit("arc"), text("branch_id")), **{"from": ref("bus", "from_bus_id"), "to": ref("bus", "to_bus_id")})
    half = F.struct((F.col("b") / 2).alias("from"), (F.col("b") / 2).alias("to"))
    line = component(
        "Line", F.concat(F.lit("line"), text("branch_id")), name=F.concat(F.lit("branch"), text("branch_id")),
        r=F.col("r"), x=F.col("x"), b=half, rate=F.col("rate"), arc=ref("arc", "branch_id"),
    )
    load = component("PowerLoad", F.concat(F.lit("load"), text("branch_id")), name=F.concat(F.lit("load"), text("branch_id")), bus=ref("bus", "from_bus_id"), active_power=F.col("rate"))
    body = F.concat_ws(",", bus("from"), bus("to"), arc, line, load)
    document = F.concat(
        F.lit('{"data":{"components":['), body,
        F.lit(']},"frequency":60.0,"units_settings":{"base_value":100.0,"unit_system":"SYSTEM_BASE"}}'),
    )
    return spread_branches(t).select("case_id", document.alias("text"))


@query(
    "read_system_json",
    """select cast(branch_id as varchar) as case_id, 'branch' || cast(branch_id as varchar) as name, r, x, b / 2 as b_from, rate,
         'bus' || cast(from_bus_id as varchar) as from_name, to_bus_id as to_number from v_branch""",
)
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "systems")
    documents = system_documents(t)
    SJ.write_system_json(SJ.system_components(documents), SJ.system_settings(documents), path, compression=_CODEC)
    tables = SJ.read_system_json(t.spark, path, one_per_line=True)
    bus = stored(tables["Bus"].select("case_id", F.col("internal.uuid.value").alias("bus_uuid"), "name", "number"), "bus")
    arc = tables["Arc"].select("case_id", F.col("internal.uuid.value").alias("arc_uuid"), F.col("from.value").alias("f"), F.col("to.value").alias("t"))
    line = tables["Line"].select("case_id", "name", "r", "x", F.col("b.from").alias("b_from"), "rate", F.col("arc.value").alias("arc_uuid"))
    f = bus.select("case_id", F.col("bus_uuid").alias("f"), F.col("name").alias("from_name"))
    o = bus.select("case_id", F.col("bus_uuid").alias("t"), F.col("number").alias("to_number"))
    joined = line.join(arc, ["case_id", "arc_uuid"]).join(f, ["case_id", "f"]).join(o, ["case_id", "t"])
    return joined.select("case_id", "name", "r", "x", "b_from", "rate", "from_name", "to_number")


@query(
    "system_component_counts",
    """select 'Bus' as comp_type, 2 * count(*) as n from v_branch union all select 'Arc', count(*) from v_branch
       union all select 'Line', count(*) from v_branch union all select 'PowerLoad', count(*) from v_branch""",
)
def _(t: Tables) -> DataFrame:
    return A.component_counts(SJ.system_components(system_documents(t)))


@query(
    "write_system_json",
    """select cast(branch_id as varchar) as case_id, 100.0::double as base_power, 'SYSTEM_BASE' as unit_system, 60.0::double as frequency, 5 as n from v_branch""",
)
def _(t: Tables) -> DataFrame:
    documents = system_documents(t)
    path = fresh_path(t.spark, "systems")
    SJ.write_system_json(SJ.system_components(documents), SJ.system_settings(documents), path, compression=_CODEC)
    back = SJ.read_system_json(t.spark, path, one_per_line=True)
    return back["settings"].join(back["components"].groupBy("case_id").agg(F.count(F.lit(1)).alias("n")), "case_id")


@query(
    "write_component_folder",
    """select 'Bus' as comp_type, bus_id as id, bus_name as name, base_kv as value from v_bus
       union all select 'Source', s_suppkey, s_name, s_acctbal from supplier""",
)
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "system")
    bus = t.v_bus.select("bus_id", F.struct("bus_name", "base_kv").alias("fields"))
    source = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    SJ.write_component_folder({"Bus": bus, "Source": source}, path, force=True)
    a = SJ.read_component_folder(t.spark, path, "Bus", "bus_id long, fields struct<bus_name: string, base_kv: double>")
    b = SJ.read_component_folder(t.spark, path, "Source", "s_suppkey long, s_name string, s_acctbal double")
    return a.select(F.lit("Bus").alias("comp_type"), F.col("bus_id").alias("id"), F.col("fields.bus_name").alias("name"), F.col("fields.base_kv").alias("value")).unionByName(
        b.select(F.lit("Source").alias("comp_type"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("value"))
    )


# ---- raw grid files ----

_MARKS = ["BUS", "LOAD", "FIXED SHUNT", "GENERATOR", "BRANCH", "TRANSFORMER", "AREA", *["OTHER"] * 5, "ZONE", *["OTHER"] * 6]


# On a local disk a file and its checksum file take four calls of `chmod`, the file alone one, and cases are
# many small files. Other file systems have no such files.
_NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def _block(bus: str) -> Column:
    return F.floor(F.col(bus) / 1000).alias("block")


def raw_case_files(t: Tables) -> str:
    """A raw file per zone and block of bus numbers, named by both: its buses, loads, shunts, plants, lines and transformers.

    So the number of files grows with the table, and a file holds some dozens of buses. Branches of urgent orders are
    two-winding transformers, those of high ones three-winding; ends may lie in another case. The base power is
    50 plus the zone's number.
    """
    case = ["zone", "block"]
    place = t.v_bus.select(F.col("bus_id").alias("at"), F.col("zone_id").alias("zone"), _block("bus_id"))
    placed = lambda df, bus: df.join(place, F.col(bus) == F.col("at")).drop("at")
    line = lambda *parts: F.concat_ws(", ", *(F.lit(p) if isinstance(p, str) else p for p in parts))
    number = lambda c: F.col(c).cast("string")
    bus = t.v_bus.select("*", F.col("zone_id").alias("zone"), _block("bus_id")).withColumn("code", F.when(F.col("type") == 1, "2").when(F.col("type") == 2, "1").otherwise(number("type")))
    branch = placed(t.v_branch, "from_bus_id")
    kind = F.col("priority")
    two = F.concat_ws("\n", line(number("from_bus_id"), number("to_bus_id"), "0", F.concat(F.lit("'"), number("branch_id"), F.lit("'")), "1, 1, 1, 0, 0, 2, 'BANK  ', 1"), line(number("r"), number("x"), "100"), line("1.05, 0, 0", number("rate")), F.lit("1.0, 0"))
    three = F.concat_ws(
        "\n", line(number("from_bus_id"), number("to_bus_id"), "999999999", F.concat(F.lit("'"), number("branch_id"), F.lit("'")), "1, 1, 1, 0, 0, 2, 'STAR', 1"),
        line(number("r"), number("x"), "100", number("r"), number("x"), "100", number("r"), number("x"), "100, 1, 0"), F.lit("1.0, 0"), F.lit("1.0, 0"), F.lit("1.0, 0"),
    )
    zones = bus.select(*case).distinct().join(t.v_zone.select(F.col("zone_id").alias("zone"), "zone_name"), "zone")
    parts = [
        (0, bus.select(*case, F.col("bus_id").alias("id"), line(number("bus_id"), F.concat(F.lit("'"), F.col("bus_name"), F.lit("  '")), number("base_kv"), F.col("code"), "1", number("zone_id"), "1, 1.01", number("va"), "1.1, 0.9").alias("value"))),
        (1, bus.select(*case, F.col("bus_id").alias("id"), line(number("bus_id"), "'L1', 1, 1", number("zone_id"), number("pd"), number("qd"), "0, 0, 0, 0, 1").alias("value"))),
        (2, bus.where("type = 2").select(*case, F.col("bus_id").alias("id"), line(number("bus_id"), "'S', 1, 0.5", number("pd")).alias("value"))),
        (3, placed(t.v_plant, "bus_id").select(*case, F.col("plant_id").alias("id"), line(number("bus_id"), F.concat(F.lit("'"), number("plant_id"), F.lit("'")), "0, 0, 9, -9, 1, 0, 100, 0, 1, 0, 0, 1, 1, 100", number("pmax"), number("pmin")).alias("value"))),
        (4, branch.where(~kind.isin("1-URGENT", "2-HIGH")).select(*case, F.col("branch_id").alias("id"), line(number("from_bus_id"), number("to_bus_id"), F.concat(F.lit("'"), number("branch_id"), F.lit("'")), number("r"), number("x"), number("b"), number("rate"), "0, 0, 0, 0, 0, 0, 1").alias("value"))),
        (5, branch.where(kind == "1-URGENT").select(*case, F.col("branch_id").alias("id"), two.alias("value"))),
        (5, branch.where(kind == "2-HIGH").select(*case, F.col("branch_id").alias("id"), three.alias("value"))),
        (6, zones.select(*case, F.col("zone").alias("id"), F.lit("1, 0, 0, 10, 'AREA'").alias("value"))),
        (12, zones.select(*case, F.col("zone").alias("id"), line(number("zone"), F.concat(F.lit("'"), F.col("zone_name"), F.lit("'"))).alias("value"))),
    ]
    rows = [df.select(*case, F.lit(n).alias("section"), "id", "value") for n, df in parts]
    ends = zones.select(*case, F.posexplode(F.array(*(F.lit(f"0 / END OF {m} DATA") for m in _MARKS))).alias("section", "value"))
    rows.append(ends.select(*case, "section", F.lit(2**62).alias("id"), "value"))
    head = F.concat(F.lit("0, "), (F.col("zone") + 50).cast("string"), F.lit(", 33, 0, 1, 60.0 / case\ntitle\n"))
    rows.append(zones.select(*case, F.lit(-1).alias("section"), F.lit(0).cast("long").alias("id"), head.alias("value")))
    out = rows[0]
    for part in rows[1:]:
        out = out.unionByName(part)
    folder = fresh_path(t.spark, "raw-cases")
    out = out.repartition(*case).sortWithinPartitions(*case, "section", "id").select("value", *case)
    out.write.options(**_NO_CHECKSUM_FILES).partitionBy(*case).text(folder)
    return folder


def _case() -> list[Column]:
    return [F.regexp_extract("case_id", f"{name}=([0-9]+)", 1).cast("long").alias(out) for name, out in (("zone", "zone_id"), ("block", "block"))]


@query(
    "ingest_raw_cases",
    """with bus as (select *, bus_id // 1000 as block from v_bus), br as (select b.*, z.zone_id, z.block from v_branch b join bus z on z.bus_id = b.from_bus_id),
    zones as (select distinct b.zone_id, block, zone_name from bus b join v_zone z on z.zone_id = b.zone_id)
    select zone_id, block, 'bus' as section, bus_id as id, bus_name as label, base_kv as value, cast(va as double) as other from bus
    union all select zone_id, block, 'load', bus_id, 'L1', cast(pd as double), cast(qd as double) from bus
    union all select zone_id, block, 'fixed_shunt', bus_id, 'S', 0.5, cast(pd as double) from bus where type = 2
    union all select b.zone_id, block, 'generator', p.bus_id, cast(plant_id as varchar), pmax, pmin from v_plant p join bus b on b.bus_id = p.bus_id
    union all select zone_id, block, 'branch', from_bus_id, cast(branch_id as varchar), x, rate from br where priority not in ('1-URGENT', '2-HIGH')
    union all select zone_id, block, 'transformer', from_bus_id, cast(branch_id as varchar), x, case priority when '1-URGENT' then 1.05 else 1.0 end from br where priority in ('1-URGENT', '2-HIGH')
    union all select zone_id, block, 'area', 1, 'AREA', 0, 10 from zones
    union all select zone_id, block, 'zone', zone_id, zone_name, null, null from zones
    union all select zone_id, block, 'header', 33, '', zone_id + 50, 60 from zones""",
)
def _(t: Tables) -> DataFrame:
    s = R.ingest_raw_cases(t.spark, raw_case_files(t))
    columns = {
        "bus": ("bus_number", "bus_name", "base_kv", "va"), "load": ("bus_number", "load_id", "pl", "ql"), "fixed_shunt": ("bus_number", "shunt_id", "gl", "bl"),
        "generator": ("bus_number", "machine_id", "pt", "pb"), "branch": ("from_bus", "circuit", "x", "rate_a"), "transformer": ("from_bus", "circuit", "x12", "winding1"),
        "area": ("area", "area_name", "net_interchange", "tolerance"), "zone": ("zone", "zone_name", None, None), "header": ("revision", "", "base_mva", "frequency"),
    }
    pick = lambda c, kind: F.lit(None).cast(kind) if c is None else F.lit("") if c == "" else F.col(c).cast(kind)
    parts = [
        s[name].select(*_case(), F.lit(name).alias("section"), pick(i, "long").alias("id"), pick(label, "string").alias("label"), pick(v, "double").alias("value"), pick(o, "double").alias("other"))
        for name, (i, label, v, o) in columns.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "raw_to_components",
    """with bus as (select *, bus_id // 1000 as block from v_bus),
    br as (select b.*, f.zone_id, f.block, f.bus_name as fn, coalesce(o.bus_name, cast(b.to_bus_id as varchar)) as tn, f.zone_id + 50 as base
      from v_branch b join bus f on f.bus_id = b.from_bus_id left join bus o on o.bus_id = b.to_bus_id and o.zone_id = f.zone_id and o.block = f.block),
    ln as (select *, row_number() over (partition by zone_id, block order by branch_id) as k from br where priority not in ('1-URGENT', '2-HIGH'))
    select zone_id, block, 'Line' as kind, fn || '-' || tn || '-i_' || k as name, rate / base as value from ln
    union all select zone_id, block, 'TapTransformer', fn || '-' || tn || '-i_' || branch_id, 1.05 from br where priority = '1-URGENT'
    union all select zone_id, block, 'Transformer3W', fn || '-' || tn || '-999999999-i_' || branch_id, x / 2 from br where priority = '2-HIGH'
    union all select zone_id, block, 'FixedAdmittance', 'shunt-' || bus_id || '-S', cast(pd as double) / (zone_id + 50) from bus where type = 2
    union all select zone_id, block, 'PowerLoad', 'load' || bus_id || 'L1', cast(pd as double) / (zone_id + 50) from bus
    union all select b.zone_id, block, 'ThermalStandard', 'generator-' || p.bus_id || '-' || plant_id, sqrt((pmax / (zone_id + 50)) * (pmax / (zone_id + 50)) + (9 / cast(zone_id + 50 as double)) * (9 / cast(zone_id + 50 as double))) from v_plant p join bus b on b.bus_id = p.bus_id""",
)
def _(t: Tables) -> DataFrame:
    tables = R.raw_to_components(R.ingest_raw_cases(t.spark, raw_case_files(t)))
    value = {"Line": "rate", "TapTransformer": "tap", "Transformer3W": "primary.x", "FixedAdmittance": "b", "PowerLoad": "active_power", "ThermalStandard": "rating"}
    parts = [tables[kind].select(*_case(), F.lit(kind).alias("kind"), "name", F.col(c).alias("value")) for kind, c in value.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "ingest_dyr_cases",
    """select s_suppkey as bus, 'MACH A' as model, '1' as machine_id, 3 as n_params, s_acctbal as first_param from supplier
       union all select s_suppkey, 'EX', '2', 2, 400 from supplier""",
)
def _(t: Tables) -> DataFrame:
    record = F.concat(
        F.lit("      "), text("s_suppkey"), F.lit(" 'MACH A' '1 ', "), text("s_acctbal"), F.lit("      0.30000E-01\r\n     1.5      / remark 7\r\n"),
        text("s_suppkey"), F.lit(",'EX',2,400.00\r\n         0.20000E-01    /"),
    )
    folder = fresh_path(t.spark, "dyr-cases")
    t.supplier.select(record.alias("value")).write.option("maxRecordsPerFile", 500).text(folder)
    out = R.ingest_dyr_cases(t.spark, folder)
    return out.select("bus", "model", "machine_id", F.size("params").alias("n_params"), F.col("params")[0].alias("first_param"))


# ---- end-to-end plans ----

_RULES = """case type when 'wind' then 'Wind' when 'solar' then 'PV' when 'hydro' then 'HY' else 'OT' end"""


@query(
    "realized_by_fuel",
    f"""select ts, type || '/' || {_RULES} as fuel, cast(sum(value) as double) as total
        from (select plant_id, ts, value from v_result_gen) r join v_plant p on p.plant_id = r.plant_id
        where p.interconnect = 'ASIA' group by ts, type""",
)
def _(t: Tables) -> DataFrame:
    day = t.v_result_gen.withColumn("initial_time", F.col("ts"))
    ahead = day.withColumn("ts", F.expr("ts + interval 1 day"))
    return doubles(realized_by_fuel(day.unionByName(ahead), t.v_plant, DAY, "ASIA"), "total")


@query(
    "assemble_case",
    """with b as (select * from v_bus where interconnect = 'EUROPE' and type <> 4)
    select 'bus' as kind, 'bus' || cast(bus_id as varchar) as name, base_kv as value from b
    union all select 'branch', 'branch' || cast(br.branch_id as varchar), f.base_kv / nullif(o.base_kv, 0)
      from v_branch br left join b f on f.bus_id = br.from_bus_id left join b o on o.bus_id = br.to_bus_id where br.interconnect = 'EUROPE'
    union all select 'dcbranch', 'dcbranch' || cast(dcline_id as varchar), pmax from v_dcline
      where from_bus_id in (select bus_id from b) and to_bus_id in (select bus_id from b)
    union all select 'gen', 'gen' || cast(plant_id as varchar),
      case when type in ('ng', 'coal', 'hydro', 'nuclear') and pmin <= 0 then pmax * cast(0.05 as double) else pmin end
      from v_plant where interconnect = 'EUROPE'""",
)
def _(t: Tables) -> DataFrame:
    bus = t.v_bus.select("bus_id", "zone_id", "interconnect", "type", "base_kv")
    zone = t.v_zone.select("zone_id", "zone_name")
    case = assemble_case(t.v_plant, t.v_gencost, bus, zone, t.v_branch, t.v_dcline, "EUROPE")

    def rows(kind: str, df: DataFrame, value: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), "name", F.col(value).alias("value"))

    return (
        rows("bus", case.bus, "base_kv")
        .unionByName(rows("branch", case.branch, "tr_ratio"))
        .unionByName(rows("dcbranch", case.dc_branch, "pmax"))
        .unionByName(rows("gen", case.generator, "pmin"))
    )


@query(
    "canonical_generators",
    f"""select 'gen' || cast(p.plant_id as varchar) as name, upper(type) as fuel, {_RULES} as unit_type, pmax / 100 as active_power_limits_max,
          round(ramp_30 / 30 / 100, 9) as ramp_limits,
          case type when 'wind' then 'RenewableDispatch' when 'solar' then 'RenewableDispatch' when 'hydro' then 'HydroDispatch' else 'ThermalStandard' end as generator_class
        from v_plant p join v_gencost c on c.plant_id = p.plant_id""",
)
def _(t: Tables) -> DataFrame:
    from gridloom.plans.case_assembly import assemble_generators

    gen = assemble_generators(t.v_plant, t.v_gencost).withColumnsRenamed({"pmax": "Pmax", "pmin": "Pmin"})
    out = canonical_generators(gen).select("name", "fuel", "unit_type", "active_power_limits_max", "ramp_limits", "generator_class")
    return rounded(out, 9, "ramp_limits")


@query(
    "nodal_prices",
    """with c as (select ts, bus_id, cast(sum(mu * factor) as double) as congestion from v_flow_dual d join v_ptdf p on p.line = d.line where mu <> 0 and factor <> 0 group by ts, bus_id)
    select date_trunc('day', p.ts) as day, p.bus_id, count(*) as hours, round(max(cast(price as double) + coalesce(congestion, 0)), 6) as highest
    from v_injection p left join v_energy_price e on e.ts = p.ts left join c on c.ts = p.ts and c.bus_id = p.bus_id group by date_trunc('day', p.ts), p.bus_id""",
)
def _(t: Tables) -> DataFrame:
    prices = nodal_prices(t.v_injection, doubles(t.v_energy_price, "price"), doubles(t.v_flow_dual, "mu"), doubles(t.v_ptdf, "factor"))
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    return prices.groupBy(day, "bus_id").agg(F.count(F.lit(1)).alias("hours"), F.round(F.max("lmp"), 6).alias("highest"))


@query(
    "expression_vocabulary",
    """select o_orderkey, 'order' || cast(o_orderkey as varchar) as label, contains(o_orderpriority, 'HIGH') as is_high,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as iso, round(sqrt(o_totalprice), 6) as root, round(sin(o_totalprice), 6) as wave,
         cast(list_sum([x * x for x in range(1, 6) if x % 2 = 1]) as bigint) + o_orderkey as odd_squares,
         case o_orderstatus when 'F' then 'finished' when 'O' then 'open' end as status_name,
         '{"key":' || cast(o_orderkey as varchar) || '}' as json_text
       from orders""",
)
def _(t: Tables) -> DataFrame:
    odd = F.filter(F.sequence(F.lit(1), F.lit(5)), lambda x: x % 2 == 1)
    names = F.map_from_arrays(F.array(F.lit("F"), F.lit("O")), F.array(F.lit("finished"), F.lit("open")))
    pairs = F.arrays_zip(odd.alias("a"), odd.alias("b"))
    squares = F.aggregate(F.transform(pairs, lambda p: (p["a"] * p["b"]).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return t.orders.select(
        "o_orderkey",
        F.concat(F.lit("order"), text("o_orderkey")).alias("label"),
        F.contains("o_orderpriority", F.lit("HIGH")).alias("is_high"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.round(F.sqrt("o_totalprice"), 6).alias("root"),
        F.round(F.sin("o_totalprice"), 6).alias("wave"),
        (squares + F.col("o_orderkey")).alias("odd_squares"),
        F.try_element_at(names, F.col("o_orderstatus")).alias("status_name"),
        F.to_json(F.struct(F.col("o_orderkey").alias("key"))).alias("json_text"),
    )
