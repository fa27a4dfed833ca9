from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom import fixed
from gridloom.operators import columns as C
from gridloom.operators import filters as P
from gridloom.operators import joins as J


def test_pwl_cost_by_hand(spark):
    gen = spark.createDataFrame([(1, 20.0, 100.0, 5.0, 2.0, 3.0)], "plant_id int, pmin double, pmax double, c0 double, c1 double, c2 double")
    row = C.pwl_cost(gen).first()

    def cost(share):
        return share * 100.0 * (2.0 + 3.0**2) + 5.0

    assert [row.output_point_0, row.output_point_1, row.output_point_2] == pytest.approx([0.2, 0.6, 1.0])
    first = cost(0.2)
    second = cost(0.6) - first
    assert row.heat_rate_avg_0 == pytest.approx(first)
    assert row.heat_rate_incr_1 == pytest.approx(second)
    assert row.heat_rate_incr_2 == pytest.approx(cost(1.0) - second)


def test_pwl_cost_without_capacity_is_null(spark):
    gen = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0, 1.0)], "pmin double, pmax double, c0 double, c1 double, c2 double")
    assert C.pwl_cost(gen, n=4).select("output_point_4", "heat_rate_incr_4").first() == (None, None)


@pytest.mark.parametrize(
    ("fuel", "unit", "want"),
    [
        ("hydro", "HY", "HydroDispatch"), ("hydro", "INFLOW", "HydroEnergyReservoir"), ("solar", "RTPV", "RenewableFix"),
        ("solar", "PV", "RenewableDispatch"), ("wind", "Wind", "RenewableDispatch"), ("ng", "OT", "ThermalStandard"),
        ("nuclear", None, "ThermalStandard"), ("other", "OT", "ThermalStandard"), ("other", "XX", None), ("peat", "OT", None),
    ],
)
def test_generator_class(spark, fuel, unit, want):
    df = spark.createDataFrame([(fuel, unit)], "fuel string, unit_type string")
    assert C.map_generator_class(df, fixed.GENERATOR_CLASSES).first().generator_class == want


def test_unit_rules_and_minimum_output(spark):
    plants = [("wind", 0.0), ("ng", 0.0), ("coal", 5.0), ("nuclear", -1.0), ("oil", 0.0)]
    df = spark.createDataFrame([(t, p, 100.0) for t, p in plants], "type string, pmin double, pmax double")
    out = C.repair_zero_pmin(C.case_by_category(df, "type", fixed.UNIT_RULES, fixed.UNIT_DEFAULTS), fixed.DISPATCHABLE_FUELS, fixed.MIN_OUTPUT_SHARE)
    got = {r.type: (r.unit_type, r.min_up_time, r.min_down_time, r.pmin) for r in out.collect()}
    assert got == {
        "wind": ("Wind", 0.0, 0.0, 0.0), "ng": ("OT", 4.5, 8.0, 5.0), "coal": ("OT", 24.0, 48.0, 5.0),
        "nuclear": ("OT", 72.0, 72.0, 5.0), "oil": ("OT", 0.0, 0.0, 0.0),
    }


def test_scale_branch_touches_one_line(spark):
    df = spark.sql("select 'A-B' as name, 0.01D as r, 0.12D as x, named_struct('from', 0.3D, 'to', 0.3D) as b union all select 'A-C', 0.02D, 0.9D, named_struct('from', 0.5D, 'to', 0.5D)")
    got = {r.name: (r.r, r.x, r.b["from"], r.b.to) for r in C.scale_branch(df, "A-B", 3).collect()}
    assert got["A-B"] == pytest.approx((0.03, 0.36, 0.1, 0.1))
    assert got["A-C"] == (0.02, 0.9, 0.5, 0.5)


def test_utc_shift_drops_the_hours_before_the_local_start(spark):
    df = spark.createDataFrame([("2016-01-01 05:00:00", 1), ("2016-01-01 06:00:00", 2), ("2016-07-01 06:30:00", 3)], "`time UTC` string, v int")
    name = C.utc_column(df.columns)
    assert [tuple(r) for r in C.utc_to_fixed_offset(df, name).orderBy("v").collect()] == [
        ("2015-12-31T23:00:00", 1), ("2016-01-01T00:00:00", 2), ("2016-07-01T00:30:00", 3),
    ]
    kept = C.utc_to_fixed_offset(df, name, initial_time="2016-01-01 00:00:00")
    assert [r.v for r in kept.orderBy("v").collect()] == [2, 3]


def test_utc_shift_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2016-03-13 02:30:00",)], "`UTC` string")
        assert C.utc_to_fixed_offset(df, "UTC").first().datetime == "2016-03-12T20:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_unit_is_refused(spark):
    with pytest.raises(ValueError):
        C.convert_units(spark.range(1), {"id": "furlong"}, 100.0)


def test_join_keeps_duplicates_and_suffixes(spark):
    gen = spark.createDataFrame([(1, "a"), (1, "b")], "plant_id int, tag string")
    cost = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "plant_id int, tag string")
    out = J.join_gencost(gen, cost)
    assert out.columns == ["plant_id", "tag", "tag_1"] and out.count() == 4


def test_branch_end_without_bus_stays(spark):
    bus = spark.createDataFrame([(1, 230.0)], "bus_id int, base_kv double")
    branch = spark.createDataFrame([(10, 1, 9)], "branch_id int, from_bus_id int, to_bus_id int")
    row = C.ratio_columns(J.join_branch_ends(branch, bus), "from_base_kv", "to_base_kv", "tr_ratio").first()
    assert (row.from_base_kv, row.to_base_kv, row.tr_ratio) == (230.0, None, None)


def test_commitment_asof_with_gaps(spark):
    on = spark.sql("select 'g' as unit, timestamp_ntz'2024-01-01 01:00:00' as ts, 1 as on union all select 'g', timestamp_ntz'2024-03-01 00:00:00', 0")
    grid = spark.sql(
        "select 'g' as unit, t as ts, 2.0D as pmin, 9.0D as pmax from (select explode(array(timestamp_ntz'2024-01-01 00:55:00', timestamp_ntz'2024-01-01 01:00:00', timestamp_ntz'2024-02-10 00:00:00', timestamp_ntz'2024-03-01 00:05:00')) as t)"
    )
    from gridloom.functions.time import day_block

    out = J.commitment_asof(on, grid, ["unit"], "ts", day_block("ts", 3)).orderBy("ts").collect()
    assert [(r.on, r.lower, r.upper) for r in out] == [(None, None, None), (1, 2.0, 9.0), (1, 2.0, 9.0), (0, 0.0, 0.0)]


def test_type_closure_walks_all_levels(spark):
    tree = spark.sql("select * from values ('Line','Branch'),('Branch','Device'),('Device','Component'),('Bus','Component') as h(sub_type, super_type)")
    got = {(r.ancestor, r.descendant) for r in P.type_closure(spark, tree).collect()}
    assert ("Component", "Line") in got and ("Device", "Line") in got and ("Line", "Line") in got
    assert ("Device", "Bus") not in got
    assert len(got) == 5 + 3 + 2 + 2


def test_filters_reach_the_scan(spark, plan):
    bus = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    text = plan(P.filter_interconnect(bus, "BUILDING", "c_mktsegment").select("c_custkey"))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text


def test_projection_chain_is_one_stage(spark, plan):
    from gridloom.plans.case_assembly import assemble_generators

    plant = spark.createDataFrame([(1, "Texas", "ng", 0.0, 50.0, 30.0)], "plant_id long, interconnect string, type string, pmin double, pmax double, ramp_30 double")
    cost = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "plant_id long, c0 double, c1 double, c2 double")
    out = assemble_generators(plant, cost, "Texas")
    row = out.first()
    # Costs see the stated minimum (0), the repaired minimum comes afterwards.
    assert row.output_point_0 == 0.0 and row.pmin == pytest.approx(2.5) and row.ramp_30 == pytest.approx(1.0)
    assert row.name == "gen1" and row.fuel_price == 1000.0
    assert "Python" not in plan(out.select(F.col("name"), "pmin"))


def test_unknown_bus_codes_stay_and_are_reported(spark):
    from gridloom import fixed
    from gridloom.operators.quality import unknown_codes

    bus = spark.createDataFrame([(1, 1), (2, 4), (3, 9), (4, None)], "bus_id int, type int")
    labelled = C.code_to_label(bus, "type", fixed.BUS_TYPES, "bustype")
    assert sorted(r.bus_id for r in P.drop_isolated(labelled).collect()) == [1, 3, 4]
    assert sorted((r.type or 0, r.n) for r in unknown_codes(bus, "type", list(fixed.BUS_TYPES)).collect()) == [(0, 1), (9, 1)]


def test_large_tables_of_codes(spark):
    """5,000 entries, as a literal and as a table."""
    entries = {i: f"label {i}" for i in range(5000)}
    rows = spark.range(0, 6000, 7).withColumnRenamed("id", "code")
    table = spark.createDataFrame(list(entries.items()), "code long, label string")
    want = [(i, entries.get(i)) for i in range(0, 6000, 7)]
    for mapping in (entries, table):
        got = C.code_to_label(rows, "code", mapping, "label").orderBy("code").collect()
        assert [(r.code, r.label) for r in got] == want
    rules = table.select(F.col("code").alias("kind"), F.col("label").alias("unit_type"))
    got = C.case_by_category(rows, "code", rules, {"unit_type": "OT"}).orderBy("code").collect()
    assert [r.unit_type for r in got] == [label or "OT" for _, label in want]


def test_generator_classes_from_a_table(spark):
    from gridloom import fixed

    table = spark.createDataFrame([(f, u, c) for c, f, u in fixed.GENERATOR_CLASSES], "fuel string, unit_type string, class string")
    rows = spark.createDataFrame([("hydro", "ror"), ("HYDRO", "INFLOW"), ("solar", "xx"), ("ng", None), ("storage", "z"), ("none", "z")], "fuel string, unit_type string")
    by_literal = C.map_generator_class(rows, fixed.GENERATOR_CLASSES).collect()
    assert sorted(map(str, C.map_generator_class(rows, table.dropDuplicates(["fuel", "unit_type"])).collect())) == sorted(map(str, by_literal))


def test_dc_links_without_an_interconnect(spark):
    from gridloom.plans.case_assembly import assemble_dc_branches

    buses = spark.createDataFrame([(1,), (2,)], "bus_id int")
    links = spark.createDataFrame([(1, 1, 2), (2, 1, 7)], "dcline_id int, from_bus_id int, to_bus_id int")
    assert assemble_dc_branches(links, buses).count() == 2
    assert assemble_dc_branches(links, buses, "X").count() == 1
