from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.time import day_block
from gridloom.operators import aggregates as A
from gridloom.operators import market as M
from gridloom.operators import network as N
from gridloom.operators import ordered
from gridloom.operators import quality as Q
from gridloom.operators.ordered import draw_blocks

# A triangle of buses: (line, from, to, r, x, b).
LINES = [("a", 1, 2, 0.01, 0.12, 0.2), ("b", 1, 3, 0.02, 0.15, 0.1), ("c", 2, 3, 0.03, 0.5, 0.4)]


def factors(lines, slack=1, buses=(1, 2, 3)):
    """Transfer factors by a dense solve, for the small test network only."""
    others = [b for b in buses if b != slack]
    incidence = np.array([[(f == b) - (t == b) for b in others] for _, f, t, *_ in lines], float)
    weights = np.diag([1 / x for _, _, _, _, x, _ in lines])
    dense = weights @ incidence @ np.linalg.inv(incidence.T @ weights @ incidence)
    out = [(name, slack, 0.0) for name, *_ in lines]
    return out + [(line[0], b, float(dense[i, j])) for i, line in enumerate(lines) for j, b in enumerate(others)]


@pytest.fixture(scope="module")
def branch(spark):
    df = spark.createDataFrame(LINES, "line string, from_bus_id int, to_bus_id int, r double, x double, b double")
    return df.withColumns({"b_from": F.col("b") / 2, "b_to": F.col("b") / 2}).cache()


def test_ybus_rows_sum_to_the_shunts(spark, branch):
    rows = N.ybus(branch).groupBy("i").agg(F.sum("re").alias("re"), F.sum("im").alias("im")).collect()
    shunt = {1: 0.15, 2: 0.3, 3: 0.25}
    for row in rows:
        assert row.re == pytest.approx(0.0, abs=1e-9) and row.im == pytest.approx(shunt[row.i])


def test_ybus_equals_complex_arithmetic(branch):
    want = np.zeros((4, 4), complex)
    for _, f, t, r, x, b in LINES:
        y = 1 / complex(r, x)
        want[f, f] += y + 1j * b / 2
        want[t, t] += y + 1j * b / 2
        want[f, t] -= y
        want[t, f] -= y
    for row in N.ybus(branch).collect():
        assert complex(row.re, row.im) == pytest.approx(want[row.i, row.j])


def test_ybus_tap_shunt_and_zero_impedance(spark):
    df = spark.createDataFrame([(1, 2, 0.0, 0.5, 0.0, 0.0, 2.0), (1, 2, 0.0, 0.0, 9.0, 9.0, None)], "from_bus_id int, to_bus_id int, r double, x double, b_from double, b_to double, tap double")
    shunt = spark.createDataFrame([(2, 0.1, 0.2)], "bus_id int, g double, b double")
    got = {(r.i, r.j): (r.re, r.im) for r in N.ybus(df, shunt, tap="tap").collect()}
    assert got[1, 1] == pytest.approx((0.0, -0.5)) and got[1, 2] == pytest.approx((0.0, 1.0))
    assert got[2, 2] == pytest.approx((0.1, -1.8))


def test_fault_delta_of_a_tripled_line(branch):
    here = F.col("line") == "b"
    fault = branch.withColumns({c: F.when(here, F.col(c) * 3).otherwise(F.col(c)) for c in ("r", "x")})
    rows = {(r.i, r.j) for r in N.ybus_fault_delta(N.ybus(branch), N.ybus(fault)).collect()}
    assert rows == {(1, 1), (3, 3), (1, 3), (3, 1)}
    assert N.ybus_fault_delta(N.ybus(branch), N.ybus(branch)).count() == 0


def test_lodf_equals_a_new_solve(spark, branch):
    ptdf = spark.createDataFrame(factors(LINES), "line string, bus_id int, factor double")
    got = {(r.line, r.outage): r.lodf for r in N.lodf_from_ptdf(ptdf, branch).collect()}
    one = {(r.line, r.outage): r.lodf for r in N.lodf_from_ptdf(ptdf, branch.filter("line = 'a'")).collect()}
    assert one == {k: v for k, v in got.items() if k[1] == "a"}
    assert len(got) == 9 and all(got[k, k] == -1.0 for k in "abc")
    injection = {1: 1.7, 2: -0.4, 3: -1.3}

    def flows(lines):
        out = {name: 0.0 for name, *_ in lines}
        for name, bus, value in factors(lines):
            out[name] += value * injection[bus]
        return out

    before = flows(LINES)
    for outage in "abc":
        after = flows([line for line in LINES if line[0] != outage])
        for name, flow in after.items():
            assert before[name] + got[name, outage] * before[outage] == pytest.approx(flow)


def test_lodf_of_a_bridge_is_null(spark):
    lines = [("a", 1, 2, 0.0, 0.1, 0.0), ("b", 2, 3, 0.0, 0.1, 0.0)]
    ptdf = spark.createDataFrame(factors(lines), "line string, bus_id int, factor double")
    ends = spark.createDataFrame([line[:3] for line in lines], "line string, from_bus_id int, to_bus_id int")
    got = {(r.line, r.outage): r.lodf for r in N.lodf_from_ptdf(ptdf, ends).collect()}
    # each line carries its own transfer alone, so nothing moves to the other one
    assert got["a", "a"] == got["b", "b"] == -1.0 and not got.get(("a", "b"))


def test_flow_is_the_matrix_product(spark):
    ptdf = spark.createDataFrame(factors(LINES), "line string, bus_id int, factor double")
    rows = [(t, b, float(t * b - 3)) for t in range(4) for b in (1, 2, 3)]
    injection = spark.createDataFrame(rows, "ts int, bus_id int, injection double")
    got = {(r.ts, r.line): r.flow for r in N.ptdf_flow(ptdf, injection).collect()}
    for t in range(4):
        for name in "abc":
            want = sum(v * (t * b - 3) for n, b, v in factors(LINES) if n == name)
            assert got.get((t, name), 0.0) == pytest.approx(want)


def test_lmp_adds_duals_and_keeps_uncongested_points(spark):
    ptdf = spark.createDataFrame(factors(LINES), "line string, bus_id int, factor double")
    dual = spark.createDataFrame([(1, "a", 5.0), (1, "b", 0.0), (2, "a", 0.0)], "ts int, line string, mu double")
    energy = spark.createDataFrame([(1, 30.0), (2, 40.0)], "ts int, price double")
    points = spark.createDataFrame([(t, b) for t in (1, 2) for b in (1, 2, 3)], "ts int, bus_id int")
    got = {(r.ts, r.bus_id): r.lmp for r in N.lmp(points, energy, dual, ptdf).collect()}
    unpriced = points.union(points.selectExpr("7", "bus_id").limit(1))
    assert [r.lmp for r in N.lmp(unpriced, energy, dual, ptdf).collect() if r.ts == 7] == [None]
    value = {b: v for n, b, v in factors(LINES) if n == "a"}
    assert got[1, 2] == pytest.approx(30.0 + 5.0 * value[2]) and got[1, 1] == 30.0
    assert got[2, 3] == 40.0 and len(got) == 6


# ---- market ----


@pytest.fixture(scope="module")
def offers(spark):
    rows = [(1, "u1", 10.0, 50.0), (1, "u2", 10.0, 30.0), (1, "u3", 40.0, 20.0), (2, "u1", 12.0, 50.0), (2, "u3", 5.0, 20.0)]
    return spark.createDataFrame(rows, "ts int, unit string, price double, pmax double").cache()


@pytest.fixture(scope="module")
def demand(spark):
    return spark.createDataFrame([(1, 85.0), (2, 200.0), (3, 10.0)], "ts int, demand double").cache()


@pytest.mark.parametrize("width", [0.5, 10.0, 1000.0, None])
def test_dispatch_plus_unserved_is_demand(offers, demand, width):
    band = width and F.floor(F.col("price") / width)
    out = M.merit_order_dispatch(offers, demand, ["ts"], "unit", band)
    power = {(r.ts, r.unit): float(r.power) for r in out.collect()}
    assert power == {(1, "u1"): 50.0, (1, "u2"): 30.0, (1, "u3"): 5.0, (2, "u1"): 50.0, (2, "u3"): 20.0}
    short = {r.ts: float(r.unserved) for r in M.unserved_demand(offers, demand, ["ts"]).collect()}
    assert short == {1: 0.0, 2: 130.0, 3: 10.0}
    price = {r.ts: r.clearing_price for r in M.clearing_price(offers, demand, ["ts"], "unit", 100000.0, band).collect()}
    assert price == {1: 40.0, 2: 100000.0, 3: 100000.0}


def test_commitment_runs_and_limits(spark):
    status = [0, 1, 1, 0, 0, 0, 1, 0]
    rows = [("g", f"2024-01-0{1 + i // 4} {i % 4 * 6:02d}:00:00", s) for i, s in enumerate(status)]
    on = spark.createDataFrame(rows, "unit string, t string, on int").select("unit", F.col("t").cast("timestamp_ntz").alias("ts"), "on")
    limits = spark.createDataFrame([("g", 7.0, 12.0)], "unit string, min_up_time double, min_down_time double")
    out = M.commitment_runs(on, ["unit"], "ts", day_block("ts", 1), 6.0, limits).orderBy("run").collect()
    assert [(r.on, r.steps, r.violates) for r in out] == [(0, 1, 0), (1, 2, 0), (0, 3, 0), (1, 1, 1), (0, 1, 0)]
    moves = M.commitment_transitions(on, ["unit"], "ts", day_block("ts", 1)).orderBy("ts").collect()
    assert [r.start for r in moves] == [0, 1, 0, 0, 0, 0, 1, 0] and [r.stop for r in moves] == [0, 0, 0, 1, 0, 0, 0, 1]


def test_energy_limit_periods(spark):
    rows = [("h", 0, s, 1.0 * s) for s in range(5)]
    up = spark.createDataFrame(rows, "component string, initial_time int, step int, value double")
    caps = {r.period: r.energy_cap for r in A.energy_limit(up, 2).collect()}
    assert caps == {0: 1.0, 1: 5.0, 2: 4.0}
    down = up.withColumn("value", F.col("value") + 0.5)
    assert all(r.excess > 0 for r in A.energy_limit_breach(down, A.energy_limit(up, 2), 2).collect())


def test_balance_row(spark):
    gen = spark.createDataFrame([(1, 5.0), (2, 1.0)], "bus_id int, value double")
    load = spark.createDataFrame([(2, 4.0)], "bus_id int, value double")
    got = {(r.bus_id, r.level): r.injection for r in A.net_injection_by_bus(gen.union(gen.selectExpr("null", "7.0").limit(1)), load).collect()}
    assert got == {(1, "bus"): 5.0, (2, "bus"): -3.0, (None, "bus"): 7.0, (None, "balance"): 9.0}


def test_approx_equal_flags_missing_rows(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 1.0), (3, 0.0)], "k int, value double")
    b = spark.createDataFrame([(1, 100.00001), (2, 2.0), (4, 1.0)], "k int, value double")
    got = {r.k: r.equal for r in Q.approx_equal(a, b, ["k"], rtol=1e-6).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_stack_offsets_sum_duplicates_first(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", 4.0)], "ts int, category string, value double")
    assert [(r.category, r.top) for r in M.stack_offsets(df).orderBy("category").collect()] == [("a", 3.0), ("b", 7.0)]
    blocked = M.stack_offsets(df, block=F.ascii("category"))
    assert [(r.category, r.top) for r in blocked.orderBy("category").collect()] == [("a", 3.0), ("b", 7.0)]


@pytest.mark.parametrize("band", ["price", "data"])
def test_hot_interval_against_brute_force(spark, band):
    """One interval holds most offers, most of them at one price."""
    rng = random.Random(5)
    rows = []
    for unit in range(900):
        ts = 1 if rng.random() < 0.7 else rng.randrange(2, 9)
        price = 20.0 if rng.random() < 0.8 else float(rng.randrange(1, 60))
        rows.append((ts, unit, price, float(rng.randrange(0, 9))))
    want_demand = {ts: float(rng.randrange(1, 4000)) for ts in range(1, 10)}
    offers = spark.createDataFrame(rows, "ts int, unit int, price double, pmax double")
    demand = spark.createDataFrame(list(want_demand.items()), "ts int, demand double")
    block = F.floor(F.col("price") / 7) if band == "price" else None
    power = {(r.ts, r.unit): float(r.power) for r in M.merit_order_dispatch(offers, demand, ["ts"], "unit", block).collect()}
    price = {r.ts: r.clearing_price for r in M.clearing_price(offers, demand, ["ts"], "unit", 100000.0, block).collect()}
    short = {r.ts: float(r.unserved) for r in M.unserved_demand(offers, demand, ["ts"]).collect()}
    assert len(power) == len(rows)
    for ts, left in want_demand.items():
        marginal = 100000.0
        for _, unit, offered, pmax in sorted((r for r in rows if r[0] == ts), key=lambda r: (r[2], r[1])):
            used = max(0.0, min(pmax, left))
            assert power[ts, unit] == used
            if marginal == 100000.0 and left <= pmax:
                marginal = offered
            left -= pmax
        assert price[ts] == marginal and short[ts] == max(0.0, left)


def test_cuts_split_a_hot_interval_and_a_hot_price(spark, monkeypatch):
    """Most offers are of one interval and one price; blocks still hold about equal row counts."""
    offers = spark.range(0, 20_000, 1, 6).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 5 + 2).cast("int").alias("ts"), F.col("id").alias("unit"),
        F.when(F.col("id") % 7 < 6, 20.0).otherwise(F.col("id") % 40 + 0.5).alias("price"), F.lit(1.0).alias("pmax"),
    )
    met, band = draw_blocks(offers, ["ts"], ["price", "unit"], rows=1000)
    blocks = met.withColumn("block", band)
    sizes = [r["count"] for r in blocks.groupBy("ts", "block").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 3000
    assert 10 <= blocks.filter("ts = 1").select("block").distinct().count() <= 25
    spans = blocks.groupBy("ts", "block").agg(F.min(F.struct("price", "unit")).alias("lo"), F.max(F.struct("price", "unit")).alias("hi")).orderBy("ts", "block").collect()
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]) if a.ts == b.ts)
    demand = spark.createDataFrame([(1, 9000.0), (5, 1.0), (6, 10_000.0)], "ts int, demand double")
    plain = sorted(map(str, M.merit_order_dispatch(offers, demand, ["ts"], "unit").collect())), sorted(map(str, M.clearing_price(offers, demand, ["ts"], "unit", 1e5).collect()))
    monkeypatch.setattr(ordered, "ROWS_PER_BLOCK", 1000)
    cut = sorted(map(str, M.merit_order_dispatch(offers, demand, ["ts"], "unit").collect())), sorted(map(str, M.clearing_price(offers, demand, ["ts"], "unit", 1e5).collect()))
    assert cut == plain and len(plain[0]) == 20_000


def test_bids_that_change_by_interval(spark):
    bids = spark.createDataFrame(
        [(1, "g", [(100.0, 10.0), (400.0, 20.0)]), (2, "g", [(50.0, 10.0), (50.0, 10.0), (70.0, 12.0)])],
        "ts int, plant string, points array<struct<cost: double, power: double>>",
    )
    steps = M.bid_steps(bids, ["ts", "plant"])
    assert sorted(map(tuple, steps.collect())) == [(1, "g", 0, 10.0, 10.0), (1, "g", 1, 30.0, 10.0), (2, "g", 0, 5.0, 10.0), (2, "g", 2, 10.0, 2.0)]
    demand = spark.createDataFrame([(1, 15.0), (2, 11.0)], "ts int, demand double")
    offer = steps.withColumn("unit", F.struct("plant", "step"))
    dispatch = M.merit_order_dispatch(offer, demand, ["ts"], "unit")
    unserved = M.unserved_demand(offer, demand, ["ts"])
    assert A.objective_value(dispatch, unserved, 1000.0).first().objective == 10 * 10 + 5 * 30 + 10 * 5 + 1 * 10


def test_objective_uses_the_price_of_each_interval(spark):
    dispatch = spark.createDataFrame([(1, "g", 10.0, 5.0), (2, "g", 100.0, 5.0), (1, "free", None, 3.0)], "ts int, unit string, price double, power double")
    unserved = spark.createDataFrame([(1, 0.0), (2, 2.0)], "ts int, unserved double")
    assert A.objective_value(dispatch, unserved, 1000.0).first().objective == 550.0 + 2000.0


def test_tiles_sum_before_rows_leave(spark):
    """A dense product: far fewer rows than products, the same flows, nodal prices and gaps."""
    draw = np.random.default_rng(3)
    dense = [(line, bus, float(draw.normal())) for line in range(30) for bus in range(-5, 95) if (line + bus) % 11]
    power = [(ts, bus, float(draw.normal())) for ts in range(12) for bus in range(-5, 95, 1 + ts % 3)] + [(3, 7, 1.5), (3, None, 2.0), (None, 7, 2.0)]
    ptdf = spark.createDataFrame([*dense, (None, 7, 1.0), (4, None, 1.0), (5, 8, None)], "line long, bus_id long, factor double")
    injection = spark.createDataFrame(power, "ts int, bus_id long, injection double")
    plain = {(r.ts, r.line): r.flow for r in N.ptdf_flow(ptdf, injection).collect()}
    for tile in (1, 16, 1000):
        got = {(r.ts, r.line): r.flow for r in N.ptdf_flow(ptdf, injection, tile).collect()}
        assert got.keys() == plain.keys() and all(got[k] == pytest.approx(plain[k]) for k in plain)
    per_bus = injection.dropna().groupBy("ts", "bus_id").agg(F.sum("injection").alias("injection"))
    parts = N.tile_products(per_bus, ptdf.dropna(), "bus_id", "line", "injection", 16)
    products = per_bus.join(ptdf.dropna(), "bus_id").count()
    assert parts.count() < products / 5
    dual = spark.createDataFrame([(ts, line, float(draw.normal())) for ts in range(5) for line in range(0, 30, 2)], "ts int, line long, mu double")
    points = spark.createDataFrame([(ts, bus) for ts in range(6) for bus in range(0, 90, 7)], "ts int, bus_id long")
    energy = spark.createDataFrame([(ts, 10.0 + ts) for ts in range(5)], "ts int, price double")
    prices = [{(r.ts, r.bus_id): r.lmp for r in N.lmp(points, energy, dual, ptdf, tile).collect()} for tile in (None, 8)]
    assert prices[0].keys() == prices[1].keys() and all(prices[1][k] == (None if v is None else pytest.approx(v)) for k, v in prices[0].items())


def test_products_that_stay_in_their_task(spark, plan, monkeypatch):
    factors = spark.sql("select id % 30 as line, id % 47 as bus_id, cast(id % 5 - 2 as double) as factor from range(1410) where id % 3 > 0 union all select 29, null, 1.0D")
    dual = spark.sql("select nullif(timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id % 300 as int)), timestamp_ntz'2024-01-01') as ts, id % 29 as line, cast(id % 7 - 3 as double) as mu from range(4000)")
    want = sorted(map(str, N.congestion_component(dual, factors).collect()))
    monkeypatch.setattr(N, "PRODUCTS_PER_TASK", 2000)
    for per_row, others in ((0, 20), (0, 1000), (10**9, 20)):  # cells of several blocks, of one, and the products themselves
        monkeypatch.setattr(N, "PRODUCTS_PER_ROW", per_row)
        monkeypatch.setattr(N, "OTHERS_PER_CELL", others)
        got = N.congestion_component(dual, factors)
        assert sorted(map(str, got.collect())) == want
        text = plan(got).split("Initial Plan")[0]
        # neither the join nor the partial sums have fewer tasks than the products need; of cells, no product is shuffled
        assert ("Exchange hashpartitioning(ts" in text) == (per_row > 0)
        tasks = [int(x) for x in re.findall(r", (\d+)\), REPARTITION_BY_NUM", text)]
        assert tasks and min(tasks) >= (4 if per_row == 0 else 30)


def test_cells_are_full_and_carry_no_gaps(spark, plan, monkeypatch):
    """Copies of vectors hold the values that are there only, tiles of stamps are full, and each cell is a task."""
    for name, to in (("PRODUCTS_PER_TASK", 10), ("PRODUCTS_PER_ROW", 0), ("OTHERS_PER_CELL", 20), ("COPIES_PER_TASK", 500)):
        monkeypatch.setattr(N, name, to)
    dual = spark.sql("select nullif(id % 320, 63) as ts, id % 29 as line, cast(id % 7 + 1 as decimal(18,4)) as mu from range(0, 4000, 3)")
    factors = spark.sql("select id % 30 as line, if(id % 40 = 0, null, id % 40) as bus_id, cast(id % 5 - 2 as decimal(18,4)) as factor from range(1200) union all select null, 1, 1.0")
    per_line = dual.groupBy("ts", "line").agg(F.sum("mu").alias("mu"))
    want = per_line.join(factors.where("factor <> 0"), "line").groupBy("ts", "bus_id").agg(F.sum(F.col("mu") * F.col("factor")).alias("congestion"))
    got = N.congestion_component(dual, factors)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    text = plan(got).split("Initial Plan")[0]
    blocks = -(-factors.agg(F.approx_count_distinct("bus_id")).first()[0] // 20)
    assert "direct_shuffle_partition_id(cell" in text and f", {5 * blocks}), REPARTITION_BY_NUM" in text  # 320 stamps are five tiles
    stamps = per_line.select("ts").distinct().coalesce(1).withColumn("slot", F.monotonically_increasing_id().cast("int"))
    stamps = stamps.select("ts", F.floor(F.col("slot") / 64).alias("tile"), F.col("slot") % 64).toDF("ts", "tile", "slot")
    rows = N._rows_of_stamps(per_line, stamps, "line", "mu", 4)
    assert rows.agg(F.sum(F.size("values")), F.sum(F.bit_count("mask"))).first() == (per_line.count(),) * 2
