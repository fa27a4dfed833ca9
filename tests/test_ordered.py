"""The blocked operations give the results of a plain window, also with one hot key."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.operators import ordered
from gridloom.operators.market import commitment_runs, commitment_transitions, initial_conditions, ramp_check
from gridloom.operators.ordered import carry_forward, draw_blocks, previous_values, running_total
from gridloom.operators.series import infer_resolution, remove_series


def rows(seed: int, n: int = 600):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}"
        known = None if rng.random() < 0.4 else rng.randrange(100)
        out.append((key, i, rng.randrange(5), known))
    rng.shuffle(out)
    return out


@pytest.fixture(params=[1, 2, 3])
def data(spark, request):
    return spark.createDataFrame(rows(request.param), "key string, pos int, amount int, known int").cache()


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_previous_values(data, width):
    block = F.floor(F.col("pos") / width)
    got = previous_values(data, ["key"], ["pos"], {"before": "amount", "before_known": "known"}, block)
    w = Window.partitionBy("key").orderBy("pos")
    want = data.withColumns({"before": F.lag("amount").over(w), "before_known": F.lag("known").over(w)})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_running_total(data, width):
    got = running_total(data, ["key"], ["pos"], "amount", F.floor(F.col("pos") / width), "total")
    w = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumn("total", F.sum("amount").over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_carry_forward(data, width):
    got = carry_forward(data, ["key"], ["pos"], "known", F.floor(F.col("pos") / width), "last")
    w = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumn("last", F.last("known", ignorenulls=True).over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def null_rows(seed: int):
    """Two keys with nulls in each, one stamp per key that is null, null values."""
    rng = random.Random(seed)
    out = []
    for zone in ("z", None, ""):
        for unit in (1, None, 0):
            stamps = rng.sample(range(300), 60)
            out += [(zone, unit, p, rng.choice([None, 0, 1, 2]), rng.choice([None, 5, 6])) for p in [*stamps, *([None] if rng.random() < 0.8 else [])]]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("cut", [1, 2, 40, 1000, "null block of some", None])
@pytest.mark.parametrize("seed", [4, 5])
def test_null_keys_stamps_and_values(spark, monkeypatch, cut, seed):
    monkeypatch.setattr(ordered, "ROWS_PER_BLOCK", 9)
    data = spark.createDataFrame(null_rows(seed), "zone string, unit int, pos int, amount int, known int")
    block = None if cut is None else F.when(F.col("pos") > 30, F.floor(F.col("pos") / 50)) if isinstance(cut, str) else F.floor(F.col("pos") / cut)
    keys, order = ["zone", "unit"], Window.partitionBy("zone", "unit").orderBy("pos")
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    same = lambda got, want: sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    want = data.withColumns({"before": F.lag("amount").over(order), "at": F.lag("pos").over(order)})
    assert same(previous_values(data, keys, ["pos"], {"before": "amount", "at": "pos"}, block), want)
    assert same(running_total(data, keys, ["pos"], "amount", block, "total"), data.withColumn("total", F.sum("amount").over(up_to)))
    assert same(carry_forward(data, keys, ["pos"], "known", block, "last"), data.withColumn("last", F.last("known", ignorenulls=True).over(up_to)))
    two = Window.partitionBy("zone").orderBy("pos", "unit", "amount", "known")
    wide = data.where("pos is not null")
    got = previous_values(wide, ["zone"], ["pos", "unit", "amount", "known"], {"before": "unit"}, block)
    assert same(got, wide.withColumn("before", F.lag("unit").over(two)))


def test_dense_keys_take_many_drawn_blocks(spark):
    hot = spark.range(20_000).select(F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"), F.lit("same").alias("price"))
    cold = spark.range(300).select(F.concat(F.lit("k"), (F.col("id") % 10).cast("string")).alias("key"), F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("ts"), F.lit("same").alias("price"))
    both = hot.unionByName(cold)
    for order in (["ts"], ["price", "ts"]):  # one price for all: the cuts are between stamps
        met, block = draw_blocks(both, ["key"], order, rows=500)
        sizes = met.withColumn("block", block).groupBy("key", "block").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("key", "block").collect()
        mine = [r for r in sizes if r.key == "hot"]
        assert 30 <= len(mine) <= 50 and max(r.n for r in mine) < 1500 and len(sizes) == len(mine) + 10
        assert all(x.b < y.a for x, y in zip(mine, mine[1:]))
    assert draw_blocks(cold, ["key"], ["ts"], rows=500)[1] is None
    met, block = draw_blocks(both, ["key"], ["price"], rows=500)  # nothing to cut at
    assert met.select(block.alias("b")).distinct().count() <= 2


def test_operators_with_drawn_blocks_and_null_units(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_BLOCK", 50)
    rng = random.Random(9)
    rows = [(u, h, int(rng.random() < 0.6), float(rng.randrange(50))) for u in ("a", "b", None) for h in range(0, 500, 2)]
    on = spark.createDataFrame(rows, "unit string, h long, on int, value double").withColumn("ts", F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz")).drop("h")
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (7 * 86400 * 10**6))
    limits = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "unit string, ramp_limit double")
    both = lambda f: [sorted(map(str, f(block).collect())) for block in (None, day, F.lit(1))]
    for f in (
        lambda block: commitment_transitions(on, ["unit"], "ts", block),
        lambda block: ramp_check(on, limits, ["unit"], "ts", block),
        lambda block: commitment_runs(on, ["unit"], "ts", block, 2.0),
        lambda block: infer_resolution(on, ["unit"], "ts", block),
        lambda block: initial_conditions(on.withColumn("initial_time", F.date_trunc("day", "ts").cast("timestamp_ntz")), ["unit"], F.lit(1) if block is not None else None),
    ):
        drawn, weeks, whole = both(f)
        assert drawn == weeks == whole and drawn
    starts = commitment_transitions(on, ["unit"], "ts").groupBy("unit").agg(F.sum("start").alias("n")).collect()
    assert {r.unit: r.n for r in starts} == {u: sum(not x[2] and y[2] for x, y in zip(mine, mine[1:])) for u in ("a", "b", None) for mine in [[r for r in rows if r[0] == u]]}


def test_rows_without_a_kind_stay(spark):
    store = spark.createDataFrame([("A",), (None,), ("B",)], "kind string")
    assert {r.kind for r in remove_series(store, "A").collect()} == {None, "B"}


def test_rows_are_spread_over_blocks(data, plan):
    text = plan(running_total(data, ["key"], ["pos"], "amount", F.floor(F.col("pos") / 10), "total"))
    found = text.split("hashpartitioning(__key0", 1)[1][:80]
    assert "__block" in found and text.count("Exchange hashpartitioning(__key0") <= 4
