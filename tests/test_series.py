from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.functions.time import day_block
from gridloom.operators import series as S


@pytest.fixture(scope="module")
def two_days(spark):
    grid = S.regular_grid(spark, "2024-01-01 00:00:00", "2024-01-02 23:00:00", 3600)
    return grid.select(F.lit("a").alias("component"), "ts", F.hour("ts").cast("double").alias("value")).cache()


def test_leap_year_grid(spark):
    grid = S.regular_grid(spark, "2020-01-01 00:00:00", "2020-12-31 23:00:00", 3600)
    assert grid.count() == 8784 and grid.distinct().count() == 8784
    assert grid.agg(F.max("ts").cast("string")).first()[0] == "2020-12-31 23:00:00"


@pytest.mark.parametrize(("horizon", "interval", "n"), [(24, 86400, 2), (24, 3600, 25), (48, 3600, 1), (49, 3600, 0), (1, 3600, 48)])
def test_window_counts(two_days, horizon, interval, n):
    out = S.forecast_windows(two_days, ["component"], "ts", horizon, interval, 3600)
    assert out.select("initial_time").distinct().count() == n
    assert out.count() == n * horizon
    assert out.groupBy("initial_time").agg(F.countDistinct("step").alias("s")).filter(F.col("s") != horizon).count() == 0


def test_windows_by_literal_bounds_need_no_shuffle(two_days, plan):
    bounds = ("2024-01-01 00:00:00", "2024-01-02 23:00:00")
    out = S.forecast_windows(two_days, ["component"], "ts", 24, 3600, 3600, bounds)
    assert "Exchange" not in plan(out) and "Join" not in plan(out)
    free = S.forecast_windows(two_days, ["component"], "ts", 24, 3600, 3600)
    assert sorted(map(str, out.collect())) == sorted(map(str, free.collect()))


def test_realized_has_one_row_per_stamp(two_days, plan):
    windows = S.forecast_windows(two_days, ["component"], "ts", 24, 3600, 3600)
    real = S.realized(windows, 3600)
    assert real.count() == real.select("component", "ts").distinct().count() == 25
    stored = windows.limit(5).sparkSession.createDataFrame(windows.take(5), windows.schema)
    assert "Exchange" not in plan(S.realized(stored, 3600))


def test_wide_and_back(two_days):
    other = two_days.withColumns({"component": F.lit("b"), "value": F.col("value") * 2})
    long = two_days.unionByName(other)
    back = S.melt_series(S.pivot_series(long, ["a", "b"]), "ts", ["a", "b"])
    key = ["component", "ts", "value"]
    assert sorted(map(str, back.select(key).collect())) == sorted(map(str, long.select(key).collect()))


def test_normalize_and_scale(spark):
    rows = [("a", 2.0), ("a", 4.0), ("z", 0.0), ("n", 5.0), ("q", 1.0)]
    series = spark.createDataFrame(rows, "component string, value double").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    factors = spark.createDataFrame([("a", "Max"), ("z", "1.0"), ("n", "10"), ("q", "0")], "component string, factor string")
    out = S.normalize_series(series, factors, ["component"])
    got = sorted((r.component, r.value, r.normalized) for r in out.collect() if r.component != "q")
    assert got == [("a", 2.0, 0.5), ("a", 4.0, 1.0), ("n", 5.0, 0.5), ("z", 0.0, 0.0)]
    assert out.filter("component = 'q'").first().normalized is None


def test_resolution_finds_mixed_steps(spark, two_days):
    five = S.regular_grid(spark, "2024-01-01 00:00:00", "2024-01-20 00:00:00", 300).select(F.lit("b").alias("component"), "ts")
    uneven = five.filter(F.dayofmonth("ts") != 9).withColumn("component", F.lit("c"))
    out = S.infer_resolution(two_days.select("component", "ts").unionByName(five).unionByName(uneven), ["component"], "ts", day_block("ts", 2))
    assert {r.component: (r.resolution_s, r.different_steps) for r in out.collect()} == {"a": (3600, 1), "b": (300, 1), "c": (300, 2)}


def test_forecast_params(two_days):
    windows = S.forecast_windows(two_days, ["component"], "ts", 6, 7200, 3600)
    row = S.forecast_params(windows, ["component"], day_block("initial_time", 1)).first()
    assert (row.horizon, row.interval_s, row.window_count, row.resolution_s) == (6, 7200, 22, 3600)


def test_cost_curves_as_values(spark):
    units = spark.sql("select 'u' as unit, array(named_struct('mw', 1.0D, 'cost', 2.0D)) as curve")
    out = S.constant_series(units, "2020-01-01 00:00:00", "2020-01-01 03:00:00", 3600, "curve", ["unit"])
    assert out.count() == 4 and out.first().value[0].cost == 2.0


def test_compare_runs_of_unequal_step(spark):
    a = spark.createDataFrame([("e", "s", i / 10, float(i)) for i in range(20)], "entity string, state string, t double, value double")
    b = spark.createDataFrame([("e", "s", i / 5, float(2 * i + 1)) for i in range(10)], "entity string, state string, t double, value double")
    row = S.compare_runs(a, b, 1.0).first()
    assert row.buckets == 2 and row.max_abs_diff == pytest.approx(0.5)
