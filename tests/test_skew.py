"""A component with a third of all rows: shuffled joins split it, results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.functions.time import day_block, plus_seconds, stamp
from gridloom.operators import aggregates as A
from gridloom.operators import series as S
from gridloom.operators.skew import BLOCK_DAYS

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffled(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot_series(spark):
    component = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string")))
    ts = plus_seconds(stamp("2024-01-01"), F.col("id") * 60)
    return spark.range(0, 60_000, 1, 12).select(component.alias("component"), ts.alias("ts"), (F.col("id") % 97).cast("double").alias("value"))


def test_scaling_joins_split_the_hot_component(shuffled, hot_series, plan):
    components = shuffled.createDataFrame([("hot", 2.0)] + [(f"c{n}", 2.0) for n in range(500)], "component string, pmax double")
    out = S.scale_series(hot_series, components, "pmax")
    assert out.agg(F.count(F.lit(1)), F.sum("scaled")).first() == hot_series.agg(F.count(F.lit(1)), F.sum(F.col("value") * 2)).first()
    out.collect()
    assert "skew=true" in plan(out)


def test_joins_with_grouped_tables_are_spread_over_time(shuffled, hot_series, plan):
    factors = hot_series.select("component").distinct().withColumn("factor", F.lit("Max"))
    out = S.normalize_series(hot_series, factors, ["component"])
    assert out.count() == 60_000 and out.agg(F.max("normalized")).first()[0] == 1.0
    windows = S.forecast_windows(hot_series, ["component"], "ts", 20, 3600, 180)
    for df in (out, windows):
        text = plan(df)
        joins = [line for line in text.splitlines() if "SortMergeJoin" in line and "__block" in line]
        assert joins and "hashpartitioning(component" in text
    blocks = hot_series.filter("component = 'hot'").groupBy(day_block("ts", BLOCK_DAYS).alias("block")).count()
    assert blocks.count() == 7 and blocks.agg(F.max("count")).first()[0] < 20_000 / 5


def test_rows_without_a_stamp_are_kept(spark):
    rows = spark.sql("select 'a' as component, timestamp_ntz'2024-01-01 00:00:00' as ts, 2.0D as value union all select 'a', null, 4.0D union all select 'b', null, 8.0D")
    factors = spark.createDataFrame([("a", "Max"), ("b", "2")], "component string, factor string")
    got = sorted((r.component, r.normalized) for r in S.normalize_series(rows, factors, ["component"]).collect())
    assert got == [("a", 0.5), ("a", 1.0), ("b", 4.0)]


def test_totals_by_area_with_a_hot_component(shuffled, hot_series):
    load = hot_series.select("component").distinct().withColumn("bus_id", F.length("component"))
    bus = shuffled.createDataFrame([(n, f"area{n % 2}") for n in range(1, 6)], "bus_id int, area string")
    got = {(r.area): r.total for r in A.demand_by_area(hot_series, load, bus).groupBy("area").agg(F.sum("demand").alias("total")).collect()}
    place = F.concat(F.lit("area"), (F.length("component") % 2).cast("string"))
    want = {r.area: r.total for r in hot_series.groupBy(place.alias("area")).agg(F.sum("value").alias("total")).collect()}
    assert got == want


def test_windows_of_a_hot_component_are_whole(shuffled, hot_series):
    hot = hot_series.filter("component = 'hot'")
    out = S.forecast_windows(hot_series, ["component"], "ts", 20, 3600, 180).filter("component = 'hot'")
    span = hot.count() - 20
    assert out.count() == (span * 180 // 3600 + 1) * 20
