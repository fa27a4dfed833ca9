"""Time series: shape, grids, scaling, forecast windows, realised values, trajectories.

Series stay long, one row per component and stamp. Wide frames are made only on request and
with the column list given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.time import col, epoch_seconds, plus_seconds, stamp
from gridloom.operators.ordered import previous_values
from gridloom.operators.skew import blocked_join


def melt_series(wide: DataFrame, ts: str, ids: Sequence[str], name: str = "component", value: str = "value") -> DataFrame:
    return wide.unpivot([ts], list(ids), name, value)


def pivot_series(
    long: DataFrame, components: Sequence[str], ts: str = "ts", name: str = "component", value: str = "value"
) -> DataFrame:
    return long.groupBy(ts).pivot(name, list(components)).agg(F.sum(value))


def regular_grid(spark: SparkSession, start: str, end: str, step_s: int, ts: str = "ts") -> DataFrame:
    """Stamps start : step : end, both kept. The rows come out in parallel."""
    span = (datetime.fromisoformat(end) - datetime.fromisoformat(start)).total_seconds()
    n = int(span // step_s) + 1
    return spark.range(n).select(plus_seconds(stamp(start), F.col("id") * F.lit(step_s)).alias(ts))


def stamps_between(start: str | Column, end: str | Column, step_s: int) -> Column:
    """Array of stamps between two columns, both ends kept."""
    zero = F.lit(0)
    step = F.make_dt_interval(zero, zero, zero, F.lit(step_s).cast("decimal(18,6)"))
    return F.sequence(col(start), col(end), step)


def grid_per_series(bounds: DataFrame, keys: Sequence[str], start: str, end: str, step_s: int, ts: str = "ts") -> DataFrame:
    """The regular grid of every series between its own bounds."""
    return bounds.select(*keys, F.explode(stamps_between(start, end, step_s)).alias(ts))


def constant_series(
    units: DataFrame, start: str, end: str, step_s: int, value: str | Column, keys: Sequence[str], ts: str = "ts"
) -> DataFrame:
    """The same value (of any type) at every stamp for each unit; each unit expands in place."""
    return units.select(
        *keys, F.explode(stamps_between(stamp(start), stamp(end), step_s)).alias(ts), col(value).alias("value")
    )


def normalize_series(
    series: DataFrame, factors: DataFrame, keys: Sequence[str], value: str = "value", out: str = "normalized",
    ts: str = "ts",
) -> DataFrame:
    """Divide by `factors(keys, factor)`: a number in text, or `Max` for the series' own maximum.

    The maximum is one aggregated row per series, joined back with the factors in one go. The rows
    of a series are spread over its time.
    """
    keys = list(keys)
    own_max = series.groupBy(*keys).agg(F.max(value).alias("__max"), F.min(ts).alias("__first"), F.max(ts).alias("__last"))
    divisor = F.when(F.col("factor") == "Max", F.col("__max").cast("double")).otherwise(
        F.col("factor").try_cast("double")
    )
    divisors = factors.join(own_max, keys).select(*keys, divisor.alias("__div"), "__first", "__last")
    return (
        blocked_join(series, divisors, keys, ts, "__first", "__last")
        .withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("__div")))
        .drop("__div", "__first", "__last")
    )


def scale_series(
    series: DataFrame, components: DataFrame, field: str, keys: Sequence[str] = ("component",),
    value: str = "value", out: str = "scaled",
) -> DataFrame:
    """Stored factor times a component field."""
    keys = list(keys)
    return (
        series.join(components.select(*keys, F.col(field).alias("__field")), keys)
        .withColumn(out, F.col(value) * F.col("__field"))
        .drop("__field")
    )


def series_bounds(series: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return series.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def forecast_windows(
    series: DataFrame,
    keys: Sequence[str],
    ts: str,
    horizon: int,
    interval_s: int,
    resolution_s: int,
    bounds: DataFrame | tuple[str, str] | None = None,
    first_start: str | None = None,
    last_start: str | None = None,
) -> DataFrame:
    """Overlapping windows of `horizon` points, one every `interval_s`, while a whole window fits.

    Every row works out by arithmetic which windows it belongs to and expands in place, so the
    series is neither shuffled nor joined to a window list. Bounds are one row per series (or two
    literals for a whole case, then nothing is joined at all). `first_start` and `last_start`
    limit the initial times before the expansion.
    """
    keys = list(keys)
    if isinstance(bounds, tuple):
        rows = series.withColumns({"first_ts": stamp(bounds[0]), "last_ts": stamp(bounds[1])})
    else:
        rows = blocked_join(series, bounds if bounds is not None else series_bounds(series, keys, ts), keys, ts)
    span = (horizon - 1) * resolution_s
    offset = epoch_seconds(ts) - epoch_seconds("first_ts")
    newest = epoch_seconds("last_ts") - epoch_seconds("first_ts") - F.lit(span)
    low = F.greatest(F.ceil((offset - F.lit(span)) / F.lit(interval_s)), F.lit(0).cast("long"))
    high = F.floor(F.least(offset, newest) / F.lit(interval_s))
    if first_start is not None:
        wanted = epoch_seconds(stamp(first_start)) - epoch_seconds("first_ts")
        low = F.greatest(low, F.ceil(wanted / F.lit(interval_s)))
    if last_start is not None:
        wanted = epoch_seconds(stamp(last_start)) - epoch_seconds("first_ts")
        high = F.least(high, F.floor(wanted / F.lit(interval_s)))
    numbered = rows.withColumns({"__low": low, "__high": high}).filter(F.col("__low") <= F.col("__high"))
    expanded = numbered.withColumn("__n", F.explode(F.sequence("__low", "__high")))
    initial = plus_seconds("first_ts", F.col("__n") * F.lit(interval_s))
    step = (epoch_seconds(ts) - epoch_seconds("first_ts") - F.col("__n") * F.lit(interval_s)) / F.lit(resolution_s)
    return expanded.withColumns({"initial_time": initial, "step": F.floor(step).cast("int")}).select(
        *series.columns, "initial_time", "step"
    )


def forecast_initial_times(windows: DataFrame) -> DataFrame:
    return windows.select("initial_time").distinct()


def series_names(series: DataFrame, component: str | None = None, key: str = "component") -> DataFrame:
    """Names of the series on one component, or on each."""
    rows = series if component is None else series.filter(F.col(key) == F.lit(component))
    return rows.select(key, "name").distinct()


def series_array(
    windows: DataFrame, component: str, initial_time: str, name: str | None = None, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Steps, stamps and values of one window. Rows, not one array, so any horizon will do."""
    rows = windows.filter((F.col("component") == F.lit(component)) & (F.col("initial_time") == stamp(initial_time)))
    if name is not None:
        rows = rows.filter(F.col("name") == F.lit(name))
    return rows.select("step", ts, value)


def forecast_params(windows: DataFrame, keys: Sequence[str], block: Column | None = None, ts: str = "ts") -> DataFrame:
    """Horizon, interval, count and resolution per series.

    Windows are reduced to one row each before starts are compared; `block` is an expression on
    `initial_time`.
    """
    keys = list(keys)
    each = windows.groupBy(*keys, "initial_time").agg(
        (F.max("step") + F.lit(1)).alias("__points"), F.min(ts).alias("__first"), F.max(ts).alias("__last")
    )
    gaps = previous_values(each, keys, ["initial_time"], {"__before": "initial_time"}, block)
    span = epoch_seconds("__last") - epoch_seconds("__first")
    return gaps.groupBy(*keys).agg(
        F.min("initial_time").alias("initial_timestamp"),
        F.max("__points").cast("long").alias("horizon"),
        F.min(epoch_seconds("initial_time") - epoch_seconds("__before")).alias("interval_s"),
        F.count(F.lit(1)).alias("window_count"),
        F.min(F.try_divide(span, F.col("__points") - F.lit(1))).cast("long").alias("resolution_s"),
    )


def infer_resolution(series: DataFrame, keys: Sequence[str], ts: str, block: Column | None = None) -> DataFrame:
    """Smallest step per series and the number of different steps (1 = regular).

    Differences are counted per (series, step) before the final reduction.
    """
    keys = list(keys)
    gaps = previous_values(series.select(*keys, ts), keys, [ts], {"__before": ts}, block)
    each = (
        gaps.filter(F.col("__before").isNotNull())
        .groupBy(*keys, (epoch_seconds(ts) - epoch_seconds("__before")).alias("__gap"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    return each.groupBy(*keys).agg(
        F.min("__gap").alias("resolution_s"), F.count(F.lit(1)).alias("different_steps")
    )


def attach_series(store: DataFrame, new: DataFrame, components: DataFrame, key: str = "component") -> DataFrame:
    """Add series rows of components that exist."""
    known = components.select(key)
    return store.unionByName(new.join(known, key, "left_semi"), allowMissingColumns=True)


def remove_series(store: DataFrame, kind: str, column: str = "kind") -> DataFrame:
    """All rows but those of a kind; rows without a kind stay."""
    return store.filter(~F.col(column).eqNullSafe(F.lit(kind)))


def realized(windows: DataFrame, interval_s: int, ts: str = "ts") -> DataFrame:
    """Drop look-ahead: rows with initial_time <= ts < initial_time + interval. A plain filter."""
    start = F.col("initial_time")
    return windows.filter((F.col(ts) >= start) & (F.col(ts) < plus_seconds(start, interval_s)))


def realized_timestamps(windows: DataFrame, interval_s: int, ts: str = "ts") -> DataFrame:
    return realized(windows, interval_s, ts).select(ts).distinct()


def state_series(traj: DataFrame, entity: str | int, state: str) -> DataFrame:
    return traj.filter((F.col("entity") == F.lit(entity)) & (F.col("state") == F.lit(state)))


def voltage_series(traj: DataFrame, bus: DataFrame | int, state: str = "Vm") -> DataFrame:
    """Voltage magnitude at one bus, or at all buses of a table with its columns added."""
    rows = traj.filter(F.col("state") == F.lit(state))
    if isinstance(bus, DataFrame):
        return rows.join(bus, rows["entity"] == bus["bus_id"]).drop("entity")
    return rows.filter(F.col("entity") == F.lit(bus))


def overlay_series(runs: Mapping[str, DataFrame], label: str = "run") -> DataFrame:
    parts = [df.withColumn(label, F.lit(name)) for name, df in runs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def compare_runs(
    a: DataFrame, b: DataFrame, dt: float, keys: Sequence[str] = ("entity", "state"), t: str = "t", value: str = "value"
) -> DataFrame:
    """Largest difference of the bucket means of two runs with unequal steps.

    Both runs go through one aggregation on (keys, bucket); only buckets with points of both count.
    """
    keys = list(keys)
    rows = overlay_series({"a": a.select(*keys, t, value), "b": b.select(*keys, t, value)}, "__run")
    bucket = F.floor(F.col(t) / F.lit(dt)).cast("long").alias("bucket")

    def of(run: str) -> Column:
        return F.when(F.col("__run") == run, F.col(value))

    each = rows.groupBy(*keys, bucket).agg(
        F.sum(of("a")).cast("double").alias("__sa"), F.count(of("a")).alias("__na"),
        F.sum(of("b")).cast("double").alias("__sb"), F.count(of("b")).alias("__nb"),
    )
    gap = F.abs(F.col("__sa") / F.col("__na") - F.col("__sb") / F.col("__nb"))
    return (
        each.filter((F.col("__na") > 0) & (F.col("__nb") > 0))
        .groupBy(*keys)
        .agg(F.max(gap).alias("max_abs_diff"), F.count(F.lit(1)).alias("buckets"))
    )
