"""Schedules and market tables: commitment, ramps, merit order and prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.time import epoch_seconds
from gridloom.operators.ordered import draw_blocks, previous_values, running_total


def stack_offsets(
    df: DataFrame, ts: str = "ts", category: str = "category", value: str = "value", out: str = "top", block: Column | None = None
) -> DataFrame:
    """Running sum across categories at each stamp.

    Rows are summed per (stamp, category) first, so a window holds one row per category. Where categories are
    components, `block`, an expression that never falls along the category, cuts the window.
    """
    total = df.groupBy(ts, category).agg(F.sum(value).alias(value))
    if block is not None:
        return running_total(total, [ts], [category], value, block, out)
    up_to = Window.partitionBy(ts).orderBy(category).rowsBetween(Window.unboundedPreceding, 0)
    return total.withColumn(out, F.sum(value).over(up_to))


def initial_conditions(
    result: DataFrame, keys: Sequence[str], block: Column | None = None, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Value each execution starts from: the last realised value of the one before.

    `result` holds realised rows with `initial_time`; `block` is an expression on it, drawn from the data if not given.
    """
    last = result.groupBy(*keys, "initial_time").agg(F.max_by(value, ts).alias("last_value"))
    return previous_values(last, keys, ["initial_time"], {"initial_value": "last_value"}, block)


def commitment_transitions(
    on: DataFrame, keys: Sequence[str], ts: str, block: Column | None = None, status: str = "on"
) -> DataFrame:
    """Start and stop flags (0 or 1) of each row; the first row of a unit has neither."""
    both = previous_values(on, keys, [ts], {"__before": status}, block)
    now, before = F.col(status).cast("boolean"), F.col("__before").cast("boolean")
    return both.withColumns(
        {
            "start": F.coalesce(now & ~before, F.lit(False)).cast("int"),
            "stop": F.coalesce(~now & before, F.lit(False)).cast("int"),
        }
    ).drop("__before")


def commitment_runs(
    on: DataFrame,
    keys: Sequence[str],
    ts: str,
    block: Column | None,
    step_hours: float,
    limits: DataFrame | None = None,
    status: str = "on",
) -> DataFrame:
    """Lengths of the up and down runs, and whether they keep the minimum times.

    Rows become segments of equal status inside each (unit, block); one summary row per block then
    says how the segments of neighbouring blocks join up. Only segments and summaries leave the
    block. `limits(keys, min_up_time, min_down_time)` is in hours. The first and last run of a
    unit are cut by the horizon, so only inner runs count as violations. Rows without a unit, or whose stamp gives no
    block, are in no run. `block` None draws blocks from the data.
    """
    keys = list(keys)
    if block is None:
        on, block = draw_blocks(on.dropna(subset=[*keys, ts]), keys, [ts])
        block = F.lit(0) if block is None else block
    inside = Window.partitionBy(*keys, "__block").orderBy(ts)
    moved = F.coalesce((F.lag(status).over(inside) != F.col(status)).cast("long"), F.lit(0).cast("long"))
    # Dropping rows without a unit or block here keeps both uses of `segments` alike down to the shuffle, which
    # Spark then runs once.
    segments = (
        on.select(*keys, ts, status, block.alias("__block"))
        .dropna(subset=[*keys, "__block"])
        .withColumn("__moved", moved)
        .withColumn("__part", F.sum("__moved").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__block", "__part", status)
        .agg(F.min(ts).alias("run_start"), F.max(ts).alias("run_end"), F.count(F.lit(1)).alias("steps"))
    )
    by_unit = Window.partitionBy(*keys)
    over = by_unit.orderBy("__block")
    so_far = over.rowsBetween(Window.unboundedPreceding, 0)
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    joint = F.coalesce((F.lag("__last").over(over) != F.col("__first")).cast("long"), F.lit(0).cast("long"))
    summary = (
        segments.groupBy(*keys, "__block")
        .agg(
            F.max("__part").alias("__moves"),
            F.min_by(status, "__part").alias("__first"),
            F.max_by(status, "__part").alias("__last"),
        )
        .withColumn("__joint", joint)
        .withColumn("__base", F.sum("__joint").over(so_far) + F.coalesce(F.sum("__moves").over(earlier), F.lit(0)))
        .withColumn("__final", F.max(F.col("__base") + F.col("__moves")).over(by_unit))
        .select(*keys, "__block", "__base", "__final")
    )
    runs = (
        segments.join(summary, [*keys, "__block"])
        .withColumn("run", F.col("__base") + F.col("__part"))
        .groupBy(*keys, "run", status)
        .agg(
            F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"),
            F.sum("steps").alias("steps"), F.max("__final").alias("__final"),
        )
        .withColumn("hours", F.col("steps") * F.lit(step_hours))
    )
    if limits is None:
        return runs.drop("__final")
    needed = F.when(F.col(status).cast("boolean"), F.col("min_up_time")).otherwise(F.col("min_down_time"))
    inner = (F.col("run") > 0) & (F.col("run") < F.col("__final"))
    return (
        runs.join(limits.select(*keys, "min_up_time", "min_down_time"), keys, "left")
        .withColumn("violates", F.coalesce(inner & (F.col("hours") < needed), F.lit(False)).cast("int"))
        .select(*keys, "run", status, "run_start", "run_end", "steps", "hours", "violates")
    )


def ramp_check(
    realized: DataFrame,
    limits: DataFrame,
    keys: Sequence[str],
    ts: str,
    block: Column | None = None,
    value: str = "value",
) -> DataFrame:
    """Step change of the realised series against `limits(keys, ramp_limit)` per minute.

    The series crosses execution borders, so the step between the last period of one run and
    the first of the next is checked like any other.
    """
    both = previous_values(realized, keys, [ts], {"__value": value, "__ts": ts}, block)
    minutes = (epoch_seconds(ts) - epoch_seconds("__ts")) / F.lit(60)
    step = F.abs(F.col(value) - F.col("__value"))
    return (
        both.filter(F.col("__ts").isNotNull())
        .select(*keys, ts, step.alias("step"), minutes.alias("minutes"))
        .join(limits.select(*keys, "ramp_limit"), list(keys))
        .withColumn("violates", (F.col("step") > F.col("ramp_limit") * F.col("minutes")).cast("int"))
    )


def offer_stack(
    offer: DataFrame, interval: Sequence[str], unit: str, band: Column | None = None, price: str = "price", pmax: str = "pmax"
) -> DataFrame:
    """Offers of each market interval with the running quantity `cum`, cheapest first.

    `band` is a block expression that never falls along (price, unit); without one, intervals with many offers are
    cut at (price, unit) pairs drawn from the offers.
    """
    return running_total(offer, interval, [price, unit], pmax, band, "cum")


def merit_order_dispatch(
    offer: DataFrame,
    demand: DataFrame,
    interval: Sequence[str],
    unit: str,
    band: Column | None = None,
    price: str = "price",
    pmax: str = "pmax",
) -> DataFrame:
    """Clear `demand(interval, demand)` against the offers of the same interval, cheapest first.

    Offers are a series: one row per interval and unit, or per interval, unit and step of a bid curve (see
    `bid_steps`), as many rows out as in. Exact for one node without minimum outputs, ramps or commitment.
    """
    below = F.col("cum") - F.col(pmax)
    zero = F.lit(0).cast("decimal(1,0)")
    power = F.greatest(zero, F.least(F.col(pmax), F.col("demand") - below))
    return (
        offer_stack(offer, interval, unit, band, price, pmax)
        .join(demand, list(interval))
        .select(*interval, unit, price, pmax, power.alias("power"))
    )


def bid_steps(bids: DataFrame, keys: Sequence[str], points: str = "points", step: str = "step") -> DataFrame:
    """Piecewise bids to offer steps: (keys, step, price, pmax).

    `points` is an array of (cost, power) in rising power, per unit and interval, so that a curve may change from
    interval to interval. A step goes from one point to the next; its price is the slope. The first step starts at
    zero power with the first point's average cost; steps without width are left out. A bid of one
    step per key has the key as its unit; for curves use (key, step) as the unit.
    """
    steps = F.transform(
        F.col(points),
        lambda p, i: F.struct(
            i.cast("int").alias(step),
            F.try_divide(p["cost"] - F.when(i == 0, F.lit(0)).otherwise(F.get(points, i - 1)["cost"]), p["power"] - F.when(i == 0, F.lit(0)).otherwise(F.get(points, i - 1)["power"])).alias("price"),
            (p["power"] - F.when(i == 0, F.lit(0)).otherwise(F.get(points, i - 1)["power"])).alias("pmax"),
        ),
    )
    return bids.select(*keys, F.inline(F.filter(steps, lambda s: s["pmax"] > 0)))


def unserved_demand(offer: DataFrame, demand: DataFrame, interval: Sequence[str], pmax: str = "pmax") -> DataFrame:
    """Demand above the total of the interval's offers."""
    total = offer.groupBy(*interval).agg(F.sum(pmax).alias("__total"))
    zero = F.lit(0).cast("decimal(1,0)")
    short = F.greatest(zero, F.col("demand") - F.coalesce(F.col("__total"), zero))
    return demand.join(total, list(interval), "left").select(*interval, "demand", short.alias("unserved"))


def clearing_price(
    offer: DataFrame,
    demand: DataFrame,
    interval: Sequence[str],
    unit: str,
    penalty: float,
    band: Column | None = None,
    price: str = "price",
    pmax: str = "pmax",
) -> DataFrame:
    """Price of the first unit whose running quantity covers demand, the penalty if none does.

    Totals per block find the one block of an interval in which demand is met; only its rows are windowed. Without
    `band`, intervals with many offers are cut as in `offer_stack`; if there are none, an interval is one window.
    """
    interval = list(interval)
    if band is None:
        offer, band = draw_blocks(offer, interval, [price, unit])
    inside = Window.partitionBy(*interval).orderBy(price, unit).rowsBetween(Window.unboundedPreceding, 0)
    if band is None:
        rows = offer.select(*interval, price, F.sum(pmax).over(inside).alias("__sum")).join(demand.select(*interval, F.col("demand").alias("__left")), interval)
    else:
        rows = _crossing_rows(offer, demand, interval, band, pmax).withColumn("__sum", F.sum(pmax).over(inside))
    marginal = rows.where(F.col("__sum") >= F.col("__left")).groupBy(*interval).agg(F.min(price).alias("__price"))
    return demand.join(marginal, interval, "left").select(
        *interval, "demand", F.coalesce(F.col("__price").cast("double"), F.lit(float(penalty))).alias("clearing_price")
    )


def _crossing_rows(offer: DataFrame, demand: DataFrame, interval: list[str], band: Column, pmax: str) -> DataFrame:
    """The offers of the block of each interval in which demand is met, with what is `__left` to meet there."""
    blocked = offer.withColumn("__block", band)
    up_to = Window.partitionBy(*interval).orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    totals = blocked.groupBy(*interval, "__block").agg(F.sum(pmax).alias("__own")).withColumn("__cum", F.sum("__own").over(up_to))
    met = totals.join(demand, interval).where(F.col("__cum") >= F.col("demand"))
    crossing = met.groupBy(*interval).agg(F.min("__block").alias("__block"), F.min_by(F.col("demand") - (F.col("__cum") - F.col("__own")), "__block").alias("__left"))
    return blocked.join(crossing, [*interval, "__block"])
