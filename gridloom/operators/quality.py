"""Data checks and the dataset catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_names(components: DataFrame, keys: Sequence[str] = ("comp_type", "name")) -> DataFrame:
    return components.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unknown_codes(df: DataFrame, code: str, known: Sequence[object]) -> DataFrame:
    """Codes that the table of labels lacks, with their number of rows; null is no code and counts too."""
    strange = ~F.coalesce(F.col(code).isin(list(known)), F.lit(False))
    return df.filter(strange).groupBy(code).agg(F.count(F.lit(1)).alias("n"))


def range_violations(df: DataFrame, key: str, rules: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values outside `{field: (min, max)}`; None leaves a side open. One pass, no shuffle."""
    checks = F.array(
        *[
            F.struct(
                F.lit(field).alias("field"),
                F.col(field).cast("double").alias("value"),
                F.lit(low).cast("double").alias("min_value"),
                F.lit(high).cast("double").alias("max_value"),
            )
            for field, (low, high) in rules.items()
        ]
    )
    below = F.coalesce(F.col("value") < F.col("min_value"), F.lit(False))
    above = F.coalesce(F.col("value") > F.col("max_value"), F.lit(False))
    return df.select(key, F.inline(checks)).filter(below | above)


def dangling_ends(branch: DataFrame, bus: DataFrame, key: str = "branch_id", bus_id: str = "bus_id") -> DataFrame:
    """Branch ends with no bus: both ends as rows, one anti join."""
    ends = branch.select(
        key,
        F.inline(
            F.array(
                F.struct(F.lit("from").alias("end"), F.col("from_bus_id").alias(bus_id)),
                F.struct(F.lit("to").alias("end"), F.col("to_bus_id").alias(bus_id)),
            )
        ),
    )
    return ends.join(bus.select(bus_id), bus_id, "left_anti").select(key, "end", bus_id)


def approx_equal(
    a: DataFrame, b: DataFrame, keys: Sequence[str], value: str = "value", rtol: float = 1e-8
) -> DataFrame:
    """Row-wise comparison within a relative tolerance; a row missing on one side is not equal."""
    keys = list(keys)
    left = a.select(*keys, F.col(value).alias("a_value"))
    right = b.select(*keys, F.col(value).alias("b_value"))
    x, y = F.col("a_value"), F.col("b_value")
    close = F.abs(x - y) <= F.lit(rtol) * F.greatest(F.abs(x), F.abs(y))
    return left.join(right, keys, "full").withColumn("equal", F.coalesce(close, F.lit(False)))


def list_datasets(catalog: DataFrame, category: str | None = None) -> DataFrame:
    """The datasets (category, name) of a catalogue, all or those of one category."""
    rows = catalog if category is None else catalog.filter(F.col("category") == F.lit(category))
    return rows.select("category", "name")


def dataset_counts(catalog: DataFrame) -> DataFrame:
    """Number of datasets per category."""
    return catalog.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
