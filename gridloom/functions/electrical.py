"""Unit conversion, cost sampling and admittance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_per_unit(value: Column, base_power: float) -> Column:
    return value / F.lit(float(base_power))


def device_to_system_base(value: Column, device_base: Column, base_power: float) -> Column:
    return value * device_base / F.lit(float(base_power))


def sampled_cost(share: Column, pmax: Column, c0: Column, c1: Column, c2: Column) -> Column:
    """Cost at a share of Pmax. The square on c2 is the source data's own convention."""
    return share * pmax * (c1 + c2 * c2) + c0


def series_admittance(r: Column, x: Column) -> tuple[Column, Column]:
    """(g, b) of 1/(r + jx); null where r = x = 0."""
    square = r * r + x * x
    return F.try_divide(r, square), F.try_divide(-x, square)
