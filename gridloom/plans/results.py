"""Forecast windows to realised totals, and duals to nodal prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import fixed
from gridloom.operators import aggregates as A
from gridloom.operators import columns as C
from gridloom.operators import filters as P
from gridloom.operators import network as N
from gridloom.operators import series as S


def realized_by_fuel(
    result: DataFrame,
    plant: DataFrame,
    interval_s: int,
    interconnect: str | None = None,
) -> DataFrame:
    """Realised output per stamp and fuel of one interconnect, with the unit rules of the fuel."""
    gen = P.filter_interconnect(plant, interconnect)
    gen = C.case_by_category(gen, "type", fixed.UNIT_RULES, fixed.UNIT_DEFAULTS)
    units = gen.select("plant_id", F.concat_ws("/", "type", "unit_type").alias("fuel"))
    return A.generation_by_fuel(S.realized(result, interval_s), units)


def nodal_prices(points: DataFrame, energy: DataFrame, dual: DataFrame, ptdf: DataFrame) -> DataFrame:
    """Prices at (ts, bus) points from the energy price, the flow duals and the transfer factors."""
    return N.lmp(points, energy, dual, ptdf)
