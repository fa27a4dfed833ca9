"""Source tables to the component tables of one case.

The four tables are independent plans. Filters on the interconnect stand where the source
procedure puts them, Catalyst moves the branch filter below the end joins by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom import fixed
from gridloom.operators import columns as C
from gridloom.operators import filters as P
from gridloom.operators import joins as J


@dataclass(frozen=True)
class CaseTables:
    generator: DataFrame
    bus: DataFrame
    branch: DataFrame
    dc_branch: DataFrame


def assemble_generators(plant: DataFrame, gencost: DataFrame, interconnect: str | None = None) -> DataFrame:
    """Plants of an interconnect with sampled costs, unit rules, ramps per minute and names.

    Costs are sampled before the minimum output is repaired, so they see the stated minimum.
    """
    gen = J.join_gencost(P.filter_interconnect(plant, interconnect), gencost)
    gen = C.const_columns(C.pwl_cost(gen), {"fuel_price": fixed.FUEL_PRICE})
    gen = C.case_by_category(gen, "type", fixed.UNIT_RULES, fixed.UNIT_DEFAULTS)
    gen = C.ratio_columns(gen, "ramp_30", 30, "ramp_30")
    gen = C.repair_zero_pmin(gen, fixed.DISPATCHABLE_FUELS, fixed.MIN_OUTPUT_SHARE)
    return C.prefix_name(gen, "gen", "plant_id")


def assemble_buses(bus: DataFrame, zone: DataFrame, interconnect: str | None = None) -> DataFrame:
    named = J.join_zone(P.filter_interconnect(bus, interconnect), zone)
    labelled = C.code_to_label(named, "type", fixed.BUS_TYPES, "bustype")
    return C.prefix_name(P.drop_isolated(labelled), "bus", "bus_id")


def assemble_branches(branch: DataFrame, buses: DataFrame, interconnect: str | None = None) -> DataFrame:
    ends = P.filter_interconnect(J.join_branch_ends(branch, buses), interconnect)
    return C.ratio_columns(C.prefix_name(ends, "branch", "branch_id"), "from_base_kv", "to_base_kv", "tr_ratio")


def assemble_dc_branches(dcline: DataFrame, buses: DataFrame, interconnect: str | None = None) -> DataFrame:
    """DC links with both ends in the interconnect; all of them where none is asked for."""
    kept = dcline if interconnect is None else J.dcline_semi(dcline, buses)
    return C.const_columns(C.prefix_name(kept, "dcbranch", "dcline_id"), {"control_mode": fixed.CONTROL_MODE})


def assemble_case(
    plant: DataFrame, gencost: DataFrame, bus: DataFrame, zone: DataFrame, branch: DataFrame, dcline: DataFrame,
    interconnect: str | None = None,
) -> CaseTables:
    buses = assemble_buses(bus, zone, interconnect)
    return CaseTables(
        generator=assemble_generators(plant, gencost, interconnect),
        bus=buses,
        branch=assemble_branches(branch, buses, interconnect),
        dc_branch=assemble_dc_branches(dcline, buses, interconnect),
    )


def canonical_generators(generators: DataFrame, base_power: float = 100.0) -> DataFrame:
    """Canonical names, per-unit values and generator classes of assembled generators.

    Only descriptor rows whose source column is there take part.
    """
    rows = [r for r in fixed.DESCRIPTORS["generator"] if r[0] in generators.columns]
    renamed = C.apply_descriptor(generators, rows)
    units = {canonical: unit for _, canonical, unit in rows if unit == "natural_units"}
    classed = C.map_generator_class(C.convert_units(renamed, units, base_power), fixed.GENERATOR_CLASSES)
    return classed.withColumn("fuel", F.upper("fuel"))
