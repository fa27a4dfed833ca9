"""Values fixed by the input formats and the source data set."""

from __future__ import annotations

# Bus type codes of the bus table.
BUS_TYPES = {1: "PV", 2: "PQ", 3: "REF", 4: "ISOLATED"}

# Bus type codes of raw grid files (code 1 is a load bus there).
RAW_BUS_TYPES = {1: "PQ", 2: "PV", 3: "REF", 4: "ISOLATED"}

# Unit type, minimum up time and minimum down time (hours) by fuel.
UNIT_RULES = {
    "wind": {"unit_type": "Wind", "min_up_time": 0.0, "min_down_time": 0.0},
    "solar": {"unit_type": "PV", "min_up_time": 0.0, "min_down_time": 0.0},
    "hydro": {"unit_type": "HY", "min_up_time": 0.0, "min_down_time": 0.0},
    "ng": {"min_up_time": 4.5, "min_down_time": 8.0},
    "coal": {"min_up_time": 24.0, "min_down_time": 48.0},
    "nuclear": {"min_up_time": 72.0, "min_down_time": 72.0},
}
UNIT_DEFAULTS = {"unit_type": "OT", "min_up_time": 0.0, "min_down_time": 0.0}

# Fuels that need a minimum output, and the share of Pmax given to them.
DISPATCHABLE_FUELS = ["ng", "coal", "hydro", "nuclear"]
MIN_OUTPUT_SHARE = 0.05

# Fuel price column and dc-line control mode.
FUEL_PRICE = 1000.0
CONTROL_MODE = "Power"

# Generator class by (fuel, unit type); None stands for any unit type.
GENERATOR_CLASSES = [
    ("HydroEnergyReservoir", "HYDRO", "INFLOW"),
    ("HydroDispatch", "HYDRO", "ROR"),
    ("HydroDispatch", "HYDRO", None),
    ("HydroDispatch", "HYDRO", "HYDRO"),
    ("RenewableDispatch", "SOLAR", "PV"),
    ("RenewableDispatch", "SOLAR", "UN"),
    ("RenewableDispatch", "SOLAR", None),
    ("RenewableDispatch", "WIND", "WIND"),
    ("RenewableDispatch", "WIND", None),
    ("RenewableDispatch", "SOLAR", "CSP"),
    ("RenewableFix", "SOLAR", "RTPV"),
    ("ThermalStandard", "OIL", None),
    ("ThermalStandard", "COAL", None),
    ("ThermalStandard", "NG", None),
    ("ThermalStandard", "GAS", None),
    ("ThermalStandard", "NUCLEAR", None),
    ("ThermalStandard", "NUC", None),
    ("ThermalStandard", "SYNC_COND", "SYNC_COND"),
    ("ThermalStandard", "OTHER", "OT"),
    ("ThermalStandard", "DFO", None),
    ("GenericBattery", "STORAGE", None),
]

# Source column, canonical column and unit, by table.
DESCRIPTORS = {
    "branch": [
        ("name", "name", None),
        ("from_bus_id", "connection_points_from", None),
        ("to_bus_id", "connection_points_to", None),
        ("r", "r", "device_base"),
        ("x", "x", "device_base"),
        ("b", "primary_shunt", "device_base"),
        ("rateA", "rate", "natural_units"),
        ("tr_ratio", "tap", None),
    ],
    "bus": [
        ("bus_id", "bus_id", None),
        ("name", "name", None),
        ("interconnect", "zone", None),
        ("zone_name", "area", None),
        ("baseKV", "base_voltage", None),
        ("bustype", "bus_type", None),
        ("Vm", "voltage", "device_base"),
        ("Va", "angle", "degree"),
        ("Gs", "mw_shunt_g", None),
        ("Bs", "mvar_shut_b", None),
        ("Pd", "max_active_power", "natural_units"),
        ("Qd", "max_reactive_power", "natural_units"),
        ("Pd", "active_power", "natural_units"),
        ("Qd", "reactive_power", "natural_units"),
    ],
    "dc_branch": [
        ("name", "name", None),
        ("from_bus_id", "connection_points_from", None),
        ("to_bus_id", "connection_points_to", None),
        ("Pmax", "mw_load", None),
        ("loss1", "loss", None),
        ("control_mode", "control_mode", None),
    ],
    "generator": [
        ("name", "name", None),
        ("bus_id", "bus_id", None),
        ("type", "fuel", None),
        ("unit_type", "unit_type", None),
        ("fuel_price", "fuel_price", None),
        ("Pg", "active_power", "natural_units"),
        ("Qg", "reactive_power", "natural_units"),
        ("Pmax", "active_power_limits_max", "natural_units"),
        ("Pmin", "active_power_limits_min", "natural_units"),
        ("Qmax", "reactive_power_limits_max", "natural_units"),
        ("ramp_30", "ramp_limits", "natural_units"),
        ("heat_rate_avg_0", "heat_rate_avg_0", None),
        ("heat_rate_incr_1", "heat_rate_incr_1", None),
        ("heat_rate_incr_2", "heat_rate_incr_2", None),
        ("output_point_0", "output_point_0", "device_base"),
        ("output_point_1", "output_point_1", "device_base"),
        ("output_point_2", "output_point_2", "device_base"),
        ("mBase", "base_mva", None),
        ("shutdown", "shutdown_cost", None),
        ("startup", "startup_cost", None),
        ("min_down_time", "min_down_time", None),
        ("min_up_time", "min_up_time", None),
    ],
}

# Price of unserved energy.
UNSERVED_PENALTY = 100000.0

# Section order of version-33 raw grid files.
RAW_SECTIONS = [
    "bus", "load", "fixed_shunt", "generator", "branch", "transformer", "area",
    "two_terminal_dc", "vsc_dc", "impedance_correction", "multi_terminal_dc",
    "multi_section_line", "zone", "inter_area_transfer", "owner", "facts",
    "switched_shunt", "gne", "induction_machine",
]
