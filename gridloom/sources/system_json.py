"""Serialised systems: documents with `data.components[]`, one type label per component."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.session import shuffle_width
from gridloom.sources.split_lines import carried, read_lines, stored

_REF = "struct<value: string>"
_LIMITS = "struct<min: double, max: double>"
_INTERNAL = "internal struct<uuid: struct<value: string>>"

_GENERATOR = (
    f"name string, available boolean, bus {_REF}, active_power double, reactive_power double, rating double, "
    f"prime_mover string, base_power double, {_INTERNAL}"
)

# Fields read per component type; nested models of dynamic devices stay JSON text.
COMPONENT_FIELDS = {
    "Bus": f"name string, number long, bustype string, angle double, magnitude double, voltage_limits {_LIMITS}, "
    f"base_voltage double, area {_REF}, load_zone {_REF}, {_INTERNAL}",
    "Arc": f"`from` {_REF}, to {_REF}, {_INTERNAL}",
    "Line": f"name string, available boolean, active_power_flow double, reactive_power_flow double, arc {_REF}, "
    f"r double, x double, b struct<`from`: double, to: double>, rate double, angle_limits {_LIMITS}, {_INTERNAL}",
    "PowerLoad": f"name string, available boolean, bus {_REF}, model string, active_power double, "
    f"reactive_power double, base_power double, max_active_power double, max_reactive_power double, {_INTERNAL}",
    "ThermalStandard": f"name string, available boolean, status boolean, bus {_REF}, active_power double, "
    f"reactive_power double, rating double, active_power_limits {_LIMITS}, reactive_power_limits {_LIMITS}, "
    f"ramp_limits struct<up: double, down: double>, base_power double, fuel string, prime_mover string, "
    f"dynamic_injector {_REF}, {_INTERNAL}",
    "Source": f"name string, available boolean, bus {_REF}, active_power double, reactive_power double, R_th double, "
    f"X_th double, internal_voltage double, internal_angle double, {_INTERNAL}",
    "DynamicGenerator": "name string, n_states int, states array<string>, base_power double, V_ref double, P_ref double, w_ref double, "
    f"machine string, shaft string, avr string, prime_mover string, pss string, {_INTERNAL}",
    "DynamicInverter": "name string, n_states int, states array<string>, base_power double, w_ref double, converter string, "
    f"outer_control string, inner_control string, dc_source string, freq_estimator string, filter string, {_INTERNAL}",
    "HydroDispatch": f"{_GENERATOR}",
    "HydroEnergyReservoir": f"{_GENERATOR}, storage_capacity double, inflow double, initial_storage double",
    "RenewableDispatch": f"{_GENERATOR}, power_factor double",
    "RenewableFix": f"{_GENERATOR}, power_factor double",
    "GenericBattery": f"{_GENERATOR}, initial_energy double, state_of_charge_limits {_LIMITS}",
    "VariableReserve": f"name string, available boolean, time_frame double, requirement double, {_INTERNAL}",
    "StaticReserve": f"name string, available boolean, time_frame double, requirement double, {_INTERNAL}",
    "MonitoredLine": f"name string, available boolean, arc {_REF}, r double, x double, b struct<`from`: double, to: double>, rate double, {_INTERNAL}",
    "Transformer2W": f"name string, available boolean, arc {_REF}, r double, x double, primary_shunt double, rate double, {_INTERNAL}",
    "TapTransformer": f"name string, available boolean, arc {_REF}, r double, x double, primary_shunt double, tap double, rate double, {_INTERNAL}",
    "FixedAdmittance": f"name string, available boolean, bus {_REF}, {_INTERNAL}",
    "Area": f"name string, peak_active_power double, peak_reactive_power double, load_response double, {_INTERNAL}",
    "LoadZone": f"name string, peak_active_power double, peak_reactive_power double, {_INTERNAL}",
}

_SETTINGS = "frequency double, units_settings struct<base_value: double, unit_system: string>"
_DOCUMENT = f"data struct<components: array<string>>, {_SETTINGS}"


def system_components(cases: DataFrame) -> DataFrame:
    """(case_id, comp_type, name, body) of `cases(case_id, text)`; the body stays JSON text.

    The document's type is given, so no inference pass runs and component types cannot clash.
    """
    bodies = cases.select("case_id", F.from_json("text", _DOCUMENT).alias("doc")).select("case_id", F.explode_outer("doc.data.components").alias("body"))
    return _labelled(bodies.where(F.col("body").isNotNull()))


def _labelled(bodies: DataFrame) -> DataFrame:
    label = F.from_json("body", "__metadata__ struct<type: string>, name string").alias("label")
    return bodies.select("case_id", label, "body").select("case_id", F.col("label.__metadata__.type").alias("comp_type"), F.col("label.name").alias("name"), "body")


def system_settings(cases: DataFrame) -> DataFrame:
    """One row per case: base power, unit system and frequency."""
    return cases.select("case_id", F.from_json("text", _SETTINGS).alias("doc")).select(
        "case_id",
        F.col("doc.units_settings.base_value").alias("base_power"),
        F.col("doc.units_settings.unit_system").alias("unit_system"),
        F.col("doc.frequency").alias("frequency"),
    )


def component_tables(components: DataFrame, fields: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """One typed table per component type, and under `*` the components (case_id, comp_type, name, body) of all other types.

    `fields` are schemas by type; types may be added to the known ones by passing `COMPONENT_FIELDS | own`.
    """
    wanted = fields or COMPONENT_FIELDS
    typed = {
        name: components.filter(F.col("comp_type") == name)
        .select("case_id", F.from_json("body", spec).alias("c"))
        .select("case_id", "c.*")
        for name, spec in wanted.items()
    }
    return typed | {"*": components.filter(~F.coalesce(F.col("comp_type").isin(list(wanted)), F.lit(False)))}


def nested_model(table: DataFrame, column: str) -> DataFrame:
    """(case_id, name, model, body) of a nested model of dynamic devices: its own type and its JSON text."""
    kind = F.get_json_object(column, "$.__metadata__.type")
    return table.where(F.col(column).isNotNull()).select("case_id", "name", kind.alias("model"), F.col(column).alias("body"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, text) of serialised systems, a document per file, which one row holds."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("case_id"), F.col("value").alias("text"))


# The lines of a written document: its opening, which no component can look like, and its end.
_OPENING = '"data":{"components":['
_END = "]}}"
#: Blank lines behind a document, or a part of one: no component leaves them, as only the last one of a case has no comma.
_MARK = "\n\t\n\t"
#: Components of a part at most, which one row holds; and of a row of a document that is laid out by many tasks.
PART = 4096
ROW = 16


def _document_parts(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, opening, bodies) of the documents, or parts of documents, that `write_system_json` wrote.

    A file is read in splits. A document in one part names its case; only parts of others are moved, to take the case of the
    last opening before them.
    """
    read = spark.read.text(path, recursiveFileLookup=True, lineSep=f"{_MARK}\n")
    lines = F.split(F.replace("value", F.lit(",\n"), F.lit("\n")), "\n")
    opens, ends = F.substring_index("value", "\n", 1).endswith(_OPENING), F.col("value").endswith(f"\n{_END}")
    opening = F.when(opens, F.concat(F.substring_index("value", "\n", 1), F.lit(_END)))
    first, last = F.when(opens, 2).otherwise(1), F.when(ends, 1).otherwise(0)
    bodies = F.slice(lines, first, F.size(lines) - last - first + 1)
    parts = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
        (opens & ends).alias("whole"), ends.alias("ends"), opening.alias("opening"), bodies.alias("bodies"),
    )
    case = F.get_json_object("opening", "$.case_id")
    whole = parts.where("whole").select(case.alias("case_id"), "opening", "bodies")
    # the last line of a piece keeps its comma, as no line feed follows
    cut = F.when(F.col("ends"), F.col("bodies")).otherwise(F.transform("bodies", lambda b: F.regexp_replace(b, ",$", "")))
    rest = stored(parts.where("not whole").withColumn("bodies", cut), "pieces")
    pieces = carried(rest, F.when(F.col("opening").isNotNull(), F.struct(case.alias("case_id"))), "case")
    return whole.unionByName(pieces.select("case.case_id", "opening", "bodies"))


def read_system_json(spark: SparkSession, path: str, one_per_line: bool = False, fields: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Serialised cases to component tables; all components under one roof as `components`, settings as `settings`.

    A document per file, or with `one_per_line` a component per line, as `write_system_json` writes documents; these
    are read in splits, so that a case of any size is read by many tasks. Components are parsed once: they are
    stored in the shared folder by type, so that a type's table reads only its own.
    """
    if one_per_line:
        parts = _document_parts(spark, path)
        components = _labelled(parts.select("case_id", F.explode("bodies").alias("body")))
        settings = system_settings(parts.where(F.col("opening").isNotNull()).select("case_id", F.col("opening").alias("text")))
    else:
        cases = read_documents(spark, path)
        components, settings = system_components(cases), system_settings(cases)
    components = components.withColumn("comp_type", F.coalesce("comp_type", F.lit(""))).select("case_id", "name", "body", "comp_type")
    kept = stored(components, "system-components", "comp_type")
    return component_tables(kept, fields) | {"components": kept, "settings": settings}


def write_system_json(components: DataFrame, settings: DataFrame, path: str, force: bool = False, compression: str | None = None) -> None:
    """Systems as documents that `read_system_json` reads again with `one_per_line`; `force` overwrites.

    `compression` names a codec of Spark's text writer, such as `lz4`; the text is the same. A compressed file is read by
    one task, so there are as many readers at most as there were writers.

    `components(case_id, body)` are JSON objects, each with its type in `__metadata__.type`;
    `settings(case_id, base_power, unit_system, frequency)`, a row per case. A document is an opening line, a line for
    each component, and a closing line, and blank lines; the files of the folder, read one after the other, are the documents of all
    cases. Components of a case that stand in one block of the input are a part of its document, which one row holds. Cases of
    one part are written where they lie; the parts of others are laid out by ranges of (case, place), so that a case of any size is
    written by many tasks. A case without components is written too; components of a case without settings are left out. A line
    feed between the tokens of a component becomes a blank.
    """
    place = F.monotonically_increasing_id()
    head = F.to_json(F.struct(F.col("case_id"), "frequency", F.struct(F.col("base_power").alias("base_value"), "unit_system").alias("units_settings")))
    heads = settings.select("case_id", F.concat(F.regexp_replace(head, r"\}$", ","), F.lit(_OPENING)).alias("head"))
    # a case with several rows of settings has its components in one document, and empty ones beside it
    heads = stored(heads.withColumn("copy", F.row_number().over(Window.partitionBy("case_id").orderBy("head"))), "heads")
    first = heads.where("copy = 1").select("case_id", "head")
    one_line = F.replace(F.replace("body", F.lit("\r\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    numbered = components.select("case_id", one_line.alias("body"), place.alias("place")).where(F.col("body").isNotNull() & F.col("case_id").isNotNull())
    blocks = numbered.groupBy("case_id", F.floor(F.col("place") / PART).alias("block"))
    parts = blocks.agg(F.sort_array(F.collect_list(F.struct("place", "body")))["body"].alias("bodies"))
    parts = stored(parts.join(first, "case_id"), "parts")
    cases = parts.groupBy("case_id").agg(F.count(F.lit(1)).alias("parts"), F.max("block").alias("block"))
    several = stored(cases.where("parts > 1").select("case_id", F.col("block").alias("last")), "several")
    order = ["case_id", "block", "nth"]
    document = F.concat("head", F.lit("\n"), F.array_join("bodies", ",\n"), F.lit(f"\n{_END}{_MARK}"))
    empty = F.concat("head", F.lit(f"\n{_END}{_MARK}"))
    lines = parts.join(several, "case_id", "left_anti").select(document.alias("value"))
    lines = lines.unionByName(heads.join(cases.select("case_id", F.lit(1).alias("copy")), ["case_id", "copy"], "left_anti").select(empty.alias("value")))
    if not several.isEmpty():
        chunk = F.floor((F.size("bodies") - 1) / ROW)
        texts = F.transform(F.sequence(F.lit(0).cast("long"), chunk), lambda i: F.array_join(F.slice("bodies", (i * ROW + 1).cast("int"), ROW), ",\n"))
        last = (F.col("block") == F.col("last")) & (F.col("nth") == F.col("end"))
        value = F.concat("text", F.when(last, F.lit(f"\n{_END}")).otherwise(F.lit(",")), F.lit(_MARK))
        opened = several.join(first, "case_id").select("case_id", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("nth"), F.concat("head", F.lit(_MARK)).alias("value"))
        rows = parts.join(several, "case_id")
        rows = rows.select("case_id", "block", "last", chunk.alias("end"), F.posexplode(texts).alias("nth", "text")).select(*order, value.alias("value"))
        rows = rows.unionByName(opened).repartitionByRange(shuffle_width(settings.sparkSession), *order).sortWithinPartitions(*order)
        lines = lines.unionByName(rows.select("value"))
    lines.write.mode("overwrite" if force else "errorifexists").text(path, compression=compression)


def write_component_folder(components: dict[str, DataFrame], path: str, force: bool = False) -> None:
    """Component tables to JSON, one folder per type, for reading single types; `force` overwrites."""
    rows = [
        df.select(F.lit(name).alias("comp_type"), F.to_json(F.struct(*df.columns)).alias("body"))
        for name, df in components.items()
    ]
    mode = "overwrite" if force else "errorifexists"
    reduce(DataFrame.unionByName, rows).write.mode(mode).partitionBy("comp_type").json(path)


def read_component_folder(spark: SparkSession, path: str, comp_type: str, schema: str) -> DataFrame:
    """One type of a folder written by `write_component_folder`; only its partition is read."""
    rows = spark.read.schema("body string, comp_type string").json(path)
    return rows.filter(F.col("comp_type") == comp_type).select(F.from_json("body", schema).alias("c")).select("c.*")
