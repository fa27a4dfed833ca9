"""Folders of raw grid files (version 33) and dynamic-model files, of any number and size.

Files are read as lines in splits. A line's section is the number of end marks before it, its position the number of
data lines before it in its section: sums inside a split, then over the splits of a file. The records are stored by
section, so a section's table reads only its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.fixed import RAW_BUS_TYPES, RAW_SECTIONS
from gridloom.functions.lookup import look_up
from gridloom.sources.split_lines import numbered, read_lines, running, stored, with_states

# Three header lines, and the line that ends a section.
_HEADER_LINES = 3
_END = r"^[ \t]*0[ \t]*(?:/.*)?$"
# A `/` outside quotes begins a remark. The runs are possessive: no step back, so no limit on a line's length.
_COMMENT = r"^((?:[^'/]++|'[^']*+')*+)/.*$"

_OWNERS = ", ".join(f"owner{i} int, share{i} double" for i in range(1, 5))

# Field order of the records; writers may leave the tail out.
HEADER_FIELDS = "change_code int, base_mva double, revision int, transformer_units int, bypass_units int, frequency double"
SECTION_FIELDS = {
    "bus": "bus_number long, bus_name string, base_kv double, bus_type int, area int, zone int, owner int, "
    "vm double, va double, normal_vmax double, normal_vmin double, emergency_vmax double, emergency_vmin double",
    "load": "bus_number long, load_id string, status int, area int, zone int, pl double, ql double, ip double, "
    "iq double, yp double, yq double, owner int, scale int, intrpt int",
    "fixed_shunt": "bus_number long, shunt_id string, status int, gl double, bl double",
    "generator": "bus_number long, machine_id string, pg double, qg double, qt double, qb double, vs double, "
    "ireg long, mbase double, zr double, zx double, rt double, xt double, gtap double, status int, rmpct double, "
    f"pt double, pb double, {_OWNERS}, wind_mode int, wind_power_factor double",
    "branch": "from_bus long, to_bus long, circuit string, r double, x double, b double, rate_a double, "
    "rate_b double, rate_c double, gi double, bi double, gj double, bj double, status int, metered int, "
    f"length double, {_OWNERS}",
    "area": "area int, swing_bus long, net_interchange double, tolerance double, area_name string",
    "zone": "zone int, zone_name string",
}


def _winding(n: int) -> str:
    names = f"winding{n} double, nominal{n} double, angle{n} double, rate_a{n} double, rate_b{n} double, rate_c{n} double, control{n} int, controlled_bus{n} long"
    return names + f", upper{n} double, lower{n} double, vmax{n} double, vmin{n} double, positions{n} int, table{n} int, compensation_r{n} double, compensation_x{n} double"


# The lines of a transformer; the fifth only where there is a third bus.
TRANSFORMER_FIELDS = [
    "from_bus long, to_bus long, third_bus long, circuit string, cw int, cz int, cm int, mag1 double, mag2 double, "
    f"nmetr int, transformer_name string, status int, {_OWNERS}, vector_group string",
    "r12 double, x12 double, sbase12 double, r23 double, x23 double, sbase23 double, r31 double, x31 double, sbase31 double, "
    "star_vm double, star_va double",
    *(_winding(n) for n in (1, 2, 3)),
]


def _fields(line: Column, spec: str) -> Column:
    """Comma-separated fields with `'` quotes; missing tails and blanks are null, padding is trimmed.

    What cannot be read as the field's type is null, and stands as `name=text` in `bad_fields`.
    """
    pairs = [p.split() for p in spec.split(",")]
    as_text = ", ".join(f"{name} string" for name, _ in pairs)
    options = {"quote": "'", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}

    def typed(raw: Column) -> Column:
        values = [part for name, kind in pairs for part in (F.lit(name), F.trim(raw[name]).try_cast(kind))]
        bad = F.array(*(F.when((F.trim(raw[n]) != "") & F.trim(raw[n]).try_cast(k).isNull(), F.concat(F.lit(f"{n}="), raw[n])) for n, k in pairs))
        return F.named_struct(*values, F.lit("bad_fields"), F.filter(bad, lambda b: b.isNotNull()))

    return F.transform(F.array(F.from_csv(line, as_text, options)), typed)[0]


def raw_headers(lines: DataFrame) -> DataFrame:
    """(case_id, base_mva, revision, frequency ..) from the first line of each file."""
    first = lines.where("line = 1").select(F.col("file").alias("case_id"), _fields(F.col("value"), HEADER_FIELDS).alias("header"))
    return first.select("case_id", "header.*")


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their number in the file, without remarks; `ends` says whether a line ends a section.

    A line's place in its split is its number there, so they are not sorted.
    """
    plain = F.trim(F.regexp_replace("value", _COMMENT, "$1"))
    lines = stored(lines.select("file", "split", "at", F.col("value").rlike(_END).alias("ends"), plain.alias("value")), "raw-lines")
    return numbered(lines, "at", "line").withColumn("ends", F.col("ends") & (F.col("line") > _HEADER_LINES))


def _records(lines: DataFrame) -> DataFrame:
    """(section, case_id, position, lines): a line per record, of transformers four or five.

    The length of a transformer follows from its first line, so a line begins one or not depending on all lines
    before it: an automaton that counts the lines left of the present one.
    """
    names = F.array(*map(F.lit, RAW_SECTIONS))
    is_data = (F.col("line") > _HEADER_LINES) & ~F.col("ends") & ~F.col("value").isin("", "Q")
    inside = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    data = running(lines.withColumn("nth", F.sum(is_data.cast("long")).over(inside)), F.col("ends"), "number").where(is_data)
    data = data.select("file", "split", "nth", "value", F.try_element_at(names, (F.col("number") + 1).cast("int")).alias("section")).where(F.col("section").isNotNull())
    data = numbered(stored(data, "raw-data", "section"), "nth", "position", ["file", "section"])
    one = data.where("section <> 'transformer'").select("section", F.col("file").alias("case_id"), "position", F.array("value").alias("lines"))
    third = F.trim(F.try_element_at(F.split("value", ","), F.lit(3)))
    more = F.when(F.coalesce(third, F.lit("")).isin("0", ""), 3).otherwise(4)
    step = F.array(*(F.struct((more if s == 0 else F.lit(s - 1)).alias("to"), F.lit(int(s == 0)).cast("bigint").alias("mark")) for s in range(5)))
    walked = with_states(data.where("section = 'transformer'").select("file", "position", "value"), ["file"], "position", step, 5)
    record = F.col("marks") + (F.col("state") == 0).cast("long")
    several = walked.groupBy(F.col("file").alias("case_id"), record.alias("position")).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("position").alias("p"), "value"))), lambda r: r["value"]).alias("lines"))
    return one.unionByName(several.withColumn("section", F.lit("transformer")))


def _typed(records: DataFrame) -> dict[str, DataFrame]:
    """A typed table per section, with case_id, base_mva and the record's position in its section."""
    head = ["case_id", "base_mva", "position"]
    tables = {
        name: records.where(F.col("section") == name).select(*head, _fields(F.col("lines")[0], spec).alias("record")).select(*head, "record.*")
        for name, spec in SECTION_FIELDS.items()
    }
    parts = [_fields(F.coalesce(F.get("lines", F.lit(k)), F.lit("")), spec).alias(f"p{k}") for k, spec in enumerate(TRANSFORMER_FIELDS)]
    rows = records.where("section = 'transformer'").select(*head, *parts)
    own = [F.col(f"p{k}.{p.split()[0]}") for k, spec in enumerate(TRANSFORMER_FIELDS) for p in spec.split(",")]
    bad = F.concat(*(F.col(f"p{k}.bad_fields") for k in range(len(TRANSFORMER_FIELDS))))
    tables["transformer"] = rows.select(*head, *own, bad.alias("bad_fields"))
    return tables


def raw_sections(lines: DataFrame) -> dict[str, DataFrame]:
    """Typed section tables of the `read_lines` of raw files, and their headers as `header`; a file is a case.

    A case of any size is read by as many tasks as it has splits. The base power goes to every record of its case;
    a missing one is 100. A transformer cut off at the end of its section has nulls for what is missing. A file
    without lines has no rows.
    """
    lines = _numbered(lines)
    header = stored(raw_headers(lines), "raw-headers")
    base = header.select("case_id", F.coalesce("base_mva", F.lit(100.0)).alias("base_mva"))
    records = stored(_records(lines).join(base, "case_id"), "raw-records", "section")
    return {"header": header} | _typed(records)


def ingest_raw_cases(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """`raw_sections` of all files below `path`; a case has its file's path as its id."""
    return raw_sections(read_lines(spark, path))


# A record ends at a `/` outside quotes; what follows on that line is a remark. A quote ends with its line at the latest.
_DYR_END = r"^((?:[^'/]++|'[^']*+')*+)/.*$"
_DYR_PART = r"'[^']*+'?|[^\s,']++"


def dyr_records(lines: DataFrame) -> DataFrame:
    """(case_id, bus, model, machine_id, params) of the `read_lines` of dynamic-model files.

    Records are free-form over lines and end at `/`; fields are set apart by blanks or commas outside quotes. Quoted values
    are trimmed. A quote that is not closed reaches to the end of its line. What follows the last `/` of a
    file is no record; a file without one has none. A record is one row, a file need not be.
    """
    parts = F.transform(F.regexp_extract_all(F.regexp_replace("value", _DYR_END, "$1"), F.lit(_DYR_PART), F.lit(0)), lambda p: F.trim(F.replace(p, F.lit("'"), F.lit(""))))
    cut = stored(lines.select("file", "split", "at", F.col("value").rlike(_DYR_END).alias("ends"), parts.alias("parts")), "dyr-lines")
    total = cut.groupBy("file").agg(F.sum(F.col("ends").cast("long")).alias("records"))
    numbered = running(cut, F.col("ends"), "record", before=True).join(total, "file").where(F.col("record") < F.col("records"))
    gathered = numbered.where(F.size("parts") > 0).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "at", "parts"))).alias("lines"))
    whole = gathered.select(F.col("file").alias("case_id"), F.flatten("lines.parts").alias("parts"))
    return whole.select(
        "case_id",
        F.col("parts")[0].try_cast("long").alias("bus"),
        F.try_element_at("parts", F.lit(2)).alias("model"),
        F.try_element_at("parts", F.lit(3)).alias("machine_id"),
        F.transform(F.slice("parts", 4, F.greatest(F.size("parts") - 3, F.lit(0))), lambda p: p.try_cast("double")).alias("params"),
    )


def ingest_dyr_cases(spark: SparkSession, path: str) -> DataFrame:
    return dyr_records(read_lines(spark, path))


def _ends(bus: DataFrame, rows: DataFrame, roles: tuple[str, ...] = ("from", "to")) -> DataFrame:
    """Names and base voltages of a branch's ends; an end that the case lacks is named by its number."""
    for role in roles:
        end = bus.select("case_id", F.col("number").alias(f"{role}_bus"), F.col("name").alias(f"{role}_name"), F.col("base_voltage").alias(f"{role}_kv"))
        rows = rows.join(end, ["case_id", f"{role}_bus"], "left").withColumn(f"{role}_name", F.coalesce(f"{role}_name", F.col(f"{role}_bus").cast("string")))
    return rows


def _transformers(bus: DataFrame, rows: DataFrame) -> dict[str, DataFrame]:
    """Two- and three-winding transformers in per-unit of the case's base.

    Impedances by `cz`: 1 on the case's base, 2 on the windings' base, 3 as load loss in W and impedance on that base.
    Turns by `cw`: 1 in per-unit of the bus voltage, 2 in kV, 3 in per-unit of the nominal voltage.
    """
    base, three = F.col("base_mva"), F.coalesce("third_bus", F.lit(0)) != 0
    cz, cw = F.coalesce("cz", F.lit(1)), F.coalesce("cw", F.lit(1))

    def impedance(pair: str) -> tuple[Column, Column]:
        r, x, s = F.col(f"r{pair}"), F.col(f"x{pair}"), F.coalesce(f"sbase{pair}", base)
        loss = r / 1e6 / s
        reactance = F.sqrt(F.greatest(x * x - loss * loss, F.lit(0.0)))
        scale = base / s
        return F.when(cz == 1, r).when(cz == 2, r * scale).otherwise(loss * scale), F.when(cz == 1, x).when(cz == 2, x * scale).otherwise(reactance * scale)

    def turns(n: int, kv: str) -> Column:
        w, nominal = F.coalesce(f"winding{n}", F.lit(1.0)), F.coalesce(F.nullif(F.col(f"nominal{n}"), F.lit(0.0)), F.col(kv))
        return F.when(cw == 1, w).when(cw == 2, F.try_divide(w, F.col(kv))).otherwise(w * F.try_divide(nominal, F.col(kv)))

    named = _ends(bus, rows)
    name = F.concat(F.concat_ws("-", "from_name", "to_name"), F.lit("-i_"), F.coalesce("circuit", F.lit("1")))
    common = ["case_id", "from_bus", "to_bus", (F.col("status") == 1).alias("available")]
    r, x = impedance("12")
    two = named.where(~three).select(
        *common, name.alias("name"), r.alias("r"), x.alias("x"), F.coalesce("mag2", F.lit(0.0)).alias("primary_shunt"),
        F.try_divide(turns(1, "from_kv"), turns(2, "to_kv")).alias("tap"), F.radians(F.coalesce("angle1", F.lit(0.0))).alias("angle"), (F.col("rate_a1") / base).alias("rate"),
    )
    (ra, xa), (rb, xb), (rc, xc) = (impedance(p) for p in ("12", "23", "31"))
    half = lambda p, q, s: (p + q - s) / 2
    leg = lambda re, im: F.struct(re.alias("r"), im.alias("x"))
    third = _ends(bus, named.where(three).withColumn("tertiary_bus", F.col("third_bus")), ("tertiary",))
    three_windings = third.select(
        *common, "third_bus", (-F.col("position")).cast("long").alias("star_bus"),
        F.concat(F.concat_ws("-", "from_name", "to_name", "tertiary_name"), F.lit("-i_"), F.coalesce("circuit", F.lit("1"))).alias("name"),
        leg(half(ra, rc, rb), half(xa, xc, xb)).alias("primary"), leg(half(ra, rb, rc), half(xa, xb, xc)).alias("secondary"), leg(half(rb, rc, ra), half(xb, xc, xa)).alias("tertiary"),
        turns(1, "from_kv").alias("tap1"), turns(2, "to_kv").alias("tap2"), turns(3, "tertiary_kv").alias("tap3"),
    )
    plain = (F.abs(F.col("tap") - 1) < 1e-12) & (F.col("angle") == 0)
    return {"Transformer2W": two.where(plain).drop("tap", "angle"), "TapTransformer": two.where(~F.coalesce(plain, F.lit(False))), "Transformer3W": three_windings}


def raw_to_components(sections: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Section tables to named components in per-unit of each case's own base power.

    Names: `generator-<bus>-<id>`, `load<bus><id>`, `shunt-<bus>-<id>`, `<from>-<to>-i_<k>` with k the position
    in the branch section, or the circuit of a transformer. Line charging is split in halves, ratings are
    sqrt(Pmax^2 + Qmax^2). A branch whose end is not among the buses stays; `dangling_ends` finds it.
    """
    base, keys = F.col("base_mva"), ["case_id"]
    bus = sections["bus"].select(
        *keys,
        F.col("bus_number").alias("number"),
        F.col("bus_name").alias("name"),
        look_up(F.col("bus_type"), RAW_BUS_TYPES).alias("bustype"),
        F.radians("va").alias("angle"),
        F.col("vm").alias("magnitude"),
        F.struct(F.col("normal_vmin").alias("min"), F.col("normal_vmax").alias("max")).alias("voltage_limits"),
        F.col("base_kv").alias("base_voltage"),
        F.col("area").cast("string").alias("area"),
        F.col("zone").cast("string").alias("load_zone"),
    )
    load = sections["load"].select(
        *keys,
        F.concat(F.lit("load"), F.col("bus_number").cast("string"), F.col("load_id")).alias("name"),
        F.col("bus_number").alias("bus"),
        (F.col("status") == 1).alias("available"),
        (F.col("pl") / base).alias("active_power"),
        (F.col("ql") / base).alias("reactive_power"),
        (F.col("pl") / base).alias("max_active_power"),
        (F.col("ql") / base).alias("max_reactive_power"),
    )
    shunt = sections["fixed_shunt"].select(
        *keys,
        F.concat_ws("-", F.lit("shunt"), F.col("bus_number").cast("string"), F.col("shunt_id")).alias("name"),
        F.col("bus_number").alias("bus"),
        (F.col("status") == 1).alias("available"),
        (F.col("gl") / base).alias("g"),
        (F.col("bl") / base).alias("b"),
    )
    pmax, qmax = F.col("pt") / base, F.col("qt") / base
    generator = sections["generator"].select(
        *keys,
        F.concat_ws("-", F.lit("generator"), F.col("bus_number").cast("string"), F.col("machine_id")).alias("name"),
        F.col("bus_number").alias("bus"),
        F.col("machine_id"),
        (F.col("status") == 1).alias("available"),
        (F.col("pg") / base).alias("active_power"),
        (F.col("qg") / base).alias("reactive_power"),
        F.sqrt(pmax * pmax + qmax * qmax).alias("rating"),
        F.struct((F.col("pb") / base).alias("min"), pmax.alias("max")).alias("active_power_limits"),
        F.struct((F.col("qb") / base).alias("min"), qmax.alias("max")).alias("reactive_power_limits"),
        F.struct(pmax.alias("up"), pmax.alias("down")).alias("ramp_limits"),
        F.col("mbase").alias("base_power"),
    )
    line = _ends(bus, sections["branch"]).select(
        *keys,
        F.concat(F.concat_ws("-", "from_name", "to_name"), F.lit("-i_"), F.col("position").cast("string")).alias("name"),
        "from_bus",
        "to_bus",
        (F.col("status") == 1).alias("available"),
        "r",
        "x",
        F.struct((F.col("b") / 2).alias("from"), (F.col("b") / 2).alias("to")).alias("b"),
        (F.col("rate_a") / base).alias("rate"),
    )
    transformers = _transformers(bus, sections["transformer"])
    arcs = [line, transformers["Transformer2W"], transformers["TapTransformer"]]
    legs = transformers["Transformer3W"].select("case_id", F.explode(F.array("from_bus", "to_bus", "third_bus")).alias("from"), F.col("star_bus").alias("to"))
    arc = legs
    for rows in arcs:
        arc = arc.unionByName(rows.select("case_id", F.col("from_bus").alias("from"), F.col("to_bus").alias("to")))
    area = bus.select("case_id", F.col("area").alias("name")).distinct()
    zone = (
        bus.select("case_id", F.col("number").alias("bus"), F.col("load_zone").alias("name"))
        .join(load.select("case_id", "bus", "max_active_power", "max_reactive_power"), ["case_id", "bus"], "left")
        .groupBy("case_id", "name")
        .agg(
            F.coalesce(F.sum("max_active_power"), F.lit(0.0)).alias("peak_active_power"),
            F.coalesce(F.sum("max_reactive_power"), F.lit(0.0)).alias("peak_reactive_power"),
        )
    )
    return {
        "Bus": bus, "PowerLoad": load, "FixedAdmittance": shunt, "ThermalStandard": generator, "Line": line,
        **transformers, "Arc": arc.distinct(), "Area": area, "LoadZone": zone,
    }


def network_rows(components: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(branches, shunts) of the available components for `ybus`, per case: lines, transformers with their taps, and
    three-winding transformers as three legs to a star bus with a negative number."""
    zero, one = F.lit(0.0), F.lit(1.0)
    names = ["case_id", F.col("from_bus").alias("from_bus_id"), F.col("to_bus").alias("to_bus_id")]
    line = components["Line"].where("available").select(*names, "r", "x", F.col("b.from").alias("b_from"), F.col("b.to").alias("b_to"), one.alias("tap"))
    plain = components["Transformer2W"].where("available").select(*names, "r", "x", F.col("primary_shunt").alias("b_from"), zero.alias("b_to"), one.alias("tap"))
    tapped = components["TapTransformer"].where("available").select(*names, "r", "x", F.col("primary_shunt").alias("b_from"), zero.alias("b_to"), "tap")
    leg = lambda bus, z, tap: F.struct(F.col(bus).alias("from_bus_id"), F.col("star_bus").alias("to_bus_id"), F.col(f"{z}.r").alias("r"), F.col(f"{z}.x").alias("x"), zero.alias("b_from"), zero.alias("b_to"), F.col(tap).alias("tap"))
    star = components["Transformer3W"].where("available").select("case_id", F.inline(F.array(leg("from_bus", "primary", "tap1"), leg("to_bus", "secondary", "tap2"), leg("third_bus", "tertiary", "tap3"))))
    shunt = components["FixedAdmittance"].where("available").select("case_id", F.col("bus").alias("bus_id"), "g", "b")
    return line.unionByName(plain).unionByName(tapped).unionByName(star), shunt
