from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gridloom.checks.catalog import all_queries
from gridloom.session import scratch
from gridloom.sources import pointers as PT
from gridloom.sources import raw_cases as R
from gridloom.sources import system_json as SJ
from gridloom.sources.split_lines import carried, read_lines, running, text_lines, with_states
from gridloom.sources.results import read_result, write_result
from gridloom.sources.store import dataset_catalog, materialize_once
from gridloom.sources.tables import scan_csv, sink_csv

SECTIONS = ["BUS", "LOAD", "FIXED SHUNT", "GENERATOR", "BRANCH", "TRANSFORMER", "AREA", *["EMPTY"] * 5, "ZONE", *["EMPTY"] * 6]


def raw_text(base, records, end="\n", pad="", remark=""):
    """A made-up case: `records` has the lines of each section by name."""
    out = [f"0, {base}, 33, 0, 1, 50.00 / made up", "a title / with a slash", "0 is no end here"]
    for section in SECTIONS:
        out += [pad + line + remark for line in records.get(section, [])]
        out.append(f"{pad}0 / end of {section.lower()} data")
    return end.join([*out, "Q", ""])


def ring(n, base):
    """`n` buses in a ring: a load at every third bus, a shunt at every fourth, transformers on two edges."""
    number = lambda i: 700 + 10 * (i % n)
    bus = [f"{number(i)}, 'STATION {i}  ', {20 + 5 * (i % 3)}.5, {3 if i == 0 else 1 + i % 2}, {1 + i % 2}, 8, 1, 1.0{i}, {3 * i}.0, 1.07, 0.93" for i in range(n)]
    return {
        "BUS": bus,
        "LOAD": [f"{number(i)}, 'L ', 1, 1, 8, {11 * i}.5, {i}.25, 0, 0, 0, 0, 1" for i in range(0, n, 3)],
        "FIXED SHUNT": [f"{number(i)}, '1 ', {i % 8 // 4}, {i}.0, {2 * i}.5" for i in range(0, n, 4)],
        "GENERATOR": [f"{number(0)}, 'G1', 12.5, 3.0, 40.0, -30.0, 1.02, 0, 55.0, 0, 0.2, 0, 0, 1, 1, 100, 30.0, 6.0, 4, 0.75, 5, 0.25, 0, 1, 0, 1, 2, 0.9"],
        "BRANCH": [f"{number(i)}, {number(i + 1)}, '1 ', 0.0{i + 1}, 0.{i + 11}, 0.0{i}, {60 + i}.0, 0, 0, 0, 0, 0, 0, 1, 1, 7.5, 3, 1.0" for i in range(2, n)],
        "TRANSFORMER": [
            f"{number(0)}, {number(1)}, 0, 'T ', 1, 1, 1, 0, 0.004, 2, 'NORTH BANK  ', 1, 1, 1.0", "0.003, 0.14, 80.0", "1.025, 0, 0, 45.0, 0, 0", "1.0, 0",
            f"{number(1)}, {number(2)}, {number(3)}, 'T ', 1, 1, 1, 0, 0, 2, 'THREE', 1", "0.0, 0.2, 100, 0.0, 0.3, 100, 0.0, 0.4, 100, 1.0, 0", "1.0, 0, 0", "1.1, 0, 0", "1.2, 0, 0",
            f"{number(1)}, {number(2)}, 0, 'U ', 2, 2, 1, 0, 0, 2, 'SOUTH BANK', 1", "0.01, 0.1, 25.0", "26.775, 25.5, 0", "30.5, 30.5",
        ],
        "AREA": ["1, 700, 0.0, 9.5, 'HILLS   '"],
        "ZONE": ["8, 'LOW, LANDS'"],
    }


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "ring.raw").write_bytes(raw_text(40, ring(6, 40), "\r\n", " ", " / remark").encode())
    bare = {"BUS": ["5, 'A', 10, 3, 1, 1, 1, 1.0, 0.0, 1.1, 0.9", "6, 'B', 10, 2, 1, x7, 1, 1.0, 0.0"], "BRANCH": ["5, 6, 1, 0.0, 0.5, 0.2, 70", "5, 9, 1, 0.1, 0.5, 0.2, 70"]}
    (folder / "bare.raw").write_bytes(raw_text(250.0, bare).encode())
    return R.ingest_raw_cases(spark, str(folder))


def of(df, name):
    rows = df.filter(F.col("case_id").endswith(f"/{name}.raw"))
    return (rows.orderBy("position") if "position" in df.columns else rows).collect()


def test_headers(raw):
    assert [(r.base_mva, r.revision, r.frequency) for r in of(raw["header"], "ring") + of(raw["header"], "bare")] == [(40.0, 33, 50.0), (250.0, 33, 50.0)]


def test_section_sizes(raw):
    sizes = {k: (len(of(v, "ring")), len(of(v, "bare"))) for k, v in raw.items()}
    assert sizes == {
        "header": (1, 1), "bus": (6, 2), "load": (2, 0), "fixed_shunt": (2, 0), "generator": (1, 0), "branch": (4, 2),
        "transformer": (3, 0), "area": (1, 0), "zone": (1, 0),
    }


def test_fields_by_position(raw):
    bus = of(raw["bus"], "ring")
    assert [(r.bus_number, r.bus_name, r.base_kv, r.bus_type) for r in bus[:3]] == [(700, "STATION 0", 20.5, 3), (710, "STATION 1", 25.5, 2), (720, "STATION 2", 30.5, 1)]
    short = of(raw["bus"], "bare")
    assert (short[0].bus_name, short[0].normal_vmin, short[0].emergency_vmax, short[0].bad_fields) == ("A", 0.9, None, [])
    assert (short[1].zone, short[1].bad_fields) == (None, ["zone=x7"])
    gen = of(raw["generator"], "ring")[0]
    assert (gen.machine_id, gen.zx, gen.pt, gen.pb, gen.share1, gen.owner2, gen.wind_power_factor) == ("G1", 0.2, 30.0, 6.0, 0.75, 5, 0.9)
    assert [(r.x, r.owner1) for r in of(raw["branch"], "ring")] == [(0.13, 3), (0.14, 3), (0.15, 3), (0.16, 3)]
    assert of(raw["zone"], "ring")[0].zone_name == "LOW, LANDS" and of(raw["area"], "ring")[0].area_name == "HILLS"


def test_transformers_with_two_and_three_windings(raw):
    got = [(r.from_bus, r.to_bus, r.third_bus, r.transformer_name, r.x12, r.x31, r.winding1, r.winding3) for r in of(raw["transformer"], "ring")]
    assert got == [(700, 710, 0, "NORTH BANK", 0.14, None, 1.025, None), (710, 720, 730, "THREE", 0.2, 0.4, 1.0, 1.2), (710, 720, 0, "SOUTH BANK", 0.1, None, 26.775, None)]


def test_components_in_per_unit_of_their_own_base(raw):
    tables = R.raw_to_components(raw)
    mine = {k: v.filter(F.col("case_id").endswith("/ring.raw")) for k, v in tables.items()}
    bus = {r.number: r for r in mine["Bus"].collect()}
    assert [bus[i].bustype for i in (700, 710, 720)] == ["REF", "PV", "PQ"]
    assert bus[710].angle == pytest.approx(3 * 3.141592653589793 / 180) and bus[710].voltage_limits.max == 1.07
    load = {r.name: r.active_power for r in mine["PowerLoad"].collect()}
    assert load == {"load700L": pytest.approx(0.5 / 40), "load730L": pytest.approx(33.5 / 40)}
    shunt = {r.name: (r.available, r.g, r.b) for r in mine["FixedAdmittance"].collect()}
    assert shunt == {"shunt-700-1": (False, 0.0, 0.0125), "shunt-740-1": (True, 0.1, 0.2125)}
    gen = mine["ThermalStandard"].first()
    assert gen.name == "generator-700-G1" and gen.rating == pytest.approx(1.25) and gen.active_power_limits.min == pytest.approx(0.15)
    lines = {r.name: r for r in mine["Line"].collect()}
    assert lines["STATION 2-STATION 3-i_1"].rate == pytest.approx(62 / 40) and lines["STATION 5-STATION 0-i_4"].b["from"] == pytest.approx(0.025)
    tap = {r.name: r for r in mine["TapTransformer"].collect()}
    assert set(tap) == {"STATION 0-STATION 1-i_T", "STATION 1-STATION 2-i_U"}
    assert (tap["STATION 0-STATION 1-i_T"].tap, tap["STATION 0-STATION 1-i_T"].rate) == (1.025, 45 / 40)
    south = tap["STATION 1-STATION 2-i_U"]
    assert (south.tap, south.x, south.r) == (pytest.approx(1.05), pytest.approx(0.16), pytest.approx(0.016))
    star = mine["Transformer3W"].first()
    assert [round(w.x, 9) for w in (star.primary, star.secondary, star.tertiary)] == [0.15, 0.05, 0.25] and star.star_bus == -2
    zones = {r.name: r.peak_active_power for r in mine["LoadZone"].collect()}
    assert zones == {"8": pytest.approx(34 / 40)}
    arcs = {(r["from"], r.to) for r in mine["Arc"].collect()}
    assert len(arcs) == 4 + 2 + 3 and (710, -2) in arcs


def test_a_branch_with_a_missing_end_stays(raw):
    from gridloom.operators.quality import dangling_ends

    tables = {k: v.filter(F.col("case_id").endswith("/bare.raw")) for k, v in R.raw_to_components(raw).items()}
    assert sorted((r.name, r.rate) for r in tables["Line"].collect()) == [("A-9-i_2", 70 / 250), ("A-B-i_1", 70 / 250)]
    lines = tables["Line"].selectExpr("name", "from_bus as from_bus_id", "to_bus as to_bus_id")
    assert [r.bus_id for r in dangling_ends(lines, tables["Bus"].selectExpr("number as bus_id"), "name").collect()] == [9]


def test_admittance_of_a_case_with_transformers(raw):
    import numpy as np

    from gridloom.operators.network import ybus

    branch, shunt = R.network_rows({k: v.filter(F.col("case_id").endswith("/ring.raw")) for k, v in R.raw_to_components(raw).items()})
    got = {(r.i, r.j): complex(r.re, r.im) for r in ybus(branch, shunt, tap="tap", keys=["case_id"]).collect()}
    buses = [700, 710, 720, 730, 740, 750, -2]
    want = np.zeros((7, 7), complex)
    edges = [(720 + 10 * k, 700 + 10 * ((3 + k) % 6), complex(0.01 * (k + 3), 0.01 * (k + 13)), 0.01 * (k + 2) / 2, 1.0) for k in range(4)]
    edges += [(700, 710, complex(0.003, 0.14), None, 1.025), (710, 720, complex(0.016, 0.16), None, 1.05)]
    edges += [(710, -2, 0.15j, None, 1.0), (720, -2, 0.05j, None, 1.1), (730, -2, 0.25j, None, 1.2)]
    for f, t, z, half, tap in edges:
        f, t, y = buses.index(f), buses.index(t), 1 / z
        magnetizing = 0.004 if (f, t) == (0, 1) else 0.0
        want[f, f] += (y + 1j * (half if half is not None else magnetizing)) / tap**2
        want[t, t] += y + 1j * (half or 0.0)
        want[f, t] -= y / tap
        want[t, f] -= y / tap
    want[4, 4] += 0.1 + 0.2125j
    for (i, j), value in got.items():
        assert value == pytest.approx(want[buses.index(i), buses.index(j)]), (i, j)
    assert sum(abs(want[buses.index(i), buses.index(j)]) for i, j in got) == pytest.approx(np.abs(want).sum())


def test_many_transformers_in_one_case(spark):
    """Records of both lengths in a long section: the walk finds each start."""
    lines, want = [], []
    for i in range(1500):
        third = i % 3 == 1
        want.append((i + 1, f"T{i}", i % 7 / 10))
        lines += [f"1, 2, {9 if third else 0}, '{i % 90}', 1, 1, 1, 0, 0, 2, 'T{i}', 1", f"0, 0.{i % 7}, 100", "1, 0", "1, 0", *(["1, 0"] if third else [])]
    cases = spark.createDataFrame([("c", raw_text(100, {"TRANSFORMER": lines}))], "case_id string, text string")
    rows = R.raw_sections(text_lines(cases))["transformer"].orderBy("position").collect()
    assert [(r.position, r.transformer_name, r.x12) for r in rows] == want


@pytest.fixture
def small_splits(spark):
    """Files are cut anywhere, into splits of some lines."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_and_sums_over_splits(spark, tmp_path, small_splits):
    texts = {"a.txt": [f"line {i} {'x' * (i % 37)}" for i in range(300)], "b.txt": ["one"], "c.txt": ["", "two", ""]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    for size in (64, 1000, 10**6):
        small_splits(size)
        lines = read_lines(spark, str(tmp_path))
        numbered = running(running(lines, F.lit(1), "n"), F.length("value"), "before", before=True)
        numbered = carried(numbered, F.when(F.col("value").endswith("x") | (F.col("value") == "one"), F.col("value")), "last").collect()
        assert (len({r.split for r in numbered}) > 20) == (size == 64)
        last = None
        for name, want in texts.items():
            mine = sorted((r for r in numbered if r.file.endswith(name)), key=lambda r: r.n)
            assert [r.value for r in mine] == want and [r.n for r in mine] == list(range(1, len(want) + 1))
            assert [r.before for r in mine] == [sum(map(len, want[:i])) for i in range(len(want))]
            for r in mine:
                last = r.value if r.value.endswith("x") or r.value == "one" else last
                assert r.last == last


def test_states_go_through_blocks_and_stretches(spark, monkeypatch):
    import random

    from gridloom.sources import split_lines

    draw = random.Random(3)
    rows = [(f"f{k}", i + 1, draw.randint(0, 2)) for k, n in enumerate((1, 2, 700, 64)) for i in range(n)]
    lines = spark.createDataFrame(rows, "file string, place long, kind int").repartition(5)
    # State s and line of kind k go to (2 s + k) mod 3, with a mark of s * k.
    step = F.array(*(F.struct(F.pmod(F.lit(2 * s) + F.col("kind"), F.lit(3)).cast("int").alias("to"), (F.lit(s) * F.col("kind")).cast("bigint").alias("mark")) for s in range(3)))
    for block, stretch in ((128, 1024), (5, 3), (1, 1)):
        monkeypatch.setattr(split_lines, "LINES_PER_BLOCK", block)
        monkeypatch.setattr(split_lines, "BLOCKS_PER_STRETCH", stretch)
        got = {(r.file, r.place): (r.state, r.marks) for r in with_states(lines, ["file"], "place", step, 3).collect()}
        state, marks = 0, 0
        for file, place, kind in rows:
            state, marks = (0, 0) if place == 1 else (state, marks)
            assert got[file, place] == (state, marks)
            state, marks = (2 * state + kind) % 3, marks + state * kind


def test_raw_file_cut_anywhere_gives_the_same_tables(spark, tmp_path, raw, small_splits):
    records = ring(40, 40)
    (tmp_path / "ring.raw").write_text(raw_text(40, records, "\r\n", " ", " / remark"))
    want = {k: v.drop("case_id").collect() for k, v in R.ingest_raw_cases(spark, str(tmp_path)).items()}
    for size in (50, 700):
        small_splits(size)
        assert read_lines(spark, str(tmp_path)).select("split").distinct().count() > 5
        got = {k: v.drop("case_id").collect() for k, v in R.ingest_raw_cases(spark, str(tmp_path)).items()}
        assert {k: sorted(map(str, v)) for k, v in got.items()} == {k: sorted(map(str, v)) for k, v in want.items()}
    assert len(want["transformer"]) == 3 and len(want["bus"]) == 40


def test_lines_are_numbered_where_they_lie(spark, tmp_path, small_splits, plan):
    """Lines are numbered by a row per split that is joined to them: they are neither sorted nor windowed for it."""
    for name, n in (("a.txt", 300), ("b.txt", 1), ("c.txt", 7)):
        (tmp_path / name).write_text("".join(f"{i + 1} {'x' * (i % 37)}\n" for i in range(n)))
    for size in (64, 10**6):
        small_splits(size)
        lines = R._numbered(read_lines(spark, str(tmp_path)))
        text = plan(lines)
        assert "Window" not in text and "Sort " not in text
        got = sorted((r.file.split("/")[-1], r.line, int(r.value.split(" ")[0])) for r in lines.collect())
        assert got == [(name, i + 1, i + 1) for name, n in (("a.txt", 300), ("b.txt", 1), ("c.txt", 7)) for i in range(n)]


def test_raw_cases_have_no_checksum_files(spark, tmp_path):
    """On a local disk a case is one file, with a call of `chmod` in place of four."""
    import os

    from gridloom.checks.files import raw_case_files
    from gridloom.checks.fixtures import Tables

    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "EAST")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "A", 0), (1, "B", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(i, f"c{i}", i % 2, 5.0, "M") for i in (1, 2, 1001, 1002)]),
        "part": ("p_partkey long, p_type string, p_size int, p_retailprice double, p_brand string", [(1, "ECONOMY", 3, 7.0, "x")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double", [(1, 1, "1-URGENT", 9.0), (2, 1002, "5-LOW", 9.0)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    folder = raw_case_files(Tables(spark, str(tmp_path))).removeprefix("file:")
    names = [f for _, _, files in os.walk(folder) for f in files if not f.startswith("_") and "_SUCCESS" not in f]
    assert len(names) == 4 and not any(n.endswith(".crc") for n in names)
    assert R.ingest_raw_cases(spark, folder)["bus"].count() == 4


def test_long_raw_lines(spark, tmp_path):
    long = "y" * 1_000_000
    records = {"BUS": [f"5, 'A', 10, 3, 1, 1, 1, 1.0, 0.0, 1.1, 0.9 / {long}", f"6, 'B{long}', 10", "7, 'open / quote"], "LOAD": [", ".join(["1"] * 20_000)]}
    (tmp_path / "long.raw").write_text(raw_text(1, records))
    (tmp_path / "open.raw").write_text("0, 5, 33\n")  # ends in its header
    (tmp_path / "none.raw").write_text("")
    tables = R.ingest_raw_cases(spark, str(tmp_path))
    assert [(r.bus_number, len(r.bus_name)) for r in of(tables["bus"], "long")] == [(5, 1), (6, 1_000_001), (7, 12)]
    assert tables["load"].count() == 1 and of(tables["header"], "open")[0].base_mva == 5.0 and tables["header"].count() == 2


def test_long_and_broken_dynamic_files(spark, tmp_path, small_splits):
    (tmp_path / "long.dyr").write_text("1 'M' 'a' " + " ".join(["0.5"] * 300_000) + " / " + "remark " * 200_000 + "\n2 'N' 'b'\n" + "1.5 ,\n" * 5000 + "/\n")
    (tmp_path / "endless.dyr").write_text("3 'M' 'c' 1\n" * 2000)
    (tmp_path / "open.dyr").write_text("4 'M' 'open / 2\n7.5 /\n5 'M' 'e' 3 /\n6 'M' 'late' 4")
    (tmp_path / "none.dyr").write_text("")
    for size in (10_000, 10**7):
        small_splits(size)
        rows = R.ingest_dyr_cases(spark, str(tmp_path)).collect()
        got = sorted((r.bus, r.case_id.split("/")[-1], r.model, r.machine_id, len(r.params), r.params[-1]) for r in rows)
        assert got == [(1, "long.dyr", "M", "a", 300_000, 0.5), (2, "long.dyr", "N", "b", 5000, 1.5), (4, "open.dyr", "M", "open / 2", 1, 7.5), (5, "open.dyr", "M", "e", 1, 3.0)]


def test_reading_raw_files_needs_no_shuffle(raw, plan):
    for name in ("bus", "branch", "transformer", "header"):
        assert "Exchange" not in plan(raw[name]) and "Python" not in plan(raw[name])


def test_dyr_records(spark, tmp_path):
    text = (
        " 41 'MACHA' 'x ' 3.25, 0.5\r\n   7.125,8 / the slash ends a record\r\n41,'GOV ONE',2,1.5E-01 , -2 /\r\n"
        "  / an empty record\r\n42 'EX/C' \"Q\" 9.0 bad 1 /\r\n"
    )
    (tmp_path / "case.dyr").write_bytes(text.replace('"Q"', "'Q'").encode())
    rows = R.ingest_dyr_cases(spark, str(tmp_path)).collect()
    assert sorted(((r.bus, r.model, r.machine_id, r.params) for r in rows), key=lambda r: r[1]) == [
        (42, "EX/C", "Q", [9.0, None, 1.0]), (41, "GOV ONE", "2", [0.15, -2.0]), (41, "MACHA", "x", [3.25, 0.5, 7.125, 8.0]),
    ]


def test_system_json(spark, tmp_path):
    def part(kind, uuid, **fields):
        return {"__metadata__": {"type": kind}, "internal": {"uuid": {"value": uuid}}, **fields}

    doc = {
        "frequency": 60.0, "units_settings": {"base_value": 100.0, "unit_system": "SYSTEM_BASE"},
        "data": {
            "components": [
                part("Bus", "b1", name="N", number=1, bustype="REF", voltage_limits={"min": 0.9, "max": 1.1}),
                part("Bus", "b2", name="S", number=2, bustype="PV"),
                part("Arc", "a1", **{"from": {"value": "b1"}, "to": {"value": "b2"}}),
                part("Line", "l1", name="N-S-i_1", r=0.01, x=0.1, b={"from": 0.1, "to": 0.2}, arc={"value": "a1"}, available=True),
                part("DynamicGenerator", "d1", name="g", states=["δ", "ω"], n_states=2, machine={"R": 0.0}),
                part("SomethingNew", "x", name="q"),
            ]
        },
    }
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    tables = SJ.read_system_json(spark, str(tmp_path))
    assert tables["Bus"].count() == 4 and tables["DynamicGenerator"].first().states == ["δ", "ω"]
    line = tables["Line"].first()
    assert (line.x, line.b.to, line.arc.value, line.available) == (0.1, 0.2, "a1", True)
    assert tables["Arc"].first()["from"].value == "b1"
    cases = spark.read.text(str(tmp_path), wholetext=True).select(F.lit("c").alias("case_id"), F.col("value").alias("text"))
    assert SJ.system_components(cases).filter("comp_type = 'SomethingNew'").count() == 2
    assert SJ.system_settings(cases).first().base_power == 100.0


def _documents(path):
    """The texts of the documents of a written folder, its files read one after the other."""
    import glob

    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))
    return [x + "]}}" for x in text.split("\n]}}\n")[:-1]]


def test_one_case_is_written_and_read_by_many_tasks(spark, tmp_path, small_splits, plan):
    body = lambda i: json.dumps({"__metadata__": {"type": "Bus"}, "name": f"b{i}", "number": i})
    rows = [("big", body(i)) for i in range(3000)] + [("big", body(7))] * 3 + [(f"small{i % 50}", body(i)) for i in range(200)]
    rows += [("lines", '{"__metadata__": {"type": "Odd"},\n "name": "a\\nb"}'), ("lines", '["not", "an object"')]
    components = spark.createDataFrame(rows, "case_id string, body string").repartition(7)
    cases = sorted({c for c, _ in rows}) + ["nothing in it"]
    settings = spark.createDataFrame([(c, 100.0, "SYSTEM_BASE", 60.0) for c in cases], "case_id string, base_power double, unit_system string, frequency double")
    path = str(tmp_path / "systems")
    SJ.write_system_json(components, settings, path)
    files = spark.read.text(path).select(F.col("_metadata.file_name").alias("f"), "value")
    sizes = {r.f: r.n for r in files.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(sizes) > 2 and max(sizes.values()) < 2500  # no file, and so no task, had the whole of the big case
    parsed = [json.loads(x) for x in _documents(path) if '"case_id":"lines"' not in x]
    assert sorted((d["case_id"], c["name"]) for d in parsed for c in d["data"]["components"]) == sorted((c, json.loads(b)["name"]) for c, b in rows if c != "lines")
    for size in (3000, 10**8):
        small_splits(size)
        back = SJ.read_system_json(spark, path, one_per_line=True)
        assert sorted(r.case_id for r in back["settings"].collect()) == sorted(cases)
        got = sorted((r.case_id, r.body) for r in back["components"].collect())
        assert got == sorted((c, b.replace("\n", " ")) for c, b in rows)


def test_small_documents_are_rows_of_their_own(spark, tmp_path):
    body = lambda i: json.dumps({"__metadata__": {"type": "Bus"}, "name": f"b{i}"})
    rows = [(f"c{i // 5}", body(i)) for i in range(500)] + [("blank", "\t")]
    settings = [(f"c{i}", float(i), "x", 60.0) for i in range(100)] + [("c7", 7.5, "x", 50.0), (None, 1.0, "x", 1.0), ("blank", 1.0, "x", 1.0)]
    components = spark.createDataFrame(rows, "case_id string, body string").coalesce(1)
    settings = spark.createDataFrame(settings, "case_id string, base_power double, unit_system string, frequency double")
    path = str(tmp_path / "systems")
    SJ.write_system_json(components, settings, path)
    texts = [r.value for r in spark.read.text(path, lineSep="\n\t\n\t\n").collect()]
    assert len(texts) == 103 and all(x.endswith("\n]}}") and "[\n" in x for x in texts)  # no row of two documents, none cut
    assert sum(x.count('"Bus"') for x in texts) == 500
    parts = SJ._document_parts(spark, path).where("opening is not null")
    assert parts.count() == 103
    back = SJ.read_system_json(spark, path, one_per_line=True)
    assert sorted(map(str, back["settings"].collect())) == sorted(map(str, settings.collect()))
    assert sorted((r.case_id, r.body) for r in back["components"].collect()) == sorted(rows)


def test_documents_are_read_once(spark, tmp_path, plan):
    """Settings are parsed without the components, a component's type and name in one go, and whole documents are scanned once."""
    bodies = ['{"__metadata__":{"type":"Bus"},"name":"b"}', '{"__metadata__":{"type":"Bus"},\r\n"name":7}', '["odd",', '{"name":null}']
    components = spark.createDataFrame([("a", b) for b in bodies] + [("b", bodies[0])], "case_id string, body string").coalesce(1)
    settings = spark.createDataFrame([("a", 1.0, "x", 50.0), ("b", 2.0, "x", 50.0)], "case_id string, base_power double, unit_system string, frequency double")
    path = str(tmp_path / "systems")
    SJ.write_system_json(components, settings, path)
    text = spark.createDataFrame([("c", '{"data":{"components":[{}]},"frequency":50.0,"units_settings":{"base_value":1.0,"unit_system":"y"}}')], "case_id string, text string")
    assert SJ.system_settings(text).first() == ("c", 1.0, "y", 50.0) and "components" not in plan(SJ.system_settings(text))
    parts = plan(SJ._document_parts(spark, path))
    assert parts.count("FileScan text") == 1 and "get_json_object" not in plan(SJ.system_components(text))
    back = SJ.read_system_json(spark, path, one_per_line=True)["components"]
    assert sorted((r.case_id, r.comp_type or "", r.name or "", r.body) for r in back.collect()) == sorted(
        [("a", "Bus", "b", bodies[0]), ("a", "Bus", "7", bodies[1].replace("\r\n", " ")), ("a", "", "", bodies[2]), ("a", "", "", bodies[3]), ("b", "Bus", "b", bodies[0])]
    )


def test_compressed_documents_come_back(spark, tmp_path, small_splits):
    """The same documents with a codec: small cases and one of many parts, each file read from its start."""
    body = lambda i: json.dumps({"__metadata__": {"type": "Bus"}, "name": f"b{i}", "number": i})
    rows = [("big", body(i)) for i in range(3000)] + [(f"small{i % 50}", body(i)) for i in range(400)]
    components = spark.createDataFrame(rows, "case_id string, body string").repartition(5)
    cases = sorted({c for c, _ in rows}) + ["nothing in it"]
    settings = spark.createDataFrame([(c, 100.0, "x", 60.0) for c in cases], "case_id string, base_power double, unit_system string, frequency double")
    sizes = {}
    for codec in (None, "lz4"):
        path = tmp_path / f"systems-{codec}"
        SJ.write_system_json(components, settings, str(path), compression=codec)
        files = [f for f in path.iterdir() if f.name.startswith("part-")]
        assert len(files) > 2 and all(f.name.endswith(".lz4") for f in files) == (codec is not None)
        sizes[codec] = sum(f.stat().st_size for f in files)
        small_splits(3000)
        back = SJ.read_system_json(spark, str(path), one_per_line=True)
        assert sorted(r.case_id for r in back["settings"].collect()) == sorted(cases)
        assert sorted((r.case_id, r.body) for r in back["components"].collect()) == sorted(rows)
    assert sizes["lz4"] * 3 < sizes[None]
    small_splits(10**8)
    with scratch(spark) as folder:  # and the query keeps no plain text
        all_queries()["read_system_json"](spark, "/root/testdata/sf0.001").count()
        parts = [f for f in Path(folder.removeprefix("file://")).glob("systems-*/part-*")]
        assert parts and all(f.name.endswith(".lz4") for f in parts)


def test_systems_come_back_as_they_were_written(spark, tmp_path):
    bodies = [
        ("one", {"__metadata__": {"type": "Bus"}, "name": "N", "number": 1}),
        ("one", {"__metadata__": {"type": "DynamicGenerator"}, "name": "g", "machine": {"__metadata__": {"type": "SlowMachine"}, "R": 0.25}}),
        ("two", {"__metadata__": {"type": "SomethingNew"}, "name": "q,]}"}),
    ]
    components = spark.createDataFrame([(c, json.dumps(b)) for c, b in bodies], "case_id string, body string")
    settings = spark.createDataFrame([("one", 50.0, "NATURAL", 60.0), ("two", 100.0, "SYSTEM_BASE", 50.0), ("empty", 1.0, "x", 2.0)], "case_id string, base_power double, unit_system string, frequency double")
    path = str(tmp_path / "systems")
    for _ in range(2):
        SJ.write_system_json(components, settings, path, force=True)
    with pytest.raises(AnalysisException):
        SJ.write_system_json(components, settings, path)
    assert [json.loads(x) for x in _documents(path)]  # each case is a document that any reader understands
    back = SJ.read_system_json(spark, path, one_per_line=True)
    assert sorted(map(tuple, back["settings"].collect())) == sorted(map(tuple, settings.collect()))
    assert [(r.case_id, r.name, r.number) for r in back["Bus"].collect()] == [("one", "N", 1)]
    assert [(r.model, json.loads(r.body)["R"]) for r in SJ.nested_model(back["DynamicGenerator"], "machine").collect()] == [("SlowMachine", 0.25)]
    assert [(r.case_id, r.comp_type, r.name) for r in back["*"].collect()] == [("two", "SomethingNew", "q,]}")]
    assert sorted((r.case_id, json.loads(r.body)["name"]) for r in back["components"].collect()) == [("one", "N"), ("one", "g"), ("two", "q,]}")]


def test_component_folder_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "sys")
    bus = spark.sql("select 1 as number, named_struct('min', 0.9D, 'max', 1.1D) as voltage_limits")
    SJ.write_component_folder({"Bus": bus}, path)
    with pytest.raises(AnalysisException):
        SJ.write_component_folder({"Bus": bus}, path)
    SJ.write_component_folder({"Bus": bus.union(bus)}, path, force=True)
    back = SJ.read_component_folder(spark, path, "Bus", "number int, voltage_limits struct<min: double, max: double>")
    assert back.count() == 2 and back.first().voltage_limits.max == 1.1


@pytest.mark.parametrize("form", ["lines", "array", "pretty array"])
def test_wide_files_with_different_columns(spark, tmp_path, form):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "wind.csv").write_text("DateTime,gen1,gen2\n2020-01-01T00:00:00,1.5,2.5\n2020-01-01T01:00:00,3.5,\n")
    (tmp_path / "data" / "solar.csv").write_text("DateTime,gen9,gen1\r\n2020-01-01T00:00:00,9.0,7.0\r\n")
    pointers = [
        {"component_name": c, "name": "max_active_power", "category": "Generator", "resolution": 3600, "normalization_factor": 1.5 if c == "gen9" else "Max", "data_file": str(tmp_path / "data" / f), "simulation": "DA", "scaling_factor_multiplier": None if c == "gen2" else "get_max_active_power"}
        for c, f in [("gen1", "wind.csv"), ("gen2", "wind.csv"), ("gen9", "solar.csv")]
    ]
    text = {"lines": "\n".join(map(json.dumps, pointers)), "array": json.dumps(pointers), "pretty array": json.dumps(pointers, indent=2)}
    (tmp_path / "pointers.json").write_text(text[form])
    read = PT.read_ts_pointers(spark, str(tmp_path / "pointers.json"), str(tmp_path / "data"), multi_line=form == "pretty array")
    rows = read.collect()
    assert {(r.component_name, r.simulation, r.scaling_factor_multiplier) for r in rows} == {("gen1", "DA", "get_max_active_power"), ("gen2", "DA", None), ("gen9", "DA", "get_max_active_power")}
    fields = spark.createDataFrame([("gen1", "max_active_power", 10.0), ("gen9", "rating", 3.0)], "component_name string, field string, amount double")
    scaled = {(r.component_name, r.ts.hour): r.scaled for r in PT.attach_pointer_series(read, fields).collect()}
    assert scaled == {("gen1", 0): pytest.approx(1.5 / 3.5 * 10), ("gen1", 1): 10.0, ("gen2", 0): 1.0, ("gen2", 1): None, ("gen9", 0): 6.0}
    got = {(r.component_name, r.ts.hour): r.value for r in rows}
    assert {r.normalization_factor for r in rows} == {"Max", "1.5"}
    assert got == {("gen1", 0): 1.5, ("gen1", 1): 3.5, ("gen2", 0): 2.5, ("gen2", 1): None, ("gen9", 0): 9.0}


def test_rows_of_wide_series_stay_where_they_are_read(spark, tmp_path, plan):
    (tmp_path / "wind.csv").write_text('DateTime,gen.1,"Far, West"\n2020-01-01T00:00:00,1.5,2.5\n')
    (tmp_path / "note.csv").write_text("no series here\n")
    series = PT.read_wide_series(spark, [str(tmp_path / "wind.csv"), str(tmp_path / "note.csv")])
    assert {(r.component_name, r.value) for r in series.collect()} == {("gen.1", 1.5), ("Far, West", 2.5)}
    assert "BroadcastHashJoin" in plan(series) and "SortMergeJoin" not in plan(series)  # only the headers move


@pytest.mark.parametrize("columns", [200, 1600])
def test_wide_lines_carry_each_pointer_once(spark, tmp_path, columns):
    """Work on a line is in proportion to its cells: a cell is met by the pointers of its column only."""
    (tmp_path / "data").mkdir()
    names = [f"g{i}" if i % 3 else f'"g, {i}"' for i in range(columns)]
    lines = [",".join([f"2020-01-01T{h:02d}:00:00", *(f'"{h}"' if i % 50 == 0 else str(h * i) for i in range(columns))]) for h in range(24)]
    (tmp_path / "data" / "wide.csv").write_text("\n".join([",".join(["DateTime", *names]), *lines]) + "\n")
    wanted = [i for i in range(columns) if i % 2]
    rows = [{"component_name": names[i].strip('"'), "name": kind, "normalization_factor": "Max", "data_file": str(tmp_path / "data" / "wide.csv")} for i in wanted for kind in (["p", "q"] if i % 5 == 0 else ["p"])]
    (tmp_path / "pointers.json").write_text("\n".join(map(json.dumps, rows)))
    read = PT.read_ts_pointers(spark, str(tmp_path / "pointers.json"), str(tmp_path / "data"))
    got = {(r.component_name, r.name, r.ts.hour): r.value for r in read.collect()}
    assert got == {(r["component_name"], r["name"], h): float(h if i % 50 == 0 else h * i) for r in rows for i in [int(r["component_name"].strip("g, "))] for h in range(24)}
    explode = read._jdf.queryExecution().executedPlan().toString()
    assert "array_position" not in explode.split("Generate")[0]
    lines_met = PT._pointed_lines(spark, str(tmp_path / "data"), spark.read.schema(PT.POINTER_SCHEMA).json(str(tmp_path / "pointers.json")), "DateTime")
    assert lines_met.count() == 24 and {len(r.wanted) for r in lines_met.collect()} == {len(rows)}


def test_odd_cells(spark):
    lines = ['a,"b,c", "d"" e" ,,f', "", ",", '"open, quote', 'x"y,z"w,v', '"a""b"', "1,2\r"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lines], "value string").select(PT._cells(F.col("value"))).collect()]
    assert got == [["a", "b,c", 'd"" e', "", "f"], [""], ["", ""], ['"open, quote'], ['x"y,z"w', "v"], ['a""b'], ["1", "2"]]


def test_pointer_factor_is_a_number_or_max(spark, tmp_path):
    ids = spark.createDataFrame([("1",), ("2",), ("7",)], "series_id string")
    names = spark.createDataFrame([("1", "gen1"), ("2", "gen2")], "series_id string, component_name string")
    factors = spark.createDataFrame([("1", "Max"), ("2", "1.0"), ("7", "Max")], "series_id string, factor string")
    rows = PT.build_ts_pointers(ids, names, factors, "Generator", "f.csv", "m", "n")
    PT.write_ts_pointers(rows, str(tmp_path / "p"))
    back = spark.read.schema(PT.POINTER_SCHEMA).json(str(tmp_path / "p"))
    assert {(r.component_name, r.normalization_factor) for r in back.collect()} == {("gen1", "Max"), ("gen2", "1.0")}
    assert back.columns == rows.columns


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 0.1), (2, None, -1e-9)], "id long, name string, v double")
    sink_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, scan_csv(spark, str(tmp_path / "t"), df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_only_the_entry_asked_for_is_read(spark, tmp_path, plan):
    result = spark.sql(
        "select p as problem, k as kind, e as entry, timestamp_ntz'2024-01-01 00:00:00' as initial_time, 1.0D as value from (select explode(array('UC','ED')) as p) lateral view explode(array('variable','dual')) as k lateral view explode(array('A','B')) as e"
    )
    write_result(result, str(tmp_path / "r"))
    rows = read_result(spark, str(tmp_path / "r"), "UC", "dual", "A")
    assert rows.count() == 1
    text = plan(rows)
    assert "PartitionFilters: [isnotnull(problem" in text and "DataFilters: []" in text


def test_results_brought_together_by_entry_and_days(spark, tmp_path):
    result = spark.range(4000).select(
        F.lit("UC").alias("problem"), F.lit("variable").alias("kind"), F.lit("A").alias("entry"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(id % 40))").alias("initial_time"), "id",
    )
    write_result(result.repartition(16), str(tmp_path / "r"), file_days=10)
    files = list((tmp_path / "r" / "problem=UC" / "kind=variable" / "entry=A").glob("*.parquet"))
    assert 1 <= len(files) <= 4
    assert read_result(spark, str(tmp_path / "r"), "UC", "variable", "A").count() == 4000


def test_materialize_once_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    root = str(tmp_path / "store")
    for _ in range(3):
        assert materialize_once(spark, "five", build, root, category="small").count() == 5
    assert len(calls) == 1
    materialize_once(spark, "five", build, root, rebuild=True, category="small")
    materialize_once(spark, "other", build, root, category="big")
    assert len(calls) == 3
    assert {(r.name, r.category) for r in dataset_catalog(spark, root).collect()} == {("five", "small"), ("other", "big")}


def test_unfinished_dataset_is_built_again(spark, tmp_path):
    root = str(tmp_path / "store")
    spark.range(2).write.parquet(f"{root}/data/half/one")
    assert materialize_once(spark, "half", lambda: spark.range(7), root).count() == 7


def test_failed_rebuild_leaves_the_old_data(spark, tmp_path):
    root = str(tmp_path / "store")
    materialize_once(spark, "d", lambda: spark.range(3), root)
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        materialize_once(spark, "d", lambda: broken, root, rebuild=True)
    assert materialize_once(spark, "d", lambda: spark.range(9), root).count() == 3
    assert materialize_once(spark, "d", lambda: spark.range(9), root, rebuild=True).count() == 9
