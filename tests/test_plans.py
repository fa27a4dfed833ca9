"""Shapes no registered query may have: they would not hold on a large cluster."""

from __future__ import annotations

import re

import pytest

from gridloom.checks.catalog import all_queries

SF_DIR = "/root/testdata/sf0.001"
# Grouped results of one row, and top-k look-ups: small by meaning.
ONE_ROW = {"objective_value"}


@pytest.mark.parametrize("name", list(all_queries()))
def test_physical_plan(spark, plan, name):
    text = plan(all_queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text), "cross join"
    assert not re.search(r"EvalPython|InPandas|InArrow|PythonUDF|MapPartitions", text), "leaves the JVM"
    if name not in ONE_ROW:
        windows = re.search(r"Window .*\n.*Sort.*\n.*Exchange SinglePartition", text)
        assert not windows, "window over one partition"


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("bar_totals", "lineitem", {"l_partkey", "l_quantity", "l_shipdate"}),
        ("range_violations", "orders", {"o_orderkey", "o_custkey", "o_totalprice"}),
        ("from_initial_time", "events", {"event_id", "ts"}),
        ("prefix_name", "part", {"p_partkey"}),
    ],
)
def test_only_needed_columns_are_read(spark, plan, name, table, columns):
    text = plan(all_queries()[name](spark, SF_DIR))
    scans = [line for line in text.splitlines() if "FileScan" in line and f"{table}.parquet" in line]
    assert scans
    for scan in scans:
        read = set(re.findall(r"(\w+):", scan.split("ReadSchema: struct<")[1]))
        assert read <= columns


def test_time_filter_is_pushed_to_the_scan(spark, plan):
    text = plan(all_queries()["from_initial_time"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)
