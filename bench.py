"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the table folder (default sf0.1), `BENCH_CPUS` the local threads,
`BENCH_QUERIES` an optional comma-separated choice (`all` for every registered query).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from gridloom.checks.catalog import all_queries
from gridloom.session import build_session, scratch

HEADLINE = [
    "realized_by_fuel", "assemble_case", "canonical_generators", "generation_by_fuel", "fuel_pivot", "stack_offsets",
    "forecast_windows", "realized", "normalize_series", "scale_series", "infer_resolution",
    "commitment_asof", "commitment_runs", "ramp_check", "merit_order_dispatch", "clearing_price",
    "ybus", "ptdf_flow", "lodf_from_ptdf", "lmp", "service_by_product", "demand_by_area", "net_injection_by_bus",
    "approx_equal", "range_violations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    choice = os.environ.get("BENCH_QUERIES", "")
    known = all_queries()
    names = list(known) if choice == "all" else [n for n in choice.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = spark.read.parquet(f"{sf_dir}/nation.parquet")
    warm.join(spark.read.parquet(f"{sf_dir}/region.parquet"), warm.n_regionkey == F.col("r_regionkey")).groupBy("r_name").count().collect()
    seconds: dict[str, float] = {}
    for name in names:
        with scratch(spark):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
