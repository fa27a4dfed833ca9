"""Command line: `python -m tests.run_oracle <sf folder> [names or module prefixes]`."""

from __future__ import annotations

import sys
import traceback

from gridloom.checks.catalog import all_oracles, all_queries
from gridloom.session import build_session
from tests.oracle import check, connect


def main() -> None:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = all_oracles(), 0
    for name, build in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            problem, rows, spark_s, oracle_s = check(spark, con, sf_dir, name, build, oracles.get(name))
        except Exception as error:
            problem, rows, spark_s, oracle_s = f"{type(error).__name__}: {str(error)[:900]}", -1, 0.0, 0.0
            if "-v" in wanted:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name:28s} rows={rows:<8d} spark={spark_s:.2f}s oracle={oracle_s:.2f}s {'' if name in oracles else '(no oracle) '}{problem}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
