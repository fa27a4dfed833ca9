from __future__ import annotations

import pytest

from gridloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": f"file://{folder}/warehouse",
            "spark.checkpoint.dir": f"file://{folder}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan():
    """The physical plan of a DataFrame as text."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
