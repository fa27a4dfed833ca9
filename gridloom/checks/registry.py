"""Pairs every query with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.checks.fixtures import Tables, oracle_statement

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable:
    """Register a query under an operator's name, with its oracle SQL."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = build
        if oracle is not None:
            _ORACLES[name] = oracle_statement(oracle)
        return build

    return add


def without_name(df: DataFrame, column: str = "component", name: str = "view") -> DataFrame:
    """One series has lost its name: its key is null."""
    return df.withColumn(column, F.nullif(column, F.lit(name)))


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimal totals as doubles, the type the oracle returns."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _runner(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Tables(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
