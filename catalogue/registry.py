"""Where queries are registered, and small helpers for their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.numeric import round_floor

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the equivalent SQL."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Fix the digits of the named columns, leaving the others."""
    return df.select(
        *[round_floor(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def moment(text: str) -> Column:
    """A timestamp literal without zone, as the tables store them."""
    return F.expr(f"timestamp_ntz'{text}'")


def sql_round(value: str, digits: int) -> str:
    return f"(floor(CAST({value} AS DOUBLE) * 1e{digits} + CAST(0.5 AS DOUBLE)) / 1e{digits})"


def num(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"
