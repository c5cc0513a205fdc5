"""Register a query and, next to it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemill.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy per row: all cores take part."""
    return spread(table(spark, sf_dir, name))


def micro(total: str, n: str) -> str:
    """SQL for mean × 10⁶ rounded half up, in whole numbers, from a DECIMAL(…,2) total."""
    return f"((2 * CAST(({total}) * 100 AS BIGINT) * 10000 + {n}) // (2 * {n}))"


def mean6(total: str, n: str) -> str:
    return f"CAST({micro(total, n)} AS DOUBLE) / 1000000"


def mean2(total: str, n: str) -> str:
    return f"CAST(({micro(total, n)} + 5000) // 10000 AS DOUBLE) / 100"
