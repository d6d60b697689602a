"""The queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def draw_sql(seed: int, *keys: str) -> str:
    """The number ``functions.draws.draw`` gives, in SQL."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {text})), 1, 15) AS BIGINT)"
